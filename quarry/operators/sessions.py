"""Session operators: pair builder (W2), follow windows (W3/W5), cwd and
anchor filters (F1, F11) and the ordered global cap (L4).

Input is a frame of normalised turns (``segments.normalise`` or a
stand-in): ``session_id, ts_raw, ord, role, user_text, assistant_text,
has_human, human_text`` (+ ``ts`` for windows).  Within a session rows
are ordered by the raw timestamp string (missing = '' first), ties in
input order (W1).

Both operators are island problems.  A sequential loop over a session
becomes: (1) an island id from a running count, plus for follow windows
the island's first row carried by a running max; (2) per-island work that
is either an aggregate (pairs) or a top-(k+1) cut planned as a partial
group limit (follow windows).  Sessions above ``hot_rows`` rows get the
running values from the segmented scan in ``scan.py`` (no session in one
task); smaller sessions use one plain session window, which holds at most
``hot_rows`` rows per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..session import materialize
from .scan import running_sums

ORDER = ["_tkey", "ord"]


def _with_order(df: DataFrame, order_by: str = "raw") -> DataFrame:
    """Session order key.  ``raw`` (the original): the timestamp string,
    missing = '' first, so mixed offsets are not chronological.
    ``parsed``: the instant (missing first), as zero-padded epoch
    microseconds, so neither the session zone nor DST changes the order."""
    if order_by == "parsed":
        micros = F.unix_micros(F.col("ts").cast("timestamp"))
        key = F.coalesce(F.lpad(micros.cast("string"), 20, "0"), F.lit(""))
    else:
        key = F.coalesce(F.col("ts_raw"), F.lit(""))
    return df.withColumn("_tkey", key)


def _msg(role, content):
    return F.struct(F.lit(role).alias("role") if isinstance(role, str) else role.alias("role"),
                    content.alias("content"))


# ------------------------------------------------------------- hot sessions
HOT_ROWS = 1_000_000


def _by_hotness(df: DataFrame, key: str, skew_safe, hot_rows: int, fn) -> DataFrame:
    """Run ``fn(part, safe)`` with the skew-safe scan only where needed.

    ``skew_safe=True``/``False`` forces one path.  ``"auto"``: one partial
    aggregate over the stored rows finds the sessions with more than
    ``hot_rows`` rows (at most total/hot_rows of them).  Those take the
    segmented scan; all others take the plain session window (one shuffle).
    The joins that divide them carry no hint; both paths give the same rows.
    """
    if skew_safe != "auto":
        return fn(df, bool(skew_safe))
    hot = materialize(df.groupBy(key).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > F.lit(hot_rows)).select(F.col(key).alias("_hot")), "hot")
    if hot.isEmpty():
        return fn(df, False)
    same = F.col(key).eqNullSafe(F.col("_hot"))
    return fn(df.join(hot, same, "left_anti"), False).unionByName(fn(df.join(hot, same, "left_semi"), True))


def join_session(df: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    """Join on ``session_id``, where null is a session too."""
    return df.join(other.withColumnRenamed("session_id", "_sid"), F.col("session_id").eqNullSafe(F.col("_sid")), how).drop("_sid")


# ------------------------------------------------------------------- F1
def cwd_contains(df: DataFrame, s: str) -> DataFrame:
    return df.where(F.contains(F.coalesce(F.col("cwd"), F.lit("")), F.lit(s)))


# ------------------------------------------------------------------- W2
def build_pairs(turns: DataFrame, system: str = K.PAIR_SYSTEM_PROMPT,
                limit: int | None = None, skew_safe="auto",
                order_by: str = "raw", hot_rows: int = HOT_ROWS) -> DataFrame:
    """User texts accumulate (joined by a blank line) until the next
    non-empty assistant text; each such assistant closes a pair.  An
    assistant with nothing pending is ignored; trailing users are lost.

    Returns ``session_id, island, first_ord, user, assistant, messages``.
    ``skew_safe``: ``"auto"`` (hot sessions only), ``True`` or ``False``.
    """
    is_user = (F.col("role") == "user") & (F.col("user_text") != "")
    is_asst = (F.col("role") == "assistant") & (F.col("assistant_text") != "")
    # Only the cheap role test runs before the turns are stored: a predicate
    # on the texts would be pushed below the normaliser and re-derive them.
    # Stored once, the turns feed the count of hot sessions, the totals, the
    # scan (narrow columns) and the island aggregate (texts).
    rows = _with_order(turns, order_by).where(F.col("role").isin("user", "assistant")).select(
        "session_id", "_tkey", "ord", is_asst.alias("_asst"),
        F.when(is_user, F.col("user_text")).alias("_u"),
        F.when(is_asst, F.col("assistant_text")).alias("_a"))
    rows = materialize(rows, "turns").where("_asst or _u is not null")

    def core(part: DataFrame, safe: bool) -> DataFrame:
        # a session's last island has no assistant: its users are left out
        # before any text is gathered
        if safe:
            total = materialize(part.groupBy("session_id").agg(F.sum(F.col("_asst").cast("bigint")).alias("_total")), "totals")
            part = join_session(part, total)
        else:
            part = part.withColumn("_total", F.sum(F.col("_asst").cast("bigint")).over(Window.partitionBy("session_id")))
        scanned = running_sums(part, ["session_id"], ORDER,
                               {"_n_asst": F.col("_asst").cast("int")}, skew_safe=safe, row_id="ord")
        # island = assistants strictly before this row
        scanned = scanned.withColumn("island", F.col("_n_asst") - F.col("_asst").cast("bigint"))
        return scanned.where(F.col("island") < F.col("_total")).groupBy("session_id", "island").agg(
            F.expr("listagg(_u, '\\n\\n') WITHIN GROUP (ORDER BY _tkey, ord)").alias("_users"),
            F.max("_a").alias("assistant"),
            F.min("ord").alias("first_ord"),
        )

    grouped = _by_hotness(rows, "session_id", skew_safe, hot_rows, core)
    pairs = grouped.where(F.col("_users").isNotNull())
    from ..functions.text import strip
    pairs = pairs.select(
        "session_id", "island", "first_ord",
        strip("_users").alias("user"), "assistant",
    ).withColumn("messages", F.array(
        _msg("system", F.lit(system)), _msg("user", F.col("user")), _msg("assistant", F.col("assistant"))))
    if limit is not None:
        pairs = limit_ordered(pairs, turns, limit)
    return pairs


# ------------------------------------------------------------------- L4
def limit_ordered(examples: DataFrame, turns: DataFrame, n: int) -> DataFrame:
    """Global cap on emitted examples: sessions in first-seen input order,
    examples in session order.

    The cut is found from the number of examples per session: a prefix sum
    over sessions in input order says which are whole below ``n`` and which
    one is cut.  Of that one the island numbers alone are counted by the
    segmented scan; the examples themselves are filtered where they are."""
    examples = materialize(examples, "examples")
    counts = examples.groupBy("session_id").agg(F.count(F.lit(1)).alias("_n"))
    first = turns.groupBy("session_id").agg(F.min("ord").alias("session_first_ord"))
    sizes = counts.join(first, "session_id")
    placed = materialize(running_sums(sizes, [], ["session_first_ord", "session_id"], {"_cum": F.col("_n")})
                         .select("session_id", "session_first_ord", "_n", "_cum"), "sessions")
    part = placed.where((F.col("_cum") > n) & (F.col("_cum") - F.col("_n") < n)).first()  # at most one
    whole = examples.join(placed.where(F.col("_cum") <= n).select("session_id", "session_first_ord"), "session_id")
    if part is None:
        return whole
    cut = examples.where(F.col("session_id") == part.session_id)
    room = n - (part._cum - part._n)
    placed_islands = running_sums(cut.select("island"), [], ["island"], {"_rn": F.lit(1)})
    last = placed_islands.where(F.col("_rn") <= room).agg(F.max("island")).first()[0]
    cut = cut.where(F.col("island") <= last).join(
        placed.where(F.col("session_id") == part.session_id).select("session_id", "session_first_ord"), "session_id")
    return whole.unionByName(cut)


# ------------------------------------------------------------------- W3 / W5
def follow_windows(turns: DataFrame, follow_k: int = K.DEFAULT_FOLLOW_K,
                   follow_minutes: int = 0,
                   min_user_chars: int = K.DEFAULT_MIN_USER_CHARS,
                   system: str = K.PAIR_SYSTEM_PROMPT,
                   skew_safe="auto", limit: int | None = None,
                   order_by: str = "raw", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Anchor on user turns with human text >= ``min_user_chars``; take the
    following rows until the next human turn, or (minutes > 0 and a valid
    anchor time) the first row of any type with a missing time or a time
    past anchor + minutes, or ``follow_k`` taken messages.  Assistant
    texts and tool-only user rows are taken.  Emit windows that took an
    assistant text.

    Every human turn ends the window before it, so the island id is the
    running count of human turns and windows never overlap.  Returns
    ``session_id, island, n_follow, messages``.
    """
    t = materialize(_with_order(turns, order_by), "turns")

    def core(t: DataFrame, safe: bool) -> DataFrame:
        human = (F.col("role") == "user") & F.col("has_human")
        anchor = human & (F.length("human_text") >= F.lit(min_user_chars))
        # One segmented scan gives each row its island (running count of human
        # turns) and the latest human turn at or before it (running max of its
        # order key), i.e. the island's first row: its time and whether it is an
        # anchor travel with every row, so no join back to the anchors.
        scanned = running_sums(
            t, ["session_id"], ORDER, {"island": human.cast("int")}, skew_safe=safe,
            maxes={"_lh": F.when(human, F.struct(F.col("_tkey"), F.col("ord"),
                                                 F.col("ts").alias("ats"), anchor.alias("anc")))},
            row_id="ord")
        if follow_minutes:
            end = F.col("_lh.ats") + F.make_dt_interval(mins=F.lit(follow_minutes))
        else:
            end = F.lit(None).cast("timestamp")
        violates = end.isNotNull() & (F.col("ts").isNull() | (F.col("ts") > end))
        is_asst = (F.col("role") == "assistant") & (F.col("assistant_text") != "")
        is_tool = (F.col("role") == "user") & (F.col("user_text") != "")
        in_anchor_island = F.coalesce(F.col("_lh.anc"), F.lit(False))
        # Anchor rows plus, in anchor islands, rows that are taken or that stop
        # the window.  The window takes eligible rows until the first violating
        # row or k of them; that is decided by the first k candidates after the
        # anchor, so row_number <= k + 1 (planned as a partial per-partition
        # group limit before the shuffle) is exact.
        x = scanned.where(anchor | (~human & in_anchor_island & (is_asst | is_tool | violates))).select(
            F.col("session_id").alias("_asid"), F.col("island").alias("_aisl"), "_tkey", "ord",
            anchor.alias("_anc"), violates.alias("_viol"), is_asst.alias("_is_asst"),
            F.when(anchor, F.col("human_text")).alias("_atext"),
            F.when(is_asst, _msg("assistant", F.col("assistant_text")))
            .otherwise(_msg("user", F.col("user_text"))).alias("_m"))
        wk = Window.partitionBy("_asid", "_aisl").orderBy("_tkey", "ord")
        top = x.withColumn("_rn", F.row_number().over(wk)).where(F.col("_rn") <= F.lit(follow_k + 1))
        grouped = top.groupBy("_asid", "_aisl").agg(
            F.max(F.when(F.col("_anc"), F.col("_atext"))).alias("anchor_text"),
            F.array_sort(F.collect_list(F.when(~F.col("_anc"), F.struct("_rn", "_viol", "_is_asst", "_m"))))
            .alias("_cands"))
        return grouped

    grouped = _by_hotness(t, "session_id", skew_safe, hot_rows, core)
    first_viol = F.array_position(F.transform("_cands", lambda c: c["_viol"]), True)
    taken = F.when(first_viol > 0, F.slice("_cands", 1, (first_viol - 1).cast("int"))).otherwise(F.col("_cands"))
    win = (grouped.where(F.col("anchor_text").isNotNull())
           .withColumn("_ms", taken)
           .where(F.exists("_ms", lambda c: c["_is_asst"]))
           .withColumn("n_follow", F.size("_ms").cast("bigint")))
    out = win.select(
        F.col("_asid").alias("session_id"), F.col("_aisl").alias("island"), "n_follow",
        F.concat(F.array(_msg("system", F.lit(system)), _msg("user", F.col("anchor_text"))),
                 F.transform("_ms", lambda x: x["_m"])).alias("messages"))
    if limit is not None:
        out = limit_ordered(out, turns, limit)
    return out
