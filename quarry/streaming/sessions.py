"""Pairs and follow windows over streams, whatever a session's size.

Two steps share the work.  The first (``foreachBatch``) orders a
micro-batch and closes what begins and ends within it, with the segmented
scan of the batch form, so a session that holds the whole batch is spread
over tasks.  Of each session only two edges are left: what may continue
earlier rows and what later rows may continue.  The second step
(``transformWithState``) joins the edges over batches; its state is one open
item per session, forgotten or closed by time.  Both steps take what is
available and stop; either may be interrupted and run again.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions import constants as K
from ..functions.text import strip
from ..operators.scan import running_sums
from ..operators.sessions import HOT_ROWS, _by_hotness, join_session
from ..session import exists, hadoop, materialize

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Stands for a missing time: later than any bound.
_NEVER = 2**62
_ORDER = ["tkey", "seq", "_id"]


# --------------------------------------------------------------- two steps
def _delete(spark: SparkSession, path: str) -> None:
    fs, p = hadoop(spark, path)
    fs.delete(p, True)


def _stream_batches(df: DataFrame, checkpoint: str, fn: Callable[[DataFrame, int], None]) -> None:
    q = (df.writeStream.foreachBatch(fn).option("checkpointLocation", f"{checkpoint}/batches")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _numbered(df: DataFrame, label: str) -> DataFrame:
    """Rows of a micro-batch stored once, with a number that makes their
    order total."""
    return materialize(df.withColumn("_id", F.monotonically_increasing_id()), label)


def _join_edges(spark: SparkSession, checkpoint: str, out: str, schema: str, build: Callable[[DataFrame], DataFrame], closed: list,
                as_json: bool = False) -> None:
    """Second step: edges through ``build``, closed rows as they are, to one
    file sink."""
    edges = f"{checkpoint}/edges"
    if not exists(spark, edges):
        return
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        def read():
            return spark.readStream.schema(schema).parquet(edges)
        rows = read().where("kind = 'closed'").select(*closed).unionByName(build(read().where("kind <> 'closed'")))
        if as_json:
            rows = rows.select(F.to_json(F.struct("messages"), {"ignoreNullFields": "false"}).alias("value"))
        q = (rows.writeStream.format("text" if as_json else "parquet").option("path", out)
             .option("checkpointLocation", f"{checkpoint}/joined").outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def _write_edges(df: DataFrame, checkpoint: str, batch: int) -> None:
    """A repeated attempt at a batch replaces the one before."""
    df.write.mode("overwrite").parquet(f"{checkpoint}/edges/batch={batch}")


def _message(role: str, content) -> F.Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


# -------------------------------------------------------------------- pairs
_PAIR_EDGE = "kind string, session_id string, user string, assistant string, tail string, arrival timestamp, batch bigint"


def _pair_edges(rows: DataFrame, hot_rows: int) -> DataFrame:
    """Islands of a micro-batch: ``closed`` pairs, and per session one
    ``edge`` (user texts before its first answer, that answer, user texts
    after its last)."""
    asks = (F.col("role") == "user") & (F.col("user_text") != "")
    replies = (F.col("role") == "assistant") & (F.col("assistant_text") != "")
    rows = _numbered(rows.where(asks | replies).select(
        "session_id", "tkey", "seq", replies.alias("_reply"), F.when(asks, F.col("user_text")).alias("_ask"),
        F.when(replies, F.col("assistant_text")).alias("_answer")), "turns")

    def islands(part: DataFrame, safe: bool) -> DataFrame:
        scanned = running_sums(part, ["session_id"], _ORDER, {"_n": F.col("_reply").cast("int")}, skew_safe=safe, row_id="_id")
        return scanned.withColumn("island", F.col("_n") - F.col("_reply").cast("bigint")).groupBy("session_id", "island").agg(
            F.expr("listagg(_ask, '\\n\\n') WITHIN GROUP (ORDER BY tkey, seq, _id)").alias("user"),
            F.max("_answer").alias("assistant"))
    all_ = materialize(_by_hotness(rows, "session_id", "auto", hot_rows, islands), "islands")
    none = F.lit(None).cast("string")
    closed = all_.where("island > 0 and assistant is not null and user is not null").select(
        F.lit("closed").alias("kind"), "session_id", "user", "assistant", none.alias("tail"))
    tail = all_.where("island > 0 and assistant is null").select("session_id", F.col("user").alias("tail"))
    edge = join_session(all_.where("island = 0"), tail, "left").select(F.lit("edge").alias("kind"), "session_id", "user", "assistant", "tail")
    return closed.unionByName(edge)


class _Pending(StatefulProcessor):
    """User texts of a session that no answer has followed yet, with the time
    of their arrival; one older than ``ttl_ms`` when the answer arrives is
    not asked any more, and a timer drops it when no answer comes."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.texts = handle.getListState("texts", "text string, at bigint")

    def _live(self, now: int) -> list:
        return [t for t in self.texts.get() if self.ttl_ms is None or now - t[1] <= self.ttl_ms]

    def _renew_timer(self) -> None:
        if self.ttl_ms is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            at = [t[1] for t in self.texts.get()]
            if at:
                self.handle.registerTimer(min(at) + self.ttl_ms + 1)

    def handleInputRows(self, key, rows, timerValues):
        for r in sorted(rows, key=lambda r: r.batch):  # one row per micro-batch of the first step
            now = int(r.arrival.timestamp() * 1000)
            if r.user is not None:
                self.texts.appendValue((r.user, now))
            if r.assistant is not None:
                asked = [t[0] for t in self._live(now)]
                if asked:
                    yield Row(session_id=key[0], user="\n\n".join(asked), assistant=r.assistant)
                self.texts.clear()
                if r.tail is not None:
                    self.texts.appendValue((r.tail, now))
        self._renew_timer()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        left = self._live(timerValues.getCurrentWatermarkInMs())
        if left:
            self.texts.put([tuple(t) for t in left])
        else:
            self.texts.clear()
        self._renew_timer()
        return iter(())

    def close(self) -> None:
        pass


def pairs_job(turns: DataFrame, out: str, checkpoint: str, system: str = K.PAIR_SYSTEM_PROMPT, ttl: str | None = None,
              hot_rows: int = HOT_ROWS, as_json: bool = False) -> None:
    """Pairs of a stream of normalised turns (``seq`` orders ties), appended
    to the folder ``out`` as Parquet (``session_id, user, assistant,
    messages``) or as JSON lines of ``messages``; runs until all available input is taken.

    User text that is pending when a run ends is completed by a later run, or
    forgotten ``ttl`` (such as ``"7 days"``) after it arrived.  Turns are
    ordered within a micro-batch; null sessions are a session of their own."""
    spark = turns.sparkSession

    def first(df: DataFrame, batch: int) -> None:
        edges = _pair_edges(df.withColumn("tkey", F.coalesce("ts_raw", F.lit(""))), hot_rows)
        _write_edges(edges.withColumn("arrival", F.current_timestamp()), checkpoint, batch)

    def build(edges: DataFrame) -> DataFrame:
        ttl_ms = int(pd.Timedelta(ttl).total_seconds() * 1000) if ttl else None
        if ttl:
            edges = edges.withWatermark("arrival", "1 second")
        joined = edges.groupBy("session_id").transformWithState(
            statefulProcessor=_Pending(ttl_ms), outputStructType="session_id string, user string, assistant string", outputMode="Append",
            timeMode="EventTime" if ttl else "None")  # by processing time a run would never end
        return joined.select(*shown)
    user = strip("user")
    shown = ["session_id", user.alias("user"), "assistant", F.array(
        _message("system", F.lit(system)), _message("user", user), _message("assistant", F.col("assistant"))).alias("messages")]
    _stream_batches(turns, checkpoint, first)
    _join_edges(spark, checkpoint, out, _PAIR_EDGE, build, shown, as_json)


# ----------------------------------------------------------- follow windows
_TAKEN = "array<struct<role: string, text: string, hi: bigint>>"
_FOLLOW_EDGE = {"kind": "string", "session_id": "string", "n_follow": "bigint", "anchor": "string", "taken": _TAKEN, "at": "bigint", "hi": "bigint",
                "last": "bigint", "head": _TAKEN, "head_hi": "bigint", "has_human": "boolean", "mark": "timestamp"}


def _ripe(df: DataFrame, checkpoint: str, batch: int, lateness: str) -> tuple[DataFrame, int | None]:
    """The rows of a micro-batch and of the reorder buffer that no row on
    time can precede any more, and the time (microseconds) up to which that
    is so.  The others wait in the buffer, a table of one version per batch;
    a repeated attempt reads the version before and writes the same."""
    spark = df.sparkSession
    buffer, delay = f"{checkpoint}/buffer", int(pd.Timedelta(lateness).total_seconds() * 1_000_000)
    us = F.unix_micros("ts")
    old, passed = f"{buffer}/batch={batch - 1}", None
    if exists(spark, f"{old}/rows"):
        passed = spark.read.parquet(f"{old}/mark").first()[0]
        if passed is not None:
            df = df.where(us.isNull() | (us > passed))  # later than the watermark: dropped
        df = df.unionByName(spark.read.schema(df.schema).parquet(f"{old}/rows"))
    rows = materialize(df, "arrived")
    newest = rows.agg(F.max(us)).first()[0]
    mark = max([x for x in (passed, None if newest is None else newest - delay) if x is not None], default=None)
    ripe = us.isNull() | (us <= F.lit(mark))
    rows.where(~F.coalesce(ripe, F.lit(True))).write.mode("overwrite").parquet(f"{buffer}/batch={batch}/rows")
    spark.createDataFrame([(mark,)], "mark bigint").write.mode("overwrite").parquet(f"{buffer}/batch={batch}/mark")
    _delete(spark, f"{buffer}/batch={batch - 2}")
    return rows.where(F.coalesce(ripe, F.lit(True))), mark


def _follow_edges(rows: DataFrame, follow_k: int, minutes: int, min_chars: int, hot_rows: int) -> DataFrame:
    """Islands of ripe rows, one per human turn: ``closed`` windows, and per
    session one ``edge`` (what may extend the window that is open before, and
    the window that its last human turn opens).

    Of an island the first ``follow_k`` rows that a window can take are kept,
    each with ``hi``, the latest time up to it, which says whether the window
    had ended; ``hi`` of the island says whether it has ended since."""
    us = F.coalesce(F.unix_micros("ts"), F.lit(_NEVER))
    human = (F.col("role") == "user") & F.col("has_human")
    reply = (F.col("role") == "assistant") & (F.col("assistant_text") != "")
    tool = (F.col("role") == "user") & (F.col("user_text") != "")
    rows = _numbered(rows.select(
        "session_id", "tkey", "seq", us.alias("_us"), human.alias("_human"), (~human & (reply | tool)).alias("_takes"),
        F.when(human, F.col("human_text")).alias("_anchor"), F.col("role"),
        F.when(reply, F.col("assistant_text")).when(tool, F.col("user_text")).alias("_text")), "ripe")

    def islands(part: DataFrame, safe: bool) -> DataFrame:
        number = running_sums(part, ["session_id"], _ORDER, {"island": F.col("_human").cast("int")}, skew_safe=safe, row_id="_id")
        number = materialize(number, "islands") if safe else number
        places = running_sums(number, ["session_id", "island"], _ORDER, {"_n": F.col("_takes").cast("int")}, skew_safe=safe,
                              maxes={"_hi": F.when(~F.col("_human"), F.col("_us"))}, row_id="_id")
        row = F.struct(F.col("_n"), F.col("role"), F.col("_text").alias("text"), F.col("_hi").alias("hi"))
        got = places.groupBy("session_id", "island").agg(
            F.max("_anchor").alias("anchor"), F.max(F.when(F.col("_human"), F.col("_us"))).alias("at"),
            F.max(F.when(~F.col("_human"), F.col("_us"))).alias("hi"), F.max(F.when(F.col("_us") < _NEVER, F.col("_us"))).alias("last"),
            F.array_sort(F.collect_list(F.when(F.col("_takes") & (F.col("_n") <= follow_k), row))).alias("taken"))
        return got.withColumn("taken", F.transform("taken", lambda x: F.struct(x["role"], x["text"], x["hi"])))
    all_ = materialize(_by_hotness(rows, "session_id", "auto", hot_rows, islands), "windows")
    opens = F.length("anchor") >= min_chars
    end = F.when(F.lit(bool(minutes)) & (F.col("at") < _NEVER), F.col("at") + F.lit(minutes * 60_000_000))
    last = all_.groupBy("session_id").agg(F.max("island").alias("island"), F.max("last").alias("_seen"))
    whole = join_session(all_, last.select("session_id", F.col("island").alias("_last")))
    kept = F.filter("taken", lambda x: end.isNull() | (x["hi"] <= end))
    closed = whole.where((F.col("island") > 0) & (F.col("island") < F.col("_last")) & opens).withColumn("taken", kept) \
        .where(F.exists("taken", lambda x: x["role"] == "assistant")) \
        .select(F.lit("closed").alias("kind"), "session_id", F.size("taken").cast("bigint").alias("n_follow"), "anchor", "taken")
    open_ = whole.where("island = _last and island > 0").select(
        "session_id", F.when(opens, F.col("anchor")).alias("anchor"), "taken", "at", "hi", F.lit(True).alias("has_human"))
    head = all_.where("island = 0").select("session_id", F.col("taken").alias("head"), F.col("hi").alias("head_hi"))
    edge = join_session(join_session(last.select("session_id", F.col("_seen").alias("last")), open_, "left"), head, "left").withColumn("kind", F.lit("edge"))
    return closed.unionByName(edge, allowMissingColumns=True)


class _Window(StatefulProcessor):
    """A session's open window; closed by its next human turn, by the
    watermark beyond its end, or after its session has been idle."""

    def __init__(self, follow_k: int, minutes: int, idle_us: int):
        self.follow_k, self.minutes, self.idle_us = follow_k, minutes, idle_us

    def init(self, handle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "anchor string, end bigint, closed boolean, roles array<string>, texts array<string>, last bigint")

    def _extend(self, w, rows, hi) -> None:
        if w is None or w["closed"]:
            return
        for r in rows if rows is not None else ():  # structs within a list come as dictionaries
            if len(w["roles"]) < self.follow_k and (w["end"] is None or r["hi"] <= w["end"]):
                w["roles"].append(r["role"])
                w["texts"].append(r["text"])
        w["closed"] = w["end"] is not None and hi is not None and hi > w["end"]

    def _shown(self, key, w):
        if w is not None and "assistant" in w["roles"]:
            yield Row(session_id=key[0], anchor=w["anchor"], n_follow=len(w["roles"]), roles=w["roles"], texts=w["texts"])

    def _load(self):
        if not self.window.exists():
            return None
        anchor, end, closed, roles, texts, last = self.window.get()
        return {"anchor": anchor, "end": end, "closed": closed, "roles": list(roles), "texts": list(texts), "last": last}

    def _clear_timers(self) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)

    def handleInputRows(self, key, rows, timerValues):
        w = self._load()
        for r in sorted(rows, key=lambda r: r.batch):  # one row per micro-batch of the first step
            self._extend(w, r.head, r.head_hi)
            if r.has_human:
                yield from self._shown(key, w)
                w = None
                if r.anchor is not None:
                    end = r.at + self.minutes * 60_000_000 if self.minutes and r.at < _NEVER else None
                    w = {"anchor": r.anchor, "end": end, "closed": False, "roles": [], "texts": [], "last": None}
                    self._extend(w, r.taken, r.hi)
            if w is not None and r.last is not None:
                w["last"] = max(r.last, w["last"] or r.last)
        self._clear_timers()
        if w is None:
            self.window.clear()
            return
        self.window.update((w["anchor"], w["end"], w["closed"], w["roles"], w["texts"], w["last"]))
        until = w["end"] if w["end"] is not None else None if w["last"] is None else w["last"] + self.idle_us
        if until is not None:
            self.handle.registerTimer(max(until // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._shown(key, self._load())
        self.window.clear()

    def close(self) -> None:
        pass


def follow_job(turns: DataFrame, out: str, checkpoint: str, follow_k: int = K.DEFAULT_FOLLOW_K, follow_minutes: int = 0,
               min_user_chars: int = K.DEFAULT_MIN_USER_CHARS, lateness: str = "10 minutes", system: str = K.PAIR_SYSTEM_PROMPT,
               idle: str = "1 day", hot_rows: int = HOT_ROWS) -> None:
    """Follow windows of a stream of normalised turns, appended to the Parquet
    folder ``out`` as ``session_id, n_follow, messages``; runs until all
    available input is taken.

    Rows wait in a reorder buffer until the newest time seen is ``lateness``
    ahead, so rows that arrive out of order by less, also in different
    batches or runs, give the windows of the batch form; later ones are
    dropped.  Rows without a time are taken when they arrive.  A window is
    written when the next human turn is released, when the watermark passes
    its end, or, without a bound, ``idle`` after its session's last row."""
    spark = turns.sparkSession
    turns = turns.select("session_id", F.coalesce("ts_raw", F.lit("")).alias("tkey"), "seq", F.col("ts").cast("timestamp").alias("ts"),
                         "role", "user_text", "assistant_text", "has_human", "human_text")

    def first(df: DataFrame, batch: int) -> None:
        ripe, mark = _ripe(df, checkpoint, batch, lateness)
        edges = _follow_edges(ripe, follow_k, follow_minutes, min_user_chars, hot_rows)
        at = F.lit(None if mark is None else mark).cast("bigint")
        beat = spark.range(1).select(F.lit("edge").alias("kind"), F.lit("").alias("session_id"))  # time passes without rows too
        edges = edges.unionByName(beat, allowMissingColumns=True).withColumn("mark", F.timestamp_micros(at))
        _write_edges(edges.select(*_FOLLOW_EDGE), checkpoint, batch)

    def build(edges: DataFrame) -> DataFrame:
        idle_us = int(pd.Timedelta(idle).total_seconds() * 1_000_000)
        # a batch that does not move the mark is not late
        joined = edges.withWatermark("mark", "1 second").groupBy("session_id").transformWithState(
            statefulProcessor=_Window(follow_k, follow_minutes, idle_us),
            outputStructType="session_id string, anchor string, n_follow bigint, roles array<string>, texts array<string>",
            outputMode="Append", timeMode="EventTime")
        pairs = F.transform(F.arrays_zip("roles", "texts"), lambda x: F.struct(x["roles"].alias("role"), x["texts"].alias("content")))
        return joined.select("session_id", "n_follow", F.concat(head, pairs).alias("messages"))
    head = F.array(_message("system", F.lit(system)), _message("user", F.col("anchor")))
    took = F.transform("taken", lambda x: F.struct(x["role"], x["text"].alias("content")))
    _stream_batches(turns, checkpoint, first)
    schema = ", ".join(f"{name} {kind}" for name, kind in _FOLLOW_EDGE.items()) + ", batch bigint"
    _join_edges(spark, checkpoint, out, schema, build, ["session_id", "n_follow", F.concat(head, took).alias("messages")])
