"""Fill-in-the-middle spans.

Every draw is a pure function of ``(seed, path, draw number)``: the
uniforms come from hex slices of md5 digests, so the spans do not depend
on file order, partitioning or retries.  A file's draws are produced by
``explode(sequence(...))`` in the same narrow stage as the scan; the only
shuffle is the span dedupe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import lf
from .frames import once
from ..session import materialize
from .quality import first_flags, keep_first

TWO52 = float(2 ** 52)


def _u(hexdigest: Column, start: int) -> Column:
    """Uniform in [0, 1) from 13 hex characters (52 bits)."""
    return F.conv(F.substring(hexdigest, start, 13), 16, 10).cast("double") / F.lit(TWO52)


def _randint(u: Column, lo: Column, hi: Column) -> Column:
    """Integer uniform in [lo, hi] from a unit uniform."""
    return lo + F.floor(u * (hi - lo + F.lit(1))).cast("bigint")


# ------------------------------------------------------------------- F8
def fim_gates(df: DataFrame, text: str = "text") -> DataFrame:
    """File-level gates: non-empty, not a minified one-liner (over 20,000
    characters with no newline in the first 2,000), and at least 200
    characters after newline normalisation.  Adds ``code``."""
    t = F.col(text)
    minified = (F.length(t) > 20000) & (F.instr(F.substring(t, 1, 2000), "\n") == 0)
    kept = df.where(F.coalesce(F.length(t), F.lit(0)) > 0).where(~minified)
    return once(kept, "code", lf(t)).where(F.length("code") >= 200)


# ------------------------------------------------------------------- L6
def fim_spans(df: DataFrame, path: str = "path", text: str = "text",
              per_file: int = K.DEFAULT_FIM_PER_FILE, max_len: int = K.DEFAULT_FIM_MAX_LEN,
              seed: int | Column = K.DEFAULT_SEED, skip: str | None = None) -> DataFrame:
    """``per_file`` draws per file: a random window of ``max_len`` when the
    file is longer; middle length ``max(80, int(L * U(.2, .4)))``; middle
    start uniform in ``[20, L - mid_len - 20]``; prefix/middle/suffix.
    Draws whose window has no newline or whose middle is too long are
    skipped, and so are the draw numbers in the array column ``skip``.
    Returns ``path, sample_no, prefix, middle, suffix``, and ``repo`` where
    the input has it."""
    carry = ["repo"] if "repo" in df.columns else []
    seeds = seed if isinstance(seed, Column) else F.lit(seed)
    g = fim_gates(df, text).select(*carry, seeds.cast("string").alias("_seed"), F.col(path).cast("string").alias("path"), "code",
                                   *([F.col(skip).alias("_skip")] if skip else []), F.length("code").cast("bigint").alias("_n"))
    n = F.col("_n")

    def draw(k):
        h1 = F.md5(F.concat_ws(":", "_seed", F.col("path"), k.cast("string")))
        start = F.when(n > F.lit(max_len), _randint(_u(h1, 1), F.lit(0), n - F.lit(max_len))).otherwise(F.lit(0))
        return F.struct(k.alias("sample_no"), h1.alias("_h1"),
                        F.substring(F.col("code"), start + F.lit(1), max_len).alias("_win"))

    # the windows (at most max_len characters each) are cut inside the row,
    # then exploded: a large file is not copied once per draw
    numbers = F.sequence(F.lit(0), F.lit(per_file - 1))
    if skip:
        numbers = F.filter(numbers, lambda k: ~F.coalesce(F.array_contains("_skip", k), F.lit(False)))
    g = g.select(*carry, "path", F.explode(F.transform(numbers, draw)).alias("_d"))
    g = g.select(*carry, "path", F.col("_d.sample_no").alias("sample_no"), F.col("_d._h1").alias("_h1"),
                 F.md5(F.col("_d._h1")).alias("_h2"), F.col("_d._win").alias("_win"))
    g = g.where(F.instr("_win", "\n") > 0)
    L = F.length("_win").cast("bigint")
    mid_len = F.greatest(F.lit(80).cast("bigint"),
                         F.floor(L * (F.lit(0.2) + F.lit(0.2) * _u(F.col("_h1"), 14))).cast("bigint"))
    g = g.withColumn("_L", L).withColumn("_ml", mid_len).where(F.col("_ml") < F.col("_L") - 40)
    ms = _randint(_u(F.col("_h2"), 1), F.lit(20).cast("bigint"), F.col("_L") - F.col("_ml") - 20)
    g = g.withColumn("_ms", ms)
    return g.select(
        *carry, "path", "sample_no",
        F.substring("_win", F.lit(1), F.col("_ms").cast("int")).alias("prefix"),
        F.substring("_win", (F.col("_ms") + 1).cast("int"), F.col("_ml").cast("int")).alias("middle"),
        F.substr("_win", (F.col("_ms") + F.col("_ml") + 1).cast("int")).alias("suffix"),
    )


# ------------------------------------------------------------------- D4
def span_hash(prefix="prefix", middle="middle", suffix="suffix") -> Column:
    return F.md5(F.concat_ws("§", F.col(prefix), F.col(middle), F.col(suffix)))


def fim_dedupe(spans: DataFrame, order: Column | None = None) -> DataFrame:
    """Drop repeated spans (first in ``(repo, path, sample_no)`` order wins;
    the hash set is shared across repositories)."""
    o = order if order is not None else F.struct(
        *( [F.col("repo")] if "repo" in spans.columns else []), F.col("path"), F.col("sample_no"))
    s = spans.withColumn("_h", span_hash()).withColumn("_o", o)
    return keep_first(s, "_h", "_o").drop("_h", "_o")


def fim_unique(files: DataFrame, rank: Column | None = None, path: str = "path", **draw) -> DataFrame:
    """The rows of :func:`fim_dedupe` over :func:`fim_spans` of ``files``, in
    ``(rank, path, sample_no)`` order, without moving a span.

    Hashes and orders of the spans are compared alone.  The numbers of the
    repeated draws, one small row per file that has some, then meet the
    files, which are drawn again without them; the planner knows the size of
    these rows and moves no file where it can broadcast them."""
    rank = F.col("repo") if rank is None and "repo" in files.columns else F.lit(0) if rank is None else rank
    ranked = files.withColumn("_rank", rank)
    named = ranked.withColumn("repo", F.col("_rank"))  # the rank goes where spans carry a column through
    spans = fim_spans(named, path, **draw)
    slim = spans.select(span_hash().alias("_h"), F.struct(F.col("repo").alias("n"), "path", "sample_no").alias("_o"))
    again = materialize(first_flags(slim, "_h", "_o").where("not _first").groupBy("_ord.n", "_ord.path")
                        .agg(F.collect_set("_ord.sample_no").alias("_again"))
                        .select(F.col("n").alias("_again_rank"), F.col("path").alias("_again_path"), "_again"), "again")
    on = F.col("_rank").eqNullSafe(F.col("_again_rank")) & F.col(path).cast("string").eqNullSafe(F.col("_again_path"))
    return fim_spans(ranked.join(again, on, "left"), path, skip="_again", **draw)


# ------------------------------------------------------------------- P21
def fim_user(path: Column, prefix: Column, suffix: Column, style: str = "chat") -> Column:
    if style == "markers":
        return F.concat(F.lit("<PREFIX>"), prefix, F.lit("\n<MASK/>\n<SUFFIX>"), suffix)
    return F.concat(
        F.lit(K.FIM_FILE), path, F.lit("\n"), F.lit(K.FIM_INSTRUCTION),
        F.lit(K.FIM_PREFIX), prefix, F.lit(K.FIM_FILL), suffix)


def fim_example(spans: DataFrame, style: str = "chat") -> DataFrame:
    """Chat example per span: system, user (template), assistant (middle)."""
    def m(role, c):
        return F.struct(F.lit(role).alias("role"), c.alias("content"))
    if style == "markers":
        system, answer = K.FIM_MARKER_SYSTEM_PROMPT, F.concat(F.lit("<MIDDLE>"), F.col("middle"), F.lit("</MIDDLE>"))
    else:
        system, answer = K.FIM_SYSTEM_PROMPT, F.col("middle")
    msgs = F.array(
        m("system", F.lit(system)),
        m("user", fim_user(F.col("path"), F.col("prefix"), F.col("suffix"), style)),
        m("assistant", answer))
    return spans.withColumn("messages", msgs)
