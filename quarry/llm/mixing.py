"""Mixing sources to target weights by weighted fair queueing.

Each source's documents, in shuffled order and repeated as often as its
target needs, get a virtual finish time: the source's words up to and with
the document, divided by the source's target.  All copies are range-sorted
by finish time and the order is cut at the total budget.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, columns_of, keyed, meet, prefix_sums, stash, word_count

MAX_REPEATS = 3
SEED = "mix-1"


def source_targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per
    source.

    Sources in code-point order, null last, weigh 1, 2, 3, repeating, and
    share the sum of all sizes; a target stops at ``max_repeats`` times the
    source's size and the excess is shared anew by weight until none is
    above.  Each turn is one aggregate over the sources; the share per
    weight only grows, so the stopped sources are those at or below it."""
    rows = stash(sizes, "sources")
    place = prefix_sums(rows, [], [F.col("source").asc_nulls_last()], index="place")
    s = stash(place.select("source", "source_size", (F.col("place") % 3 + 1).alias("weight"),
                           (F.col("source_size") * max_repeats).alias("most")), "weights")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    share, stopped = 0.0, -1
    while True:
        full = F.col("most") <= F.col("weight") * F.lit(share)
        n, held, weight = s.agg(F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0)),
                                F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))).first()
        if n == stopped or not weight:
            break
        stopped, share = n, (total - held) / weight
    full = F.col("most") <= F.col("weight") * F.lit(share)
    target = F.when(full, F.col("most").cast("double")).otherwise(F.col("weight") * F.lit(share))
    return stash(s.select("source", "source_size", target.alias("target")), "targets")


def mix(docs: DataFrame, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """One row per row of a :func:`keyed` frame: KEY, doc_id, source, size
    (words), source_size, target, copies and taken (= copies * size).

    Copies whose start lies before their source's target are queued, and the
    queue is cut where its words would pass the sum of all sizes, so a
    source ends within one document of its target unless the cut, which
    falls among such last documents, comes first.  Null text has no words;
    rows without words are never drawn.  The shuffle depends on ``seed`` and
    doc_id; ties follow doc_id (null last), size and row, so reruns agree.
    A null source is a source; repeated rows are drawn each for itself;
    empty input gives an empty result."""
    rows = stash(docs.select(KEY, "doc_id", "source", word_count().alias("size"),
                             F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))).alias("draw")), "sizes")
    goals = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), max_repeats)
    own = ["draw", F.col("doc_id").asc_nulls_last(), "size", KEY]
    queue = prefix_sums(rows, ["source"], own, value="size")
    g = goals.select(F.col("source").alias("gs"), "source_size", "target")
    lined = stash(queue.join(g, F.col("source").eqNullSafe(F.col("gs"))).drop("gs"), "lined")
    turn = F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("turn")
    end = F.col("turn") * F.col("source_size") + F.col("cum")
    copies = lined.where("size > 0").select(KEY, "draw", "doc_id", "source", "size", "source_size", "target", "cum", turn) \
        .where(end - F.col("size") < F.col("target")) \
        .select(KEY, "draw", "doc_id", "source", "size", "turn", (end / F.col("target")).alias("finish"))
    order = ["finish", F.col("source").asc_nulls_last(), *own]
    total = goals.agg(F.sum("source_size")).first()[0] or 0
    drawn = prefix_sums(stash(copies, "copies"), [], order, value="size", cum="all_words").where(F.col("all_words") <= total)
    taken = stash(drawn.groupBy(F.col(KEY).alias("k")).agg(F.count("*").alias("copies")), "drawn")
    n = F.coalesce("copies", F.lit(0)).cast("bigint")
    return lined.join(taken, F.col(KEY) == F.col("k"), "left").select(
        KEY, "doc_id", "source", "size", "source_size", "target", n.alias("copies"), (n * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """``docs`` as the mix takes them: a row drawn n times stands n times."""
    rows = keyed(docs)
    times = f"{KEY}_times"
    n = stash(mix(rows, max_repeats, seed).where("copies > 0").select(F.col(KEY).alias(f"{KEY}_of"), F.col("copies").alias(times)), "copies")
    drawn = meet(rows, n, F.col(KEY) == F.col(f"{KEY}_of"), "inner")
    return drawn.withColumn(times, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(times)))).select(*columns_of(docs))
