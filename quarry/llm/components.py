"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stash


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo")), F.sum(F.crc32(F.concat_ws(":", "hi", "lo")))).first())


def _star(edges: DataFrame, by: str, smallest: DataFrame) -> DataFrame:
    """``edges`` with the smallest neighbour ``m`` of their node ``by``.
    ``smallest`` is stored first, so both join sides are plain shuffles and
    a node with very many edges is split by the skew join."""
    m = stash(smallest, "star")
    return edges.join(m, F.col(by) == F.col("u")).drop("u")


def components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, root) for every node of the links ``a``-``b`` (numbers)
    that is not the smallest of its component; root is the smallest.

    Only links, per-node minima and one summary row per round are made;
    links and components never reach the driver.  Self-links and repeated
    links are allowed; null ends are ignored; no links give no rows."""
    x, y = F.col(a), F.col(b)
    edges = stash(pairs.where(x != y).select(F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo")).distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        near = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = stash(_star(edges, "lo", near).select("hi", F.col("m").alias("lo")).distinct(), "large")
        least = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        joined = _star(large, "hi", least)
        small = joined.where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")) \
            .unionAll(joined.select("hi", F.col("m").alias("lo"))).distinct()
        after = stash(small, "small")
        new = _mark(after)
        discard(edges)
        discard(large)
        edges = after
        if new == mark:
            break
        mark = new
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
