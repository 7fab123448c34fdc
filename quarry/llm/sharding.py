"""Shards by vector bin packing.

Rows with equal texts form a group with a vector (bytes, tokens, rows).  A
group goes to the shard whose residual capacity has the largest dot product
with it.  Few groups are large; these are placed first, one after another.
The many small ones are placed in parallel, each task against its share of
the capacity that the large ones left.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, prefix_sums, stash, text_of, word_count

SHARDS = 16
#: A group of over a shard's capacity / LARGE in any dimension is large; at most 3 * LARGE * shards groups are.
LARGE = 32
#: Small groups that one task places.
TASK_GROUPS = 50_000
DIMENSIONS = ("bytes", "tokens", "rows")
#: Bytes must come out near equal; words and rows as far as that allows.
WEIGHTS = np.array([10.0, 1.0, 1.0])


def place(items: np.ndarray, residual: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Shard of each item (n x dimensions), largest first; ``residual``
    (shards x dimensions) is used up.  ``scale`` makes dimensions alike."""
    out = np.zeros(len(items), np.int64)
    scale = scale / WEIGHTS
    unit, left = items / scale, residual / scale
    for i in np.argsort(-unit.max(axis=1), kind="stable") if len(items) else ():
        s = int(np.argmax(left @ unit[i]))
        left[s] -= unit[i]
        out[i] = s
    residual[:] = left * scale
    return out


def _place_small(share: np.ndarray):
    """mapInArrow function: all groups of a task against ``share`` (shards x
    dimensions, each column summing to one) of the task's own totals."""
    def run(batches):
        got = [b for b in batches if b.num_rows]
        if got:
            t = pa.Table.from_batches(got).combine_chunks()
            t = t.sort_by([("grp", "ascending"), ("chunk", "ascending")])
            items = np.stack([t.column(c).to_numpy().astype(float) for c in DIMENSIONS], axis=1)
            total = items.sum(axis=0)
            shard = place(items, share * total, np.maximum(total / len(share), 1e-9))
            yield from pa.table({"grp": t.column("grp"), "chunk": t.column("chunk"), "shard": pa.array(shard, pa.int32())}).to_batches(65536)
    return run


def shard_rows(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of a :func:`keyed` frame: KEY, doc_id, size, text_crc32,
    shard (from 0) and slot (from 0 within the shard, without gaps).

    Shards are near equal in bytes (UTF-8 length plus 1), words and rows.
    Rows with equal texts (null: empty) share a shard, unless the group
    alone is more than one shard's capacity: then it is dealt by row into
    as many even chunks as there are shards.  Groups are told by a 64-bit hash; a
    collision would only keep two texts together.  Repeated rows are rows of
    one group; empty input gives an empty result."""
    spark = docs.sparkSession
    rows = stash(docs.select(
        KEY, "doc_id", (F.octet_length(text_of()) + 1).cast("bigint").alias("size"), F.crc32(text_of().cast("binary")).alias("text_crc32"),
        word_count().alias("tokens"), F.xxhash64(text_of()).alias("grp")), "sizes")
    sums = [F.sum("size").cast("double").alias("bytes"), F.sum("tokens").cast("double").alias("tokens"), F.count("*").cast("double").alias("rows")]
    total = np.array([x or 0.0 for x in rows.agg(*sums).first()])
    capacity = np.maximum(total / shards, 1e-9)
    over = F.greatest(*[F.col(d) / F.lit(float(c)) for d, c in zip(DIMENSIONS, capacity, strict=True)])
    whole = stash(rows.groupBy("grp").agg(*sums).withColumn("over", over), "groups")
    # at most 3 * shards groups exceed a capacity
    hot = whole.where("over > 1").select(F.col("grp").alias("hgrp"), F.lit(shards).alias("chunks"))
    rows = stash(rows.join(F.broadcast(hot), F.col("grp") == F.col("hgrp"), "left").withColumn(
        "chunk", F.coalesce(F.pmod(F.xxhash64(KEY), F.col("chunks")), F.lit(0)).cast("bigint")).drop("hgrp", "chunks"), "chunks")
    units = stash(rows.groupBy("grp", "chunk").agg(*sums).withColumn("over", over), "units")
    large = units.where(F.col("over") > 1 / LARGE).drop("over")
    big = large.orderBy("grp", "chunk").collect()  # bounded: see LARGE
    residual = np.tile(total / shards, (shards, 1))
    at = place(np.array([[r[d] for d in DIMENSIONS] for r in big]).reshape(-1, len(DIMENSIONS)), residual, capacity)
    share = np.maximum(residual, 0)
    share = share / np.maximum(share.sum(axis=0), 1e-9)
    few = units.where(F.col("over") <= 1 / LARGE).drop("over")
    n = max(1, math.ceil(few.count() / TASK_GROUPS))
    placed = few.repartition(n, "grp", "chunk").mapInArrow(_place_small(share), "grp bigint, chunk bigint, shard int")
    first = spark.createDataFrame([(r.grp, r.chunk, int(s)) for r, s in zip(big, at, strict=True)], "grp bigint, chunk bigint, shard int")
    homes = stash(placed.unionAll(first), "homes").select(F.col("grp").alias("hg"), F.col("chunk").alias("hc"), "shard")
    out = stash(rows.join(homes, (F.col("grp") == F.col("hg")) & (F.col("chunk") == F.col("hc")))
                .select(KEY, "doc_id", "size", "text_crc32", "shard"), "sharded")
    return prefix_sums(out, ["shard"], [KEY], index="slot").drop("cum")
