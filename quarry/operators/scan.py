"""Skew-safe running counts over ordered groups.

A plain ``sum(x) OVER (PARTITION BY key ORDER BY o)`` puts every row of a
key into one task.  Session keys are not bounded (records without a
session id all land in one ``"default"`` session), so the running count
is computed as a segmented prefix sum instead:

1. range-partition on ``(key, order)`` - the sampled bounds include the
   order columns, so one hot key is split over many partitions;
2. pin each row's partition number by storing the rows below the shared
   ``spark.checkpoint.dir``, which also cuts lineage;
3. running sum within ``(partition, key)`` (bounded by one partition);
4. per ``(partition, key)`` totals - a partial aggregate with at most
   ``#keys + #partitions`` rows - turned into offsets by a prefix sum over
   partition number;
5. add the offsets back with an equi-join on ``(partition, key)``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def running_sums(df: DataFrame, key: Sequence[str], order: Sequence[str],
                 flags: dict[str, Column], skew_safe: bool = True,
                 partitions: int | None = None,
                 maxes: dict[str, Column] | None = None,
                 row_id: str | None = None) -> DataFrame:
    """Add inclusive running aggregates per ``key`` in ``order`` (a total
    order): one running sum per entry of ``flags`` (name -> integer
    Column) and one running max per entry of ``maxes`` (name -> orderable
    Column, nulls ignored).  Null keys are a key of their own.

    With ``row_id`` (a unique column) the skew-safe scan runs on a narrow
    projection - key, order, flags - and the results are joined back on
    the row id: the payload (texts) is shuffled once for that join instead
    of being range-partitioned, checkpointed and shuffled again."""
    maxes = maxes or {}
    if skew_safe and row_id is not None:
        narrow = df.select(row_id, *key, *[c for c in order if c != row_id],
                           *[c.alias(f"_nf_{n}") for n, c in flags.items()],
                           *[c.alias(f"_nm_{n}") for n, c in maxes.items()])
        res = running_sums(narrow, key, order, {n: F.col(f"_nf_{n}") for n in flags},
                           skew_safe=True, partitions=partitions,
                           maxes={n: F.col(f"_nm_{n}") for n in maxes})
        back = res.select(F.col(row_id).alias("_rid"), *list(flags), *list(maxes))
        return df.join(back, df[row_id] == back["_rid"], "inner").drop("_rid")
    base = df.select("*", *[c.cast("bigint").alias(f"_f_{n}") for n, c in flags.items()],
                     *[c.alias(f"_m_{n}") for n, c in maxes.items()])

    def local_aggs(w):
        return ([F.sum(f"_f_{n}").over(w).alias(f"_l_{n}") for n in flags]
                + [F.max(f"_m_{n}").over(w).alias(f"_lm_{n}") for n in maxes])

    helpers = [f"_f_{n}" for n in flags] + [f"_m_{n}" for n in maxes]
    if not skew_safe:
        w = (Window.partitionBy(*key).orderBy(*_cols(order))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        out = base.select("*", *local_aggs(w))
        for n in flags:
            out = out.withColumnRenamed(f"_l_{n}", n)
        for n in maxes:
            out = out.withColumnRenamed(f"_lm_{n}", n)
        return out.drop(*helpers)

    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The range partitioner samples its input in a separate job; storing the
    # input keeps the upstream work (e.g. VARIANT parsing) to one pass.
    base = materialize(base, "scan")
    ranged = materialize(base.repartitionByRange(n_parts, *_cols(key), *_cols(order))
                         .withColumn("_pid", F.spark_partition_id()))

    wl = (Window.partitionBy("_pid", *key).orderBy(*_cols(order))
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select("*", *local_aggs(wl))

    totals = ranged.groupBy("_pid", *key).agg(
        *[F.sum(f"_f_{n}").alias(f"_t_{n}") for n in flags],
        *[F.max(f"_m_{n}").alias(f"_tm_{n}") for n in maxes])
    wo = Window.partitionBy(*key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_pid").alias("_opid"), *[F.col(k).alias(f"_ok_{k}") for k in key],
        *[F.coalesce(F.sum(f"_t_{n}").over(wo), F.lit(0)).alias(f"_o_{n}") for n in flags],
        *[F.max(f"_tm_{n}").over(wo).alias(f"_om_{n}") for n in maxes])

    cond = F.col("_pid") == F.col("_opid")
    for k in key:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_ok_{k}"))
    joined = local.join(offsets, cond, "inner")
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n) for n in flags],
        *[F.greatest(F.col(f"_lm_{n}"), F.col(f"_om_{n}")).alias(n) for n in maxes])
