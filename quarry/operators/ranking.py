"""Top-n per group without funnelling a hot group through one task.

A histogram of the order key in fixed-width buckets (a partial aggregate)
locates, per group, the boundary bucket where the running count reaches
``n``; null order keys form the last bucket.  Rows in better buckets are
kept outright.  The boundary buckets are numbered by the segmented scan
(``scan.running_sums``), so one bucket with very many rows - imported
history with one timestamp - is still spread over tasks.  There is one
path for every ``n``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from ..session import materialize
from .scan import running_sums

_LAST = (1 << 63) - 1


def _bucket(df: DataFrame, order: Column, width: float) -> Column:
    """Bucket number of a time or number that never decreases along it."""
    kind = df.select(order).schema[0].dataType
    if isinstance(kind, TimestampType):
        return F.floor(F.unix_micros(order) / F.lit(width * 1e6)).cast("bigint")
    if isinstance(kind, TimestampNTZType):  # by day: no session zone takes part
        return F.datediff(order.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return F.floor(order.cast("double") / F.lit(width)).cast("bigint")


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Column, n: int,
                    tiebreak: Column, descending: bool = True,
                    bucket_width: float = 3600.0, bucket: Column | None = None,
                    key: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows of each group by ``order`` (null last either
    way), then ``tiebreak``.  ``bucket`` must be a long that never decreases
    along ``order`` (default: hours of a timestamp, days of one without a
    zone, ``bucket_width`` steps of a number).  Null groups are a group.

    The rows are stored once for the histogram, the head and the boundary;
    with ``key``, columns that tell rows apart, only key, group and order
    are, and the payload meets the winners' keys."""
    plain = _bucket(df, order, bucket_width) if bucket is None else bucket.cast("bigint")
    b = F.when(order.isNull(), F.lit(_LAST)).otherwise(F.coalesce(-plain if descending else plain, F.lit(_LAST)))
    if key is not None:
        cols = list(dict.fromkeys([*key, *group]))
        narrow = df.select(*cols, order.alias("_order"), tiebreak.alias("_tie"), plain.alias("_bucket"))
        won = top_n_per_group(narrow, group, F.col("_order"), n, F.col("_tie"), descending, bucket=F.col("_bucket"))
        won = won.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)])
        on = F.lit(True)
        for i, k in enumerate(key):
            on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        return df.join(won, on, "left_semi")
    x = materialize(df.select("*", b.alias("_b")), "ranked")
    hist = x.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_c"))
    wc = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the boundary is the first bucket whose running count reaches n; its row
    # also says how many rows the better buckets hold
    bound = (hist.withColumn("_before", F.sum("_c").over(wc) - F.col("_c"))
             .where((F.col("_before") < n) & (F.col("_before") + F.col("_c") >= n))
             .select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_b").alias("_bb"), "_before"))
    on = F.lit(True)
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    j = x.join(bound, on, "left")
    head = j.where(F.col("_bb").isNull() | (F.col("_b") < F.col("_bb"))).select(*df.columns)
    edge = j.where(F.col("_b") == F.col("_bb")).select(*df.columns, "_before")
    o = order.desc_nulls_last() if descending else order.asc_nulls_last()
    numbered = running_sums(edge, list(group), [o, tiebreak.asc_nulls_last()], {"_rn": F.lit(1)})
    return head.unionByName(numbered.where(F.col("_before") + F.col("_rn") <= n).select(*df.columns))
