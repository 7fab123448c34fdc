"""Length statistics and reports.

Quantiles by index rule (floor, scan) are answered from a histogram:
``groupBy(value).count()`` is a partial aggregate whose size is the
number of distinct lengths (bounded by the longest example, not by the
row count); a cumulative sum over that small table locates each rank.
Linear interpolation reads the two neighbouring order statistics from the
same histogram.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pname(p: float) -> str:
    s = f"{p * 100:g}" if p <= 1 else f"{p:g}"
    return "p" + s.replace(".", "_")


def length_stats(df: DataFrame, c: str, probs: Sequence[float] = (0.5, 0.75, 0.9, 0.95),
                 rule: str = "floor", approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """One row of length statistics, all from one histogram of the values.

    floor  (A2): ``sorted[int(p*(n-1))]``, plus n, max and truncated mean.
    scan   (A3): ``sorted[min(n-1, int(p/100*n))]`` with p in percent,
                 plus n, min and max; empty input gives nulls.
    linear (A4): numpy-style interpolation between the order statistics
                 at ``floor(p*(n-1))`` and the next one, plus n, min, max,
                 mean and median.

    ``groupBy(value).count()`` is a partial aggregate whose size is the
    number of distinct lengths (bounded by the longest example, not by the
    row count); a cumulative sum over that small table locates each rank.
    Spark's exact ``percentile`` is not used: it buffers every value.

    The histogram is bounded only for integral values (lengths).  A
    fractional column could have as many distinct values as rows, so it is
    refused here (:func:`number_stats` takes it) unless ``approx=True``, which
    answers every rule with ``percentile_approx`` (bounded memory, rank error
    about 1/accuracy).
    """
    from pyspark.sql.types import DecimalType, DoubleType, FloatType
    v = F.col(c)
    fractional = isinstance(df.schema[c].dataType, (DoubleType, FloatType, DecimalType))
    if approx:
        ps = [float(p) / 100.0 if (rule == "scan" and p > 1) else float(p) for p in probs]
        q = F.percentile_approx(v, ps, accuracy)
        aggs = [F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean")]
        aggs += [F.get(q, i).alias(_pname(p)) for i, p in enumerate(probs)]
        return df.agg(*aggs)
    if fractional:
        raise ValueError(f"length_stats: '{c}' is fractional; the exact rules need integral "
                         "lengths (bounded histogram) - use number_stats, or pass approx=True")
    hist = df.where(v.isNotNull()).groupBy(v.alias("v")).agg(F.count(F.lit(1)).alias("cnt"))
    w_all = Window.partitionBy(F.lit(1))  # un-partitioned: one row per distinct length
    w_cum = w_all.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = hist.select("v", "cnt", F.sum("cnt").over(w_cum).alias("cum"),
                    F.sum("cnt").over(w_all).alias("n"),
                    F.sum(F.col("v") * F.col("cnt")).over(w_all).alias("total"))

    def at(i: Column) -> Column:
        """The order statistic with 0-based index ``i``."""
        return F.min(F.when(F.col("cum") > i, F.col("v")))

    if rule == "linear":
        def interp(p: float) -> Column:
            idx = F.lit(float(p)) * (F.col("n") - 1)
            lo = F.floor(idx)
            frac = F.max(idx - lo)
            v_lo = at(lo).cast("double")
            v_hi = at(F.least(lo + 1, F.col("n") - 1)).cast("double")
            return v_lo + frac * (v_hi - v_lo)
        aggs = [F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias("n"),
                F.min("v").cast("double").alias("min"), F.max("v").cast("double").alias("max"),
                (F.max("total") / F.max("n")).cast("double").alias("mean"),
                interp(0.5).alias("median")]
        aggs += [interp(p).alias(_pname(p)) for p in probs]
        return h.agg(*aggs)

    def idx(p: float) -> Column:
        if rule == "floor":
            return F.floor(F.lit(float(p)) * (F.col("n") - 1))
        return F.least(F.col("n") - 1, F.floor(F.lit(float(p)) / F.lit(100.0) * F.col("n")))

    aggs = [F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias("n")]
    if rule == "scan":
        aggs.append(F.min("v").alias("min"))
    aggs += [at(idx(p)).alias(_pname(p)) for p in probs]
    aggs.append(F.max("v").alias("max"))
    if rule == "floor":
        aggs.append(F.floor(F.max("total") / F.max("n")).cast("bigint").alias("mean"))
    return h.agg(*aggs)


def number_stats(df: DataFrame, c: str, probs: Sequence[float] = (0.5, 0.75, 0.9, 0.95), rule: str = "floor") -> DataFrame:
    """:func:`length_stats` of a column of any numbers, as exact: the order
    statistics are searched between the bounds of a quantile sketch
    (``quantiles.order_statistics``), so no value is collected and no
    histogram grows with the rows.  The mean is a sum of doubles."""
    import math

    from .quantiles import order_statistics
    v = F.col(c)
    n, least, most, mean = df.agg(F.count(v), F.min(v), F.max(v), F.avg(v)).first()
    linear = rule == "linear"
    wanted = [0.5, *probs] if linear else list(probs)
    places = [p / 100 * n if rule == "scan" else p * (n - 1) for p in wanted]
    ranks = [min(max(n - 1, 0), math.floor(x)) for x in places]
    got = order_statistics(df, c, ranks + ([min(r + 1, n - 1) for r in ranks] if linear else []))
    values = got[:len(ranks)]
    if linear:
        values = [None if a is None else float(a) + (x - r) * (float(z) - float(a)) for a, z, x, r in zip(values, got[len(ranks):], places, ranks, strict=True)]
    named = dict(zip((["median"] if linear else []) + [_pname(p) for p in probs], values, strict=True))
    kind = "double" if linear else df.schema[c].dataType.simpleString()

    def cell(x, name, to=kind):
        return F.lit(x).cast(to).alias(name)
    row = [cell(n, "n", "bigint")] + ([cell(least, "min")] if rule != "floor" else [])
    row += [cell(most, "max"), cell(mean, "mean", "double")] if linear else []
    row += [cell(x, name) for name, x in named.items()]
    row += [cell(most, "max")] if not linear else []
    row += [cell(None if mean is None else math.floor(mean), "mean", "bigint")] if rule == "floor" else []
    return df.sparkSession.range(1).select(*row)


# ------------------------------------------------------------------- A5
def clip_report(df: DataFrame) -> DataFrame:
    """kept / clipped / dropped from a frame with ``clip_status``."""
    s = F.col("clip_status")
    return df.agg(
        F.count_if(s.isin("kept", "clipped")).cast("bigint").alias("kept"),
        F.count_if(s == "clipped").cast("bigint").alias("clipped"),
        F.count_if(s == "dropped").cast("bigint").alias("dropped"),
    )


def clip_tokens(df: DataFrame, cap: int, text: str = "text", mode: str = "truncate",
                counter: str = "char4") -> DataFrame:
    """Mark each row kept, clipped or dropped and rewrite
    ``text`` (char-estimate counter: the longest prefix whose estimate is
    within the cap).  Empty text is dropped."""
    from ..functions.text import clip_estimate, text_token_estimate
    n_tok = text_token_estimate(text)
    t = F.coalesce(F.col(text), F.lit(""))
    status = (F.when(t == F.lit(""), F.lit("dropped"))
              .when(n_tok <= F.lit(cap), F.lit("kept"))
              .otherwise(F.lit("dropped" if mode == "drop" else "clipped")))
    out = df.withColumn("n_tok", n_tok).withColumn("clip_status", status)
    return out.withColumn(text, F.when(F.col("clip_status") == "clipped", clip_estimate(text, cap))
                          .otherwise(F.col(text)))


# ------------------------------------------------------------------- A7
def harvest_report(*frames: tuple[str, DataFrame]) -> DataFrame:
    """Examples written per kind."""
    out = None
    for kind, df in frames:
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------------- A8
def dataset_stats(df: DataFrame, by: str = "source", length: str = "n_tok") -> DataFrame:
    """Examples and average length per group plus a total row
    (``rollup`` + ``grouping``)."""
    return (df.rollup(by).agg(
        F.count(F.lit(1)).alias("examples"),
        F.round(F.avg(length), 4).alias("avg_len"),
        F.grouping(by).alias("is_total"))
        .select(F.when(F.col("is_total") == 1, F.lit("TOTAL")).otherwise(F.col(by)).alias(by),
                "examples", "avg_len"))


# ------------------------------------------------------------------- A9
def balance(df: DataFrame, by: str, n: int, key: str, seed: int = 42) -> DataFrame:
    """Cap every group to ``n`` rows in seeded hash order: a per-group
    histogram over 16-bit hash prefixes, then only the boundary buckets are
    ranked (``ranking.top_n_per_group``).  ``key`` must be unique."""
    from .ranking import top_n_per_group
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    prefix = F.conv(F.substring(h, 1, 4), 16, 10).cast("bigint")
    return top_n_per_group(df, [by], h, n, tiebreak=F.col(key), descending=False, bucket=prefix, key=[key])


# ------------------------------------------------------------------- L7
def length_buckets(df: DataFrame, length: str, width: int, partitions: int | None = None) -> DataFrame:
    """Bucket id ``floor(len/width)``; rows of similar length are laid out
    together (range partition + local sort) for padding-friendly batches.
    A hash of the row breaks ties, so rows of one very frequent length - the
    normal shape after clipping to a cap - spread over several partitions."""
    out = df.withColumn("bucket", F.floor(F.col(length) / F.lit(width)).cast("bigint"))
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return out.repartitionByRange(n, "bucket", length, tie).sortWithinPartitions("bucket", length)
