"""Merge, split and sampling.

The exact-size split never funnels the eval set through one task: the
k-th smallest seeded hash is located with histograms over hash prefixes
(65,536 buckets per level, bounded whatever the data size), and the
split itself is a per-row comparison against that threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import merge_signature
from .quality import dedupe_first, duplicate_flags


# ------------------------------------------------------------------- L1
def _eval_bounds(n, rounded, min_eval, least, most):
    """Eval-set size: the rounded share, at most half the rows, but at least
    ``min_eval`` once there are that many rows (then the minimum beats the
    half, n=100 gives 99) and at least one below; one row stays for training.
    ``least`` and ``most`` compare numbers or Columns alike."""
    share = most(least(rounded, n // 2 if isinstance(n, int) else F.floor(n / 2).cast("bigint")), 0)
    floor = least(min_eval, most(n - 1, 0))
    return share, floor


def eval_size(n: int, frac: float | None = K.DEFAULT_EVAL_FRAC, size: int | None = None,
              min_eval: int = K.DEFAULT_MIN_EVAL, cap_after_min: bool = False) -> int:
    """Eval-set size for ``n`` rows: ``size`` if given, else the rule of
    :func:`_eval_bounds` on the half-even rounded share ``frac``; never all
    rows, and none of a single one.  ``cap_after_min=True`` lets the half
    beat the minimum instead."""
    if n < 2:
        return 0
    if size is not None:
        return min(size, n - 1)
    share, floor = _eval_bounds(n, round(n * (K.DEFAULT_EVAL_FRAC if frac is None else frac)), min_eval, min, max)
    low = floor if n >= min_eval else 1
    high = n // 2 if cap_after_min else n - 1
    return min(max(share, low), high, n - 1)


def eval_size_col(n: Column, frac: float = K.DEFAULT_EVAL_FRAC, min_eval: int = K.DEFAULT_MIN_EVAL) -> Column:
    """The same rule as a Column."""
    def pick(fn):
        return lambda *xs: fn(*[x if isinstance(x, Column) else F.lit(x) for x in xs])
    share, floor = _eval_bounds(n, F.rint(n * F.lit(float(frac))).cast("bigint"), min_eval, pick(F.least), pick(F.greatest))
    low = F.when(n >= F.lit(min_eval), floor).otherwise(F.lit(1))
    return F.when(n < 2, F.lit(0)).otherwise(F.least(F.greatest(share, low), n - 1)).cast("bigint")


# ------------------------------------------------------------------- D2
def merge_dedupe(df: DataFrame) -> DataFrame:
    """Cross-input dedupe on the case-keeping merge signature; first in
    input order wins.  Adds ``sig`` and ``is_dup``."""
    return dedupe_first(df.withColumn("sig", merge_signature("messages")), "sig", "ord", "is_dup")


def merge_flags(df: DataFrame) -> DataFrame:
    """(ord, sig, is_dup) of :func:`merge_dedupe` without the payload: one
    scan per input."""
    return duplicate_flags(df.select("ord", merge_signature("messages").alias("sig")), "sig", "ord", "is_dup")


def merge_report(merged: DataFrame, k_eval: int | None = None) -> DataFrame:
    """Rows per input, unique, duplicates, train and eval sizes as
    ``(item, n)`` rows, in one scan of the merged inputs (``src``,
    ``messages``).

    Input order starts with the input index, so a signature's first copy
    lives in its smallest input.  Counting per ``(signature, input)`` (a
    partial aggregate), taking the smallest input per signature (at most
    one row per input and signature), and summing per input gives every
    figure; only one row per input reaches the driver."""
    sig = merge_signature("messages") if "sig" not in merged.columns else F.col("sig")
    per = merged.groupBy(sig.alias("_sig"), F.col("src")).agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    first = per.withColumn("_first", F.min("src").over(Window.partitionBy("_sig")))
    by_src = first.groupBy("src").agg(
        F.sum("n").alias("n"), F.count_if(F.col("src") == F.col("_first")).alias("u"))
    rows = [(int(r["src"]), int(r["n"]), int(r["u"])) for r in by_src.collect()]  # one row per input
    total = sum(u for _, _, u in rows)
    dups = sum(n for _, n, _ in rows) - total
    k = eval_size(total) if k_eval is None else k_eval
    items = [(f"input_{s}", n) for s, n, _ in sorted(rows)]
    items += [("unique", total), ("duplicates", dups), ("train", total - k), ("eval", k)]
    return merged.sparkSession.createDataFrame(items, "item string, n bigint")


# ------------------------------------------------------------------- L2
def _hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def kth_smallest(df: DataFrame, h: str, k: int, level_chars: int = 4,
                 exact_below: int = 50_000) -> str | None:
    """The k-th smallest (1-based) value of hex-string column ``h``.

    Each level histograms the next ``level_chars`` hex characters inside
    the current prefix (at most 16**level_chars rows reach the driver),
    until the remaining bucket is small enough to order exactly."""
    if k <= 0:
        return None
    prefix, r = "", k
    while True:
        sub = df.where(F.col(h).startswith(prefix)) if prefix else df
        plen = len(prefix)
        hist = (sub.groupBy(F.substring(h, plen + 1, level_chars).alias("b"))
                .agg(F.count(F.lit(1)).alias("c")).orderBy("b").collect())
        cum = 0
        for row in hist:
            if cum + row["c"] >= r:
                prefix, r = prefix + row["b"], r - cum
                size = row["c"]
                break
            cum += row["c"]
        else:
            return None
        if size <= exact_below or len(prefix) >= 32:
            last = (df.where(F.col(h).startswith(prefix)).select(h)
                    .orderBy(h).limit(r).agg(F.max(h).alias("m")).collect()[0]["m"])
            return last


def _threshold(df: DataFrame, key: str, n_eval: int | None, seed: int):
    """Hash threshold for an exact-size eval set.  The search runs on a
    narrow ``(key, hash)`` projection checkpointed once into the shared
    checkpoint folder, so the count and the histogram passes never
    recompute the upstream plan."""
    from ..session import materialize
    narrow = materialize(df.select(F.col(key), _hash(F.col(key), seed).alias("_h")))
    k = eval_size(narrow.count()) if n_eval is None else n_eval
    return kth_smallest(narrow, "_h", k), k


def split(df: DataFrame, key: str, n_eval: int | None = None,
          seed: int = K.DEFAULT_SEED) -> tuple[DataFrame, DataFrame]:
    """Seeded exact-size split: eval = the ``n_eval`` rows (default: the
    eval-size rule on the row count) with the smallest ``md5(seed:key)``,
    train = the rest.  Keys must be unique.  Independent of partitioning
    and of input order."""
    thr, _ = _threshold(df, key, n_eval, seed)
    h = _hash(F.col(key), seed)
    is_eval = (h <= F.lit(thr)) if thr is not None else F.lit(False)
    return df.where(~is_eval), df.where(is_eval)


def split_label(df: DataFrame, key: str, n_eval: int | None = None,
                seed: int = K.DEFAULT_SEED) -> DataFrame:
    """``split`` as one frame with a ``split`` column ('train' / 'eval')."""
    thr, _ = _threshold(df, key, n_eval, seed)
    h = _hash(F.col(key), seed)
    lab = F.when(h <= F.lit(thr), F.lit("eval")) if thr is not None else F.lit(None)
    return df.withColumn("split", F.coalesce(lab, F.lit("train")))


# ------------------------------------------------------------------- L3
def sample_n(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """Seeded sample of ``n`` rows: the n smallest ``md5(seed:key)``
    (a top-n, planned as TakeOrderedAndProject)."""
    return df.withColumn("_h", _hash(F.col(key), seed)).orderBy("_h", key).limit(n).drop("_h")
