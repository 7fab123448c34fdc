"""The skew-safe segmented scan equals the plain window, hot key included."""

import random

from pyspark.sql import functions as F

from quarry.operators.scan import running_sums


def test_running_sums_and_maxes_match_window(spark):
    rng = random.Random(11)
    rows = []
    for i in range(6000):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randint(0, 50)}"
        rows.append((key, rng.choice(["", "2024-01-0" + str(rng.randint(1, 9))]), i,
                     rng.randint(0, 1), rng.choice([None, rng.randint(0, 1000)])))
    df = spark.createDataFrame(rows, "k string, t string, ord long, f int, v int")
    flags = {"s": F.col("f")}
    maxes = {"m": F.when(F.col("f") == 1, F.struct("t", "ord", "v"))}
    safe = running_sums(df, ["k"], ["t", "ord"], flags, skew_safe=True, partitions=16, maxes=maxes)
    plain = running_sums(df, ["k"], ["t", "ord"], flags, skew_safe=False, maxes=maxes)
    a = sorted(tuple(r) for r in safe.select("ord", "s", "m").collect())
    b = sorted(tuple(r) for r in plain.select("ord", "s", "m").collect())
    assert a == b
    # the hot key really was spread over several range partitions
    from quarry.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    parts = (df.repartitionByRange(16, "k", "t", "ord").withColumn("p", F.spark_partition_id())
             .where(F.col("k") == "hot").select("p").distinct().count())
    assert parts > 1


def test_hot_key_is_split_evenly(spark):
    # 40% of 20,000 rows under one key: after the range partitioning used by
    # the scan, no partition holds much more than its fair share
    from quarry.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    df = spark.range(20000).select(
        F.when(F.col("id") % 5 < 2, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"),
        F.col("id").alias("ord"))
    sizes = [r["n"] for r in df.repartitionByRange(16, "k", "ord").withColumn("p", F.spark_partition_id())
             .groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 0.15 * 20000     # fair share is 1/16 = 6.25 %; the hot key alone is 40 %
