"""QC cascade literals, dedupe, split/eval size, quantile rules, ranking."""

import random

from pyspark.sql import functions as F

from quarry.operators import quality as Q
from quarry.operators import ranking as R
from quarry.operators import split as SP
from quarry.operators import stats as ST

MSG = "array<struct<role:string,content:string>>"
LONG_USER = "u" * 90


def ex(spark, rows):
    return spark.createDataFrame(rows, f"ord int, messages {MSG}, bad_json boolean")


def test_qc_one_row_per_reason(spark):
    ok = [("user", LONG_USER), ("assistant", "a")]
    long_ = [("user", LONG_USER), ("assistant", "z" * 5000)]
    rows = [
        (0, None, True),                                            # bad_json
        (1, [("user", LONG_USER)], False),                          # no_assistant
        (2, [("User", LONG_USER), ("assistant", "a")], False),      # role 'User' is not user
        (3, [("user", "short"), ("assistant", "a")], False),        # short_user
        (4, long_, False),                                          # too_long, claims the signature
        (5, [("user", LONG_USER), ("assistant", "Z" * 5000)], False),  # case copy -> duplicate
        (6, ok, False),                                             # kept
        (7, [("user", "  " + LONG_USER + " "), ("assistant", " a")], False),  # padded copy -> duplicate
        (8, [("user", " \t "), ("assistant", "a")], False),         # blank user -> no_user
    ]
    out = Q.qc(ex(spark, rows), max_tokens=1000)
    got = {r["ord"]: r["drop_reason"] for r in out.collect()}
    assert got == {0: "bad_json", 1: "no_assistant", 2: "no_user", 3: "short_user", 4: "too_long",
                   5: "duplicate", 6: "kept", 7: "duplicate", 8: "no_user"}
    rep = {r["drop_reason"]: (r["n"], r["pct"]) for r in Q.drop_report(out).collect()}
    assert rep["duplicate"] == (2, 22.2) and "kept" not in rep


def test_merge_keeps_case_copies(spark):
    a = [("user", "Q"), ("assistant", "A")]
    b = [("user", "q"), ("assistant", "a")]
    df = spark.createDataFrame([((0, 0), 0, a), ((0, 1), 0, b), ((1, 0), 1, a)],
                               f"ord struct<s:int,i:int>, src int, messages {MSG}")
    d = SP.merge_dedupe(df)
    got = sorted((r["ord"]["s"], r["ord"]["i"], r["is_dup"]) for r in d.collect())
    assert got == [(0, 0, False), (0, 1, False), (1, 0, True)]


def test_dedupe_hot_key(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "ord int, key string").repartition(16)
    d = Q.dedupe_first(df, "key", "ord")
    assert d.where(~F.col("is_dup")).count() == 1 + 2000
    assert d.where((F.col("key") == "hot") & ~F.col("is_dup")).collect()[0]["ord"] == 0


def test_eval_size_rule():
    ns = [0, 1, 2, 5, 10, 99, 100, 101, 150, 200, 666, 667, 1000, 7500]
    want = [0, 0, 1, 1, 2, 15, 99, 100, 100, 100, 100, 100, 150, 1125]
    assert [SP.eval_size(n) for n in ns] == want


def test_eval_size_column(spark):
    ns = [0, 1, 2, 5, 10, 99, 100, 101, 150, 200, 666, 667, 1000, 7500]
    df = spark.createDataFrame([(n,) for n in ns], "n long")
    got = [r["k"] for r in df.select(SP.eval_size_col(F.col("n")).alias("k")).collect()]
    assert got == [SP.eval_size(n) for n in ns]


def test_split_exact_and_disjoint(spark):
    df = spark.range(0, 5000).withColumn("key", F.col("id").cast("string"))
    tr, ev = SP.split(df, "key", 777, seed=42)
    assert ev.count() == 777 and tr.count() == 5000 - 777
    assert tr.join(ev, "key").count() == 0
    # deeper prefix levels give the same answer
    h = df.withColumn("_h", F.md5(F.concat(F.lit("42:"), F.col("key"))))
    assert SP.kth_smallest(h, "_h", 777, level_chars=1, exact_below=10) == SP.kth_smallest(h, "_h", 777)
    assert SP.kth_smallest(h, "_h", 777) == sorted(r["_h"] for r in h.collect())[776]


def test_quantile_rules(spark):
    df = spark.createDataFrame([(v,) for v in [3, 1, 4, 1, 5, 9, 2, 6, 5, 3]], "v long")
    fl = ST.length_stats(df, "v", (0.5, 0.9, 0.95), "floor").collect()[0]
    sc = ST.length_stats(df, "v", (50, 90, 95), "scan").collect()[0]
    li = ST.length_stats(df, "v", (0.9, 0.95), "linear").collect()[0]
    assert (fl["p50"], fl["p90"], fl["p95"]) == (3, 6, 6)
    assert (sc["p50"], sc["p90"], sc["p95"]) == (4, 9, 9)
    assert (li["median"], round(li["p90"], 6), round(li["p95"], 6)) == (3.5, 6.3, 7.65)
    assert fl["mean"] == int(39 / 10)


def test_clip_statuses(spark):
    df = spark.createDataFrame([(1, "x" * 40), (2, "x" * 41), (3, ""), (4, "y" * 400)], "id int, text string")
    c = ST.clip_tokens(df, 10, "text").collect()
    st = {r["id"]: (r["clip_status"], len(r["text"])) for r in c}
    assert st == {1: ("kept", 40), 2: ("kept", 41), 3: ("dropped", 0), 4: ("clipped", 43)}


def test_top_n_large_path_matches_window(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["main"] * 8 + ["dev"]), f"c{i}", i * 600 + rng.randint(0, 599)) for i in range(4000)]
    df = spark.createDataFrame(rows, "ref string, sha string, t long").withColumn(
        "ts", F.timestamp_seconds("t"))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        big = R.top_n_per_group(df, ["ref"], F.col("ts"), 500, F.col("sha"))
        got = sorted((r["ref"], r["sha"]) for r in big.collect())
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    exp = []
    for ref in ("main", "dev"):
        rs = sorted([r for r in rows if r[0] == ref], key=lambda r: (-r[2], r[1]))[:500]
        exp += [(r[0], r[1]) for r in rs]
    assert got == sorted(exp)


def test_single_pass_qc_equals_per_row(spark):
    rng = random.Random(3)
    users = [LONG_USER, LONG_USER.upper(), "short", "  ", "v" * 100]
    rows = []
    for i in range(300):
        msgs = [("user", rng.choice(users))]
        if rng.random() < 0.9:
            msgs.append(("assistant", rng.choice(["a", "b" * 3000, "A"])))
        rows.append((i, msgs, rng.random() < 0.05))
    df = ex(spark, rows)
    per_row = Q.qc(df, max_tokens=500)
    a = {r["drop_reason"]: (r["n"], r["pct"]) for r in Q.drop_report(per_row, include_kept=True).collect()}
    g = Q.qc_groups(df)
    b = {r["drop_reason"]: (r["n"], r["pct"]) for r in Q.qc_report(g, 500, include_kept=True).collect()}
    assert a == b
    kept = sorted(r["ord"] for r in per_row.where(F.col("drop_reason") == "kept").collect())
    assert sorted(r["ord"] for r in Q.qc_clean(df, g, 500).collect()) == kept


def test_top_n_has_one_answer_for_every_n(spark):
    """Null times come last, ties follow the sha, on both sides of 1,000."""
    from quarry.operators.ranking import top_n_per_group
    rng = random.Random(5)
    rows = [(rng.choice(["r", None]), None if rng.random() < 0.1 else rng.randrange(40) * 900, f"{i:05d}") for i in range(4000)]
    df = spark.createDataFrame(rows, "repo string, at long, sha string").withColumn("at", F.timestamp_seconds("at"))
    for n in (1, 7, 1000, 1001, 1900, 5000):
        got = top_n_per_group(df, ["repo"], F.col("at"), n, F.col("sha"))
        want = []
        for g in ("r", None):
            own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
            want += [r[2] for r in own[:n]]
        assert sorted(r["sha"] for r in got.collect()) == sorted(want)


def test_length_buckets_spread_one_length(spark):
    from quarry.operators import stats as STS
    df = spark.range(40000).select("id", F.when(F.col("id") % 2 == 0, F.lit(300)).otherwise(F.col("id") % 900).alias("n"))
    out = STS.length_buckets(df, "n", 100, 8).withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert max(r["count"] for r in out) < 40000 / 8 * 1.6


def test_first_of_a_key_is_a_hash_aggregate(spark):
    df = spark.range(5000).select(F.struct(F.lit(0).alias("src"), F.col("id").alias("n")).alias("ord"), F.md5((F.col("id") % 700).cast("string")).alias("k"),
                                  F.repeat(F.lit("x"), 50).alias("payload"))
    flags = Q.duplicate_flags(df, "k")
    flags.collect()
    assert "SortAggregate" not in flags._jdf.queryExecution().executedPlan().toString()
    assert flags.where("not is_dup").count() == 700 == Q.keep_first(df, "k").count()
    assert {r["ord"]["n"] for r in Q.keep_first(df, "k").collect()} == set(range(700))


def test_results_unchanged_under_repartition(spark):
    rng = random.Random(9)
    users = [LONG_USER, LONG_USER.upper(), "short", "w" * 120]
    rows = [(i, [("user", rng.choice(users)), ("assistant", rng.choice(["a", "b"]))], False) for i in range(400)]
    df = ex(spark, rows)
    base = sorted((r["ord"], r["drop_reason"]) for r in Q.qc(df, max_tokens=500).collect())
    keys = spark.range(0, 3000).withColumn("key", F.col("id").cast("string"))
    split0 = sorted(r["key"] for r in SP.split_label(keys, "key", 300).where("split = 'eval'").collect())
    for n in (1, 7, 64):
        again = sorted((r["ord"], r["drop_reason"]) for r in Q.qc(df.repartition(n), max_tokens=500).collect())
        assert again == base
        s = sorted(r["key"] for r in SP.split_label(keys.repartition(n), "key", 300).where("split = 'eval'").collect())
        assert s == split0 and len(s) == 300


def test_merge_report_single_scan(spark):
    rng = random.Random(4)
    texts = ["a", "b", "c", "d", "A", "e"]
    rows = [((s, i), s, [("user", rng.choice(texts)), ("assistant", rng.choice(texts))])
            for s in range(3) for i in range(60)]
    df = spark.createDataFrame(rows, f"ord struct<s:int,i:int>, src int, messages {MSG}")
    d = SP.merge_dedupe(df).collect()
    uniq = sum(not r["is_dup"] for r in d)
    rep = {r["item"]: r["n"] for r in SP.merge_report(df).collect()}
    assert rep["unique"] == uniq and rep["duplicates"] == 180 - uniq
    assert [rep[f"input_{s}"] for s in range(3)] == [60, 60, 60]
    assert rep["eval"] == SP.eval_size(uniq) and rep["train"] == uniq - rep["eval"]


def test_length_stats_fractional_guard(spark):
    import pytest
    df = spark.createDataFrame([(float(i) / 3,) for i in range(100)], "v double")
    with pytest.raises(ValueError):
        ST.length_stats(df, "v", (0.5,), "linear")
    r = ST.length_stats(df, "v", (0.5, 0.9), "linear", approx=True).collect()[0]
    assert r["n"] == 100 and abs(r["p50"] - 49 / 3) < 1.0
