"""Prefix sums, names and components against plain Python."""

import random
from itertools import accumulate

from pyspark.sql import functions as F

from quarry.llm.common import keyed, prefix_sums, repeated, sorted_names, stash
from quarry.llm.components import components


def test_prefix_sums_with_a_hot_and_a_null_key(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 6 + ["x", None]), i, rng.randrange(5)) for i in range(3000)]
    df = stash(spark.createDataFrame(rows, "k string, o int, v int").repartition(7), "t")
    got = {(r.k, r.o): (r.idx, r.cum) for r in prefix_sums(df, ["k"], ["o"], "v").collect()}
    for key in ("hot", "x", None):
        own = sorted((o, v) for k, o, v in rows if k == key)
        for i, ((o, _), s) in enumerate(zip(own, accumulate(v for _, v in own), strict=True)):
            assert got[key, o] == (i, s)
    assert len(got) == len(rows)
    whole = prefix_sums(df, [], [F.col("k").asc_nulls_last(), "o"]).collect()
    assert sorted(r.idx for r in whole) == list(range(3000))
    assert [r.k for r in sorted(whole, key=lambda r: r.idx)][-1] is None
    assert prefix_sums(df.where("o < 0"), ["k"], ["o"], "v").count() == 0


def test_sorted_names(spark):
    df = spark.createDataFrame([(b, i) for i, b in enumerate([3, 1, 2, 3, 1])], "a int, i int")
    assert {(r.a, r.name) for r in sorted_names(df, ["a"]).collect()} == {(1, 0), (2, 1), (3, 2)}


def test_components_of_chains_stars_and_nothing(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(300, 299), (299, 299), (5, None), (2, 1)]
    links += [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in links:
        if b is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    want = {(x, find(x)) for x in list(root) if find(x) != x}
    df = spark.createDataFrame(links, "a bigint, b bigint")
    assert {(r.node, r.root) for r in components(df, "a", "b").collect()} == want
    assert components(df.where("a < 0"), "a", "b").count() == 0


def test_keys_are_unique_and_stable(spark, odd, tmp_path):
    odd.unionAll(odd).write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    for docs in (read, odd.unionAll(odd)):
        keys = keyed(docs)
        once, again = keys.collect(), keys.where("doc_id = 7").collect()
        assert len({r._row_key for r in once}) == len(once) == 24
        assert {r._row_key for r in again} == {r._row_key for r in once if r.doc_id == 7}


def test_repeated_keys_across_tasks(spark):
    """A hot key over many tasks, keys at their borders, single keys."""
    rng = random.Random(3)
    for n, hot, kinds in ((4000, 0.5, 3000), (300, 0.0, 100000), (300, 1.0, 1), (40, 0.3, 10), (1, 0, 1), (0, 0, 1)):
        rows = [(7 if rng.random() < hot else rng.randrange(kinds), rng.randrange(2), i) for i in range(n)]
        df = stash(spark.createDataFrame(rows, "a bigint, b bigint, o bigint").repartition(5), "t")
        for size in (3, 10000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = sorted((r.a, r.b, r.o, r.first, r.near_o) for r in repeated(df, ["a", "b"], ["o"]).collect())
            of = {}
            for a, b, o in rows:
                of.setdefault((a, b), []).append(o)
            assert got == sorted((*k, o, i == 0, v[i - 1] if i else v[1]) for k, v in of.items() if len(v) > 1 for i, o in enumerate(v))
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
