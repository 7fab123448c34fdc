"""Filter orders against a plain run of every order."""

import re
from itertools import permutations

from odd import SF
from pyspark.sql import functions as F

from quarry.llm import audit
from quarry.llm.queries import REGISTRY


def flags(docs):
    """Failed filters of (doc_id, source, text) rows."""
    first = {}
    for doc, _, text in docs:
        if doc is not None:
            first[text or ""] = min(doc, first.get(text or "", doc))
    out = []
    for doc, _, text in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {"A"} if len(w) < 50 else set()
        bad |= {"B"} if 100 * len(set(w)) < 65 * len(w) else set()
        bad |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else set()
        bad |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        out.append(bad | ({"E"} if doc is not None and doc > first[t] else set()))
    return out


def brute(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    fails = flags(docs)
    out = {}
    for part in {s or "" for _, s, _ in docs}:
        own = [(d, f) for (d, s, _), f in zip(docs, fails, strict=True) if (s or "") == part]
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone, left = [x for x in left if letter in x[1]], [x for x in left if letter not in x[1]]
                bad = sum(letter in f for _, f in own)
                out[part, "".join(order), step] = [len(left), len(gone), bad - len(gone), sum(f == {letter} for _, f in own),
                                                   sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for letter in "ABCDE":
            keys = [(part, "".join(o), o.index(letter) + 1) for o in permutations("ABCDE")]
            total = sum(out[k][1] for k in keys)
            for k in keys:
                out[k].append(total)
    return {k: tuple(v) for k, v in out.items()}


def table(df):
    rows = df.collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(got) == len(rows)
    return got


def test_intervals_are_lexicographic_ranks():
    orders = list(permutations(range(4)))
    for size in range(1, 5):
        for prefix in permutations(range(4), size):
            lo, hi = audit.interval(prefix, 4)
            assert [i for i, o in enumerate(orders) if o[:size] == prefix] == list(range(lo, hi))


def test_query_matches_every_order(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert table(REGISTRY["op13_filter_interactions"](spark, SF)) == brute(docs, labels)


def test_odd_documents_and_labels(spark, odd, clashing, empty):
    labels = [(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (3, 1, 1), (99, 1, 1), (9, 2, 1), (4, 1, None)]
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs = [(r.doc_id, r.source, r.text) for r in odd.collect()]
    want = brute(docs, labels)
    assert {k[0] for k in want} >= {"", "a"}
    for parts in (1, 5):
        assert table(audit.interactions(audit.masks(odd.repartition(parts), frame))) == want
    more = clashing.select("*", *[F.lit(1).alias(c) for c in ("mask", "digest", "words", "part", "first", "good")])
    assert table(audit.interactions(audit.masks(more, frame.withColumn("mask", F.lit(1))))) == want
    assert table(audit.interactions(audit.masks(odd, frame.where("doc_id < 0")))) == brute(docs, [])
    assert table(audit.interactions(audit.masks(empty, frame))) == {}


def test_other_numbers_of_filters(spark):
    counts = spark.createDataFrame([("p", m, 10 + m, m % 3, m % 2) for m in range(8)], "part string, mask int, n bigint, good bigint, toxic bigint")
    got = {(r.filter_order, r.step): r for r in audit.interactions(counts, "XYZ").collect()}
    assert len(got) == 18
    for order in permutations("XYZ"):
        left = set(range(8))
        for step, letter in enumerate(order, 1):
            bit = 2 ** "XYZ".index(letter)
            gone = {m for m in left if m & bit}
            left -= gone
            r = got["".join(order), step]
            assert (r.kept, r.removed, r.good_lost, r.toxic_lost) == tuple(sum(f(m) for m in s) for s, f in (
                (left, lambda m: 10 + m), (gone, lambda m: 10 + m), (gone, lambda m: m % 3), (gone, lambda m: m % 2)))
