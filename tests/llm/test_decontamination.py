"""Benchmark windows in documents, against plain search."""

import hashlib
import random
import re

import pytest
from odd import SF
from pyspark.sql import functions as F

from quarry.llm import decontamination
from quarry.llm.queries import REGISTRY

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    """[(doc_id, n_words, n_hit, item_ids)] for lists of (id, text)."""
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(len(w), 10)
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(size, {}).setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size, own in windows.items():
            for i in range(len(w) - size + 1):
                if (t := tuple(w[i:i + size])) in own:
                    hit.update(range(i, i + size))
                    found |= {str(x) for x in own[t] if x is not None}
        out.append((doc, len(w), len(hit), sorted(found)))
    return out


def run(docs, items):
    return [(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated, r.n_items) for r in decontamination.overlaps(docs, items).collect()]


def check(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, r[1:3])
    assert sorted((r[:4] for r in got), key=order) == sorted(want, key=order)
    assert all(r[4] == (r[2] > 0) and r[5] == len(r[3]) for r in got)


def test_query_matches_search(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = {(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in brute(docs, items)}
    got = REGISTRY["op12_benchmark_decontamination"](spark, SF)
    assert {tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()} == want
    assert got.count() == len(docs)


def test_random_texts_of_few_words(spark):
    """A tiny vocabulary: windows repeat, overlap and tie everywhere."""
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 6, 9, 10, 11, 14, 30]))) for i in range(30)]
    items = [(i, t) for i, t in items if len(t) not in (1,)]  # one-letter items would hit every text
    docs = [(i, text(rng.randrange(0, 60))) for i in range(200)] + [(500, "x " + items[-1][1] + " y")]
    for parts in (1, 6):
        check(run(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(parts),
                  spark.createDataFrame(items, "item_id bigint, text string").repartition(parts)), brute(docs, items))


def test_odd_documents_and_items(spark, odd, clashing):
    items = [(1, "The SEA was calm; and the sun was-out for all"), (1, "fire with bread"), (2, None), (3, ""), (4, "?!"), (None, "old man told of the years"),
             (5, "中文"), (6, "one"), (7, "word0x0 word1x0 word2x0 word3x0 word4x0 word5x0 word6x0 word7x0 word8x0 word9x0 word10x0"), (7, "x")]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    want = brute(docs, items)
    assert any(h and not i for _, _, h, i in brute(docs, [x for x in items if x[0] is None]))
    check(run(odd, frame), want)
    check(run(clashing, frame.withColumn("row", F.lit(1)).withColumn("h", F.lit(2))), want)
    check(run(odd, frame.where("item_id < 0")), brute(docs, []))
    assert run(odd.where("doc_id < 0"), frame) == []


def test_long_text_is_split_without_loss(monkeypatch):
    monkeypatch.setattr(decontamination, "PIECE", 7)
    text = " ".join(f"w{i}" for i in range(300)).encode()
    whole = decontamination.word_hashes(text)
    monkeypatch.undo()
    assert (whole == decontamination.word_hashes(text)).all() and len(whole) == 300


@pytest.mark.parametrize("n", [10, 11, 40])
def test_every_window_chooses_a_gram_within(n):
    import numpy as np

    rng = np.random.default_rng(n)
    grams = rng.integers(0, 3, n).astype(np.uint64)
    starts = np.arange(n - 9)
    for s, at in zip(starts, decontamination.winnow(grams, starts), strict=True):
        own = grams[s:s + 6]
        assert at == s + max(i for i in range(6) if own[i] == own.min())
