"""Mixing and quality rules against plain Python."""

import re
from collections import Counter, defaultdict

from odd import SF, odd_rows

from quarry.llm import mixing, quality
from quarry.llm.common import keyed
from quarry.llm.queries import REGISTRY

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * share > 3 * sizes[s]}
        if not over:
            return target | {s: weight[s] * share for s in open_}
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        open_ -= over
    return target


def check_mix(rows, sizes):
    target = brute_targets(sizes)
    taken, largest = Counter(), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) <= 1e-9 * max(1, r.target)
        assert r.taken in {k * r.size for k in range(4)}
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert sum(taken.values()) <= sum(sizes.values()) <= sum(taken.values()) + max(largest.values(), default=0)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] + 1e-6


def test_mix_whole_table(spark, corpus):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix(keyed(docs)).collect()
    sizes = Counter()
    for r in rows:
        assert r.size == len(WORD.findall(corpus[r.doc_id]))
        sizes[r.source] += r.size
    assert len(rows) == len(corpus)
    check_mix(rows, sizes)
    again = REGISTRY["op9_fair_source_mixing"](spark, SF).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)


def test_targets_that_stop_and_a_hot_source(spark):
    sizes = {"a": 90000, "b": 10, "c": 40, "d": 3000, "é": 5, None: 1000, "Z": 0}
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")).collect()
    want = brute_targets(sizes)
    assert all(abs(r.target - want[r.source]) < 1e-6 for r in got) and len(got) == len(sizes)
    rows = [(i, "w " * (i % 7 + 1), "hot" if i % 3 else f"s{i % 11}") for i in range(4000)]
    mixed = mixing.mix(keyed(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))).collect()
    by = Counter()
    for r in mixed:
        by[r.source] += r.size
    check_mix(mixed, by)


def test_mix_odd_tables(spark, odd, empty, clashing):
    rows = mixing.mix(keyed(clashing)).collect()
    assert len(rows) == len(odd_rows()) and {r.taken for r in rows if r.doc_id in (3, 4, 5)} == {0}
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
    check_mix(rows, sizes)
    out = mixing.mixed(clashing)
    assert out.columns == clashing.columns and out.count() == sum(r.copies for r in rows)
    assert mixing.mix(keyed(empty)).count() == 0 and mixing.mixed(empty).count() == 0
    assert mixing.mix(keyed(odd.where("doc_id in (3, 4)"))).where("target = 0 and taken = 0").count() == 2


def brute_measures(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(zip(w, w[1:], w[2:]))
    repeated = {j for i, t in enumerate(zip(w, w[1:], w[2:])) if seen[t] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated),
            len(w) < 50 or 100 * len(repeated) > 50 * len(w))


def measured(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_quality_whole_table(spark, corpus):
    got = REGISTRY["op8_quality_cascade"](spark, SF).collect()
    assert len(got) == len(corpus)
    for r in got:
        assert measured(r) == brute_measures(corpus[r.doc_id]) and not (r.base_failed and r.kept)
    prose = [r for r in got if not r.base_failed and r.n_symbols == 0 and r.n_dup_lines == 0]
    assert len(prose) > 700 and all(r.kept for r in prose)


def test_repeats_with_colliding_hashes(spark, monkeypatch):
    texts = ["a b a b a b a", "x " * 60, "a b c " * 3000 + "q r", "a b c d a b c e a b c", "a a", "", " ".join("abcdefgh"[i * i % 8] for i in range(500))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for bits in (24, 56, 60):  # ever fewer bits of the hash: neighbours must be told apart by their words
        monkeypatch.setattr(quality, "_INDEX_BITS", bits)
        for r in quality.judged(docs).collect():
            assert measured(r) == brute_measures(texts[r.doc_id])


def test_order_changes_work_not_verdicts(spark, corpus):
    docs = spark.createDataFrame(list(corpus.items())[:300], "doc_id bigint, text string")
    kept = sorted(r.doc_id for r in quality.judged(docs).where("kept").collect())
    rules = quality.order_rules(docs, sample_rows=50)
    assert {r.name for r in rules} == {r.name for r in quality.RULES}
    for order in (quality.RULES, quality.RULES[::-1]):
        assert sorted(r.doc_id for r in quality.quality_filter(docs, order).collect()) == kept


def test_quality_odd_tables(spark, odd, empty, clashing):
    got = quality.judged(clashing).collect()
    assert sorted(map(measured, got)) == sorted(brute_measures(r[1]) for r in odd_rows())
    assert {r.doc_id for r in got if r.kept} == {1, 2, 6, 7}
    out = quality.quality_filter(clashing)
    assert out.columns == clashing.columns and out.count() == sum(r.kept for r in got)
    assert quality.judged(empty).count() == quality.quality_filter(empty).count() == 0
