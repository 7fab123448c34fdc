"""The corpus pipeline against its operators' brute-force versions."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
from odd import SF, odd_rows
from quarry.llm.common import stash
from test_dedup import brute_components, brute_exact, brute_fingerprint
from test_mixing_quality import brute_measures
from test_packing_sharding import ids, windows


def test_stages_on_the_whole_table(spark, corpus):
    docs = corpus_pipeline.documents(spark, SF)
    columns = docs.columns
    frames = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stash(stage(spark, docs, SF), "stage")
        frames.append(docs)
    quality, exact, near, mixed, packed = (f.collect() for f in frames)
    assert all(f.columns == columns for f in frames[:-1])

    kept = {r.doc_id for r in quality}
    failed = {i for i, t in corpus.items() if brute_measures(t)[-1]}
    clean = {i for i, t in corpus.items() if i not in failed and not re.search(r"[#*$%&|<>]", t) and len(set(t.split("\n"))) == len(t.split("\n"))}
    assert not kept & failed and clean <= kept

    want = {min(g, key=lambda r: (-len(r[1]), r[0]))[0] for g in brute_exact([(i, corpus[i]) for i in kept]).values()}
    assert sorted(r.doc_id for r in exact) == sorted(want)
    order = sorted(want)
    groups = brute_components([brute_fingerprint(corpus[i]) for i in order], 2)
    assert sorted(r.doc_id for r in near) == sorted({order[g] for g in groups})

    words = {r.doc_id: len(r.text.split()) for r in near}
    times = Counter(r.doc_id for r in mixed)
    assert set(times) <= set(words) and max(times.values()) <= 3
    total, taken = sum(words.values()), sum(n * words[i] for i, n in times.items())
    assert taken <= total <= taken + max(words.values())

    assert windows(packed, 2048) == 0
    by = defaultdict(list)
    for r in packed:
        by[r.doc_id].append(r)
    assert set(by) == set(times)
    for i, n in times.items():  # every copy's ids stand in exactly one piece
        body = ids(corpus[i])
        cover = np.zeros(len(body) // 4, int)
        for r in by[i]:
            assert r.doc_tokens == len(cover) and body[4 * r.start:4 * (r.start + r.length)] == r.ids
            cover[r.start:r.start + r.length] += 1
        assert (cover == n).all()


def test_stages_take_odd_tables(spark, odd, empty, clashing):
    for docs in (clashing, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "packing" or out.columns == docs.columns
            if docs is empty:
                assert out.count() == 0
            else:
                n = out.count()
                assert n and (name == "packing" or n <= 3 * len(odd_rows()))


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert windows(out, 2048) == 0 and out
