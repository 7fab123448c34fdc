"""Packing round trips and shard laws."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from odd import SF, odd_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import packing, sharding
from quarry.llm.common import keyed
from quarry.llm.queries import REGISTRY, TOKENIZER

TOKENS = Tokenizer.from_file(TOKENIZER)


def ids(text):
    return np.array([*TOKENS.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()


def windows(rows, size):
    """Checks offsets and sizes; the number of padded ids."""
    seq = defaultdict(list)
    for r in rows:
        seq[r.sequence_id].append(r)
    padded = 0
    for pieces in seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= size
        padded += size - at if at & (at - 1) else 0
    return padded


def test_packing_whole_table(spark, corpus):
    got = REGISTRY["op3_lexical_packing"](spark, SF).collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert set(by) == set(corpus)
    for i, text in corpus.items():
        want, at = ids(text), 0
        for r in sorted(by[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(want) // 4)
            assert r.ids_crc32 == zlib.crc32(want[4 * at:4 * (at + r.length)])
            at += r.length
        assert at == len(want) // 4
    assert windows(got, 2048) == 0


def test_words_equal_the_tokenizer_on_whole_texts():
    words = packing.Words(TOKENIZER)
    for text in ["a<|endoftext|>b c,<|startoftext|>.", "İstanbul ΣΑΣ. don't we'll 'S", "x　y \x00 a\x1cb", "ﬁ ½. 中文字, 한국어!", "é. ≠ ≮.",
                 "….. ….", "𝒜 😀😀!!", "²,", "a_b-c ... (q)", "'s 's,", "́'s."]:
        texts = ["x", None, text, "", " y\t", text + "."]
        got, end, _, words_end = words.encode(pa.array(texts))
        assert [got[a:z].tobytes() for a, z in zip([0, *end], end, strict=False)] == [ids(t)[:-4] for t in texts], text
        assert words_end[0] == 1 and words_end[1] == 1


def test_neighbours_come_first(spark):
    tail = " and some more of the usual words"
    texts = [f"zebra{i % 3} quagga{i % 3} okapi{i % 3}" + tail for i in range(9)]
    shard = packing.Shard(list(range(9)), pa.array(texts), packing.Words(TOKENIZER))
    assert list(shard.neighbours(0, np.array([i != 0 for i in range(9)])))[:2] == [3, 6]
    got = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1), TOKENIZER, window=64).collect()
    first = [r.doc_id for r in sorted(got, key=lambda r: (r.sequence_id, r.offset))]
    assert list(dict.fromkeys(first))[:3] == [0, 3, 6]


def test_packing_odd_tables(spark, odd, empty, clashing):
    for shard_docs in (8192, 2):
        got = packing.pack(clashing, TOKENIZER, window=256, shard_docs=shard_docs).collect()
        assert windows(got, 256) == 0
        want = sum(len(ids(r[1])) // 4 for r in odd_rows())
        assert sum(r.length for r in got) == want
        assert [r.ids for r in got if r.doc_id in (3, 4, 5)] == [ids("")] * 3
        assert sum(r.length for r in got if r.doc_id is None) == 2 * len(ids("one two")) // 4
    assert packing.pack(empty, TOKENIZER).count() == 0


def test_sharding_whole_table(spark, corpus):
    got = REGISTRY["op4_vector_sharding"](spark, SF).collect()
    shards, homes = defaultdict(list), defaultdict(set)
    for r in got:
        data = corpus[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        shards[r.shard].append(r)
        homes[data].add(r.shard)
    assert len(got) == len(corpus) and set(shards) == set(range(16))
    for rows in shards.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    sizes = [sum(r.size for r in rows) for rows in shards.values()]
    counts = [len(rows) for rows in shards.values()]
    assert max(sizes) < 1.02 * sum(sizes) / 16 and max(counts) - min(counts) <= 4
    assert all(len(h) == 1 for h in homes.values())


def test_small_groups_are_placed_in_parallel(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") * 7919 % 211).cast("int")).alias("a"), F.md5(F.col("id").cast("string")).alias("b")) \
        .select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit("the hot text")).otherwise(F.concat("a", "b")).alias("text"))
    got = sharding.shard_rows(keyed(docs)).groupBy("shard").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()
    s, n = [r.s for r in got], [r.n for r in got]
    assert len(got) == 16 and max(s) < 1.01 * sum(s) / 16 and max(n) < 1.05 * sum(n) / 16


def test_sharding_odd_tables(spark, odd, empty, clashing):
    got = sharding.shard_rows(keyed(clashing), 3).collect()
    assert len(got) == len(odd_rows())
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert {r.size for r in got if r.doc_id in (3, 4)} == {1} and {r.text_crc32 for r in got if r.doc_id in (3, 4)} == {0}
    assert sharding.shard_rows(keyed(empty)).count() == 0


def test_neighbours_score_all_shared_words():
    rare = [f"left{i}" for i in range(40)]
    # the seed's 20 rarest words are held by the last two alone; the second shares only commoner ones
    texts = [" ".join([*rare, "common topic shared words"]), "common topic shared words", "none of them", " ".join(rare[:20]), " ".join(rare[:20])]
    shard = packing.Shard(list(range(5)), pa.array(texts), packing.Words(TOKENIZER))
    assert list(shard.neighbours(0, np.arange(5) != 0)) == [3, 4, 1]


def test_order_is_that_of_plain_bm25(corpus):
    texts = [t or "" for t in list(corpus.values())[:200]]
    shard = packing.Shard(list(range(200)), pa.array(texts), packing.Words(TOKENIZER))
    _, _, term, end = packing.Words(TOKENIZER).encode(pa.array(texts))
    held = [term[a:z].tolist() for a, z in zip([0, *end], end, strict=False)]
    mean = sum(map(len, held)) / 200
    df = defaultdict(int)
    for h in held:
        for t in set(h):
            df[t] += 1
    for seed in (0, 7, 150):
        scores = np.zeros(200)
        for d, h in enumerate(held):
            for t in set(held[seed]) & set(h):
                tf, idf = h.count(t), np.log1p((200 - df[t] + 0.5) / (df[t] + 0.5))
                scores[d] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(h) / mean))
        got = list(shard.neighbours(seed, np.arange(200) != seed))
        scores[seed] = 0
        assert len(got) == (scores > 0).sum() and (np.diff(scores[got]) < 1e-9).all()


def test_windows_do_not_depend_on_the_files(spark):
    """Texts of 64 subjects, dealt so that files and shards split each."""
    rows = [(i, " ".join([f"subject{'abcdefgh'[i % 8]}{'abcdefgh'[i // 8 % 8]}"] * 6 + ["the usual words", f"own{i}"])) for i in range(1024)]
    mates = []
    for order, parts in ((rows, 1), (rows[::-1], 7)):
        got = packing.pack(spark.createDataFrame(order, "doc_id bigint, text string").coalesce(parts), TOKENIZER, window=512, shard_docs=128).collect()
        assert sum(r.length for r in got) == sum(len(ids(t)) // 4 for _, t in rows) and windows(got, 512) == 0
        seq = defaultdict(set)
        for r in got:
            seq[r.sequence_id].add(r.doc_id)
        pairs = {(a, b) for s in seq.values() for a in s for b in s if a < b}
        mates.append(pairs)
        alike = sum((a - b) % 64 == 0 for a, b in pairs)
        assert alike > 0.5 * len(pairs)  # file order alone brings none together
    assert len(mates[0] & mates[1]) > 0.9 * len(mates[0] | mates[1])


def test_a_hot_word_is_split_over_tasks(spark):
    rows = [(i, "one text of many copies") for i in range(2000)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string"), TOKENIZER, window=64, shard_docs=100).collect()
    assert sum(r.length for r in got) == 2000 * len(ids(rows[0][1])) // 4 and windows(got, 64) == 0
    tasks = defaultdict(int)
    for r in got:
        tasks[r.sequence_id >> 32] += 1
    assert len(tasks) > 1 and max(tasks.values()) < 0.8 * len(got)


def test_known_words_are_not_encoded_again(monkeypatch):
    words, asked = packing.Words(TOKENIZER), []
    monkeypatch.setattr(words, "_letters", lambda stems, by, f=words._letters: asked.extend(stems.to_pylist()) or f(stems, by))
    for texts, new in ((["zebra quagga, okapi", "1st"], ["zebra", "quagga", "okapi"]), (["okapi. zebra! été", None], ["été"]), (["quagga-"], []), ([""], [])):
        got, end, _, _ = words.encode(pa.array(texts, pa.string()))
        assert [got[a:z].tobytes() for a, z in zip([0, *end], end, strict=False)] == [ids(t)[:-4] for t in texts]
        assert asked == new
        asked.clear()
    monkeypatch.setattr(packing, "KNOWN_WORDS", 0)  # a full vocabulary: what is not in it is encoded as met
    for _ in range(2):
        got, _, _, _ = words.encode(pa.array(["dugong zebra dägong manatee"]))
        assert got.tobytes() == ids("dugong zebra dägong manatee")[:-4] and asked == ["dugong", "manatee", "dägong"]
        asked.clear()


def test_tasks_of_one_run_share_their_vocabulary():
    assert packing._words(TOKENIZER, "a") is packing._words(TOKENIZER, "a")
    assert packing._words(TOKENIZER, "b").known.to_pylist() == []


def test_used_documents_leave_the_index(corpus):
    texts = pa.array([t or "" for t in list(corpus.values())[:200]])
    whole, less = (packing.Shard(list(range(200)), texts, packing.Words(TOKENIZER)) for _ in range(2))
    order, unused = np.random.default_rng(0).permutation(200), np.ones(200, bool)
    pairs = []
    for seed in order.tolist():
        unused[seed] = False
        less.forget(unused)
        pairs.append(len(less.doc))
        assert list(less.neighbours(seed, unused)) == list(whole.neighbours(seed, unused))
    assert pairs[-1] < pairs[100] < pairs[0] == len(whole.doc)
