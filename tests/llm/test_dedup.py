"""SimHash near-duplicates, block naming and repeated passages against brute force."""

import hashlib
import random
import re
from collections import defaultdict
from itertools import combinations

import xxhash
from pyspark.sql import functions as F

from quarry.llm import block_naming, simhash, substrings
from quarry.llm.common import keyed
from quarry.llm.queries import REGISTRY

from odd import SF, odd_rows


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits):
    """Component of each row by the smallest place in ``fps``."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= bits:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_simhash_whole_table(spark, corpus):
    got = {r.doc_id: r for r in REGISTRY["op2_simhash_near_dedup"](spark, SF).collect()}
    ids = sorted(corpus)
    fps = [brute_fingerprint(corpus[i]) for i in ids]
    groups = brute_components(fps, 2)
    assert len(got) == len(ids)
    for i, fp, g in zip(ids, fps, groups, strict=True):
        assert (got[i].fingerprint, got[i].component_id, got[i].kept) == (f"{fp:016x}", ids[g], ids[g] == i)


def test_ball_links_for_every_radius(spark):
    base = [0, 0xFFFF, (1 << 63) | 5, 0x123456789ABCDEF]
    fps = sorted({b ^ m for b in base for m in (0, 1, 3, 7, 15, 31, 1 << 63, 3 << 40, 0xF0F0)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    for bits in (0, 1, 2, 3):
        links = [(r.fp % 2**64, r.other % 2**64) for r in simhash.fingerprint_links(df, bits).collect()]
        assert all((a ^ b).bit_count() <= bits for a, b in links)
        root = {f: f for f in fps}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in links:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
        want = brute_components(fps, bits)
        assert [fps.index(find(f)) for f in fps] == want


def test_simhash_odd_tables(spark, odd, empty, clashing):
    rows = odd_rows()
    got = simhash.near_duplicates(keyed(odd)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.doc_id, r.fp % 2**64) in {(d[0], brute_fingerprint(d[1])) for d in rows}
    by = {r.doc_id: r for r in got}
    assert by[3].fp == by[4].fp == by[5].fp == 0 and {by[d].component_id for d in (3, 4, 5)} == {3}
    assert by[None].component_id is None and by[6].component_id == 1
    assert sum(r.kept for r in got) == len({r.fp for r in got})
    kept = simhash.near_dedup(clashing)
    assert kept.columns == clashing.columns and kept.count() == sum(r.kept for r in got)
    assert simhash.near_duplicates(keyed(empty)).count() == 0


def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", "", r[1] or "")].append(r)
    return groups


def test_block_naming_whole_table(spark, corpus):
    got = {r.doc_id: r for r in REGISTRY["op5_block_naming_dedup"](spark, SF).collect()}
    assert len(got) == len(corpus)
    for text, group in brute_exact(corpus.items()).items():
        keep = min(group, key=lambda r: (-len(r[1]), r[0]))[0]
        for i, _ in group:
            assert tuple(got[i]) == (i, keep, len(group), i == keep, hashlib.sha256(text.encode()).hexdigest())


def test_names_survive_hash_collisions(spark, corpus):
    docs = keyed(spark.createDataFrame(list(corpus.items())[:300], "doc_id bigint, text string"))
    weak = block_naming.identities(docs, 512, lambda c: F.pmod(F.xxhash64(c), F.lit(20))).collect()
    by = defaultdict(set)
    for r in weak:
        by[r.n_blocks, r.name].add(r.text_sha256)
    assert all(len(v) == 1 for v in by.values()) and len(by) == len({r.text_sha256 for r in weak})


def test_block_naming_odd_tables(spark, odd, empty, clashing):
    got = block_naming.exact_duplicates(keyed(odd), 64).collect()
    groups = brute_exact(odd_rows())
    assert sorted((str(r.doc_id), r.group_size) for r in got) == sorted((str(r[0]), len(g)) for g in groups.values() for r in g)
    assert sum(r.kept for r in got) == len(groups)
    assert {r.keep_id for r in got if r.doc_id in (1, 2)} == {2} and {r.keep_id for r in got if r.doc_id in (3, 4, 5)} == {5}
    kept = block_naming.exact_dedup(clashing)
    assert kept.columns == clashing.columns and kept.count() == len(groups)
    assert block_naming.exact_duplicates(keyed(empty)).count() == 0


def rolling_cuts(data):
    """Cuts by a rolling hash, byte after byte."""
    least, most = substrings.MIN_CHUNK, substrings.MAX_CHUNK
    h, last, cut, found = 0, -least, 0, []
    for i, b in enumerate(data[:-1]):
        h = ((h << 1) + int(substrings.GEAR[b])) % 2**32
        if h < 2**32 // substrings.RATE and data[i + 1] & 0xC0 != 0x80:
            if i + 1 - last >= least:
                found.append([i + 1])
            else:
                found[-1].append(i + 1)
            last = i + 1
    at = []
    for row in found:
        at.append(row[0])
        for c in row[1:]:
            if row[-1] - row[0] >= 2 * least and c - at[-1] >= least:
                at.append(c)
    ends = []
    for z in [*at, len(data)]:
        while z - cut > most:
            cut += most
            while data[cut] & 0xC0 == 0x80:
                cut -= 1
            ends.append(cut)
        cut = z
        ends.append(z)
    return ends if data else []


def test_gear_cuts_are_those_of_a_rolling_hash(corpus):
    import numpy as np

    for text in [*list(corpus.values())[:80], "é" * 3000, "a" * 5000, "an orantion" * 300, "", "x"]:
        data = text.encode()
        assert substrings.cuts(np.frombuffer(data, np.uint8)).tolist() == rolling_cuts(data)


def test_repeated_passages_whole_table(spark, corpus):
    got = REGISTRY["op6_cdc_substring_dedup"](spark, SF).collect()
    least, of, twice = substrings.MIN_PASSAGE, {}, defaultdict(int)
    for i, t in corpus.items():
        data, a, at, of[i] = t.encode(), 0, 0, []
        for z in rolling_cuts(data):
            n = len(data[a:z].decode())
            of[i].append((at, at + n, data[a:z]))
            a, at = z, at + n

    def shortest(line):
        """All sequences of chunks of that length that hold no other."""
        ends = {}
        for i in range(len(line)):
            j = next((j for j in range(i, len(line)) if line[j][1] - line[i][0] >= least), None)
            if j is not None:
                ends[j] = i  # the latest start
        return [(line[i][0], line[j][1], tuple(c for _, _, c in line[i:j + 1])) for j, i in ends.items()]
    for line in of.values():
        for _, _, c in shortest(line):
            twice[c] += 1
    want, have = {i: set() for i in corpus}, {i: set() for i in corpus}
    for i, line in of.items():
        for s, e, c in shortest(line):
            if twice[c] > 1:
                want[i].update(range(s, e))
    for r in got:
        have[r.doc_id].update(range(r.start, r.end))
    assert all(want[i] <= have[i] for i in corpus)
    whole = "\x00".join(corpus.values())
    for text in {corpus[r.doc_id][r.start:r.end] for r in got}:  # no row claims what stands once
        at = whole.index(text)
        assert len(text) >= least and whole.find(text, at + 1) > 0
    assert all(corpus[r.doc_id][r.start:r.end] in corpus[r.copy_doc_id] for r in got)
    hit, seen = {r.doc_id for r in got}, {}
    for i, t in corpus.items():  # every passage of 50 words in two documents is found
        w = t.split()
        for k in range(len(w) - 49):
            other = seen.setdefault(tuple(w[k:k + 50]), i)
            assert other == i or {i, other} <= hit


def test_passages_odd_tables(spark, odd, empty, clashing):
    got = substrings.passages(keyed(odd)).collect()
    texts = {r[0]: r[1] for r in odd_rows()}
    assert {r.doc_id for r in got} >= {1} and not {r.doc_id for r in got} & {3, 4, 5, 8, 9, None}
    assert sum(r.kept for r in got if r.doc_id == 1) == 1
    stripped = substrings.strip_repeats(clashing)
    assert stripped.columns == clashing.columns
    rows = stripped.collect()
    assert sorted(r.text for r in rows if r.doc_id == 1)[-1] == texts[1] and any(r.text == "" for r in rows if r.doc_id == 1)
    assert [r.text for r in rows if r.doc_id == 3] == [None]
    assert substrings.passages(keyed(empty)).count() == 0


def test_passage_found_after_an_insertion(spark, corpus):
    long = sorted(corpus.values(), key=len)[-3:]
    shared = long[2][5000:5400]
    docs = spark.createDataFrame([(1, long[0] + shared), (2, "An inserted line. " + shared + long[1])], "doc_id bigint, text string")
    got = {r.doc_id: docs.where(F.col("doc_id") == r.doc_id).first().text[r.start:r.end] for r in substrings.passages(keyed(docs)).collect()}
    assert set(got) == {1, 2} and got[1] in got[2] + got[1] and got[2] in shared and len(got[2]) > 200


def brute_cuts(texts):
    """Per text the code points that a sequence of chunks of MIN_PASSAGE
    code points or more covers which stands whole before."""
    least, seen, out, chunks = substrings.MIN_PASSAGE, {}, [], []
    for k, t in enumerate(texts):
        data, a, at, line = t.encode(), 0, 0, []
        for z in rolling_cuts(data):
            n = len(data[a:z].decode())
            line.append((at, at + n, data[a:z]))
            a, at = z, at + n
        chunks.append(line)
        for i in range(len(line)):
            for j in range(i, len(line)):
                if line[j][1] - line[i][0] >= least:
                    seen.setdefault(tuple(c for _, _, c in line[i:j + 1]), (k, i))
    for k, line in enumerate(chunks):
        gone = set()
        for i in range(len(line)):
            for j in range(i, len(line)):
                if line[j][1] - line[i][0] >= least and seen[tuple(c for _, _, c in line[i:j + 1])] != (k, i):
                    gone.update(range(line[i][0], line[j][1]))
        out.append(gone)
    return out


def test_cuts_lose_no_text_and_spare_what_repeats_apart(spark, corpus):
    long = sorted(corpus.values(), key=len)[-2:]
    some = random.Random(6)

    def fresh(n):
        return "".join(some.choices("etaoin shrdlu", k=n))
    x, y = fresh(200), fresh(700)
    phrases = [fresh(60) for _ in range(6)]
    alone = [fresh(300) + p + fresh(300) for p in phrases]
    texts = [y, x + y, x + y, *alone, "".join(phrases), long[0][:900], long[0][500:900] + long[1][:300] + long[0][200:600],
             "Once more. " * 60, "é中 " * 90, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    got = substrings.passages(keyed(docs)).collect()
    gone = [set() for _ in texts]
    for r in got:
        assert all(r.start <= c.start < c.end <= r.end for c in r.cuts)
        assert r.kept == ([tuple(c) for c in r.cuts] != [(r.start, r.end)])
        gone[r.doc_id].update(*[range(c.start, c.end) for c in r.cuts])
    assert gone == brute_cuts(texts)
    left = {r.doc_id: r.text for r in substrings.strip_repeats(docs).collect()}
    assert left == {i: "".join(c for at, c in enumerate(t) if at not in gone[i]) for i, t in enumerate(texts)}
    assert left[0] == y and left[1].startswith(x) and len(left[1]) < len(x) + 100 and left[2] == ""
    assert left[9] == texts[9]  # its phrases repeat, each in another text, but no passage does
    stays = set()
    for i, t in enumerate(texts):  # the first copy of each chunk stays
        data, a, at = t.encode(), 0, 0
        for z in rolling_cuts(data):
            n = len(data[a:z].decode())
            assert data[a:z] in stays or not gone[i] & set(range(at, at + n))
            stays.add(data[a:z])
            a, at = z, at + n
