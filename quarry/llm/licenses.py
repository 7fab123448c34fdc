"""License scans over a positional rare-token index.

The index holds, for every word of the license templates, the templates and
positions where it stands.  Of each template whose words a file can hold,
the half of its places with the words rarest in the corpus is looked up;
postings vote for (template, file position minus template position), where
neighbouring offsets count together, so added or missing words do not part
them.  What has as many votes as an aligned text must have is aligned and
verified by the template's mandatory key phrases.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base phrases and their labels (fixed values).
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: (label, template, mandatory key phrases): openings and notices of common public licenses.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction", ("permission is hereby granted",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
                 "with the license you may obtain a copy of the license at", ("apache license version 2",)),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
              "public license as published by the free software foundation either version 3 of the license",
     ("gnu general public license", "version 3")),
    ("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
              "public license as published by the free software foundation either version 2 of the license",
     ("gnu general public license", "version 2")),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation",
     ("gnu lesser general public license",)),
    ("agpl-3", "under the terms of the gnu affero general public license as published by the free software foundation",
     ("gnu affero general public license",)),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met", ("redistribution and use in source and binary forms",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ("permission to use copy modify",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ("creative commons attribution 4 0",)),
)
#: Words by which an aligned text may have been shifted within a template by words that were added or left out.
BAND = 8
#: Share of a template's words that must stand aligned.
MIN_SCORE = 0.75

#: Lower-cases A-Z and turns all other ASCII but letters and digits into spaces.
_TABLE = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


def words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: A-Z lower-cased, all other ASCII but letters
    and digits separates."""
    return text.translate(_TABLE).split()


class Index:
    """Template postings and inverse document frequencies; its size is that
    of the templates, whatever the corpus."""

    def __init__(self, templates, phrases, frequency: dict[str, int], documents: int, least: float):
        split = lambda s: s.encode().split()
        self.templates = [(label, split(t), [split(k) for k in keys]) for label, t, keys in templates]
        self.phrases = [(split(p), label) for p, label in phrases]
        self.postings = {}
        for t, (_, body, _) in enumerate(self.templates):
            for at, w in enumerate(body):
                self.postings.setdefault(w, {}).setdefault(t, []).append(at)
        self.parts = [Counter(body) for _, body, _ in self.templates]
        self.idf = {w: math.log(1 + documents / (1 + frequency.get(w.decode(), 0))) for w in self.postings}
        # Of a template that stands in a file with the share ``least``, all but (1 - least) of its places are
        # aligned, so of the half of its places with the highest idf at least ``needed`` are.
        self.rare, self.needed = [], []
        for _, body, _ in self.templates:
            half = sorted(range(len(body)), key=lambda i: (-self.idf[body[i]], body[i], i))[:(len(body) + 1) // 2]
            self.rare.append({w: sorted(i for i in half if body[i] == w) for w in {body[i] for i in half}})
            self.needed.append(max(1, len(half) - math.floor((1 - least) * len(body) + 1e-9)))

    def possible(self, have: set, least: float) -> list[int]:
        """Templates of whose words a file that has ``have`` can hold the
        share ``least``."""
        return [t for t, part in enumerate(self.parts) if sum(n for w, n in part.items() if w in have) >= least * part.total()]


def spots(line: list[bytes], wanted: set) -> dict[bytes, list[int]]:
    """Places of the wanted words."""
    where = defaultdict(list)
    for i, w in enumerate(line):
        if w in wanted:
            where[w].append(i)
    return where


def places(line: list[bytes], phrase: list[bytes], where: dict[bytes, list[int]]) -> list[int]:
    """Starts of ``phrase`` in ``line``, tried from its rarest word on."""
    if any(w not in where for w in phrase):
        return []
    k = min(range(len(phrase)), key=lambda j: len(where[phrase[j]]))
    n = len(phrase)
    return [i - k for i in where[phrase[k]] if i >= k and line[i - k:i - k + n] == phrase]


def regions(rare: dict[bytes, list[int]], needed: int, where: dict[bytes, list[int]]) -> list[int]:
    """Offsets of a file at which ``needed`` different places of the rare
    words ``rare`` (word, places in the template) lie at offsets less than
    BAND apart; of those that follow each other, one in every BAND."""
    votes = sorted((i - at, at) for w, ats in rare.items() for i in where.get(w, ()) for at in ats)
    seen, left, out = Counter(), 0, []
    for offset, at in votes:
        seen[at] += 1
        while offset - votes[left][0] >= BAND:
            old = votes[left][1]
            seen[old] -= 1
            if not seen[old]:
                del seen[old]
            left += 1
        if len(seen) >= needed and (not out or votes[left][0] - out[-1] >= BAND):
            out.append(votes[left][0])
    return out


def aligned(body: list[bytes], near: list[bytes]) -> int:
    """Words of ``body`` that stand in ``near`` in the same order: the
    longest common subsequence, a bit of a number per word of the body."""
    at, full = defaultdict(int), (1 << len(body)) - 1
    for i, w in enumerate(body):
        at[w] |= 1 << i
    left = full
    for w in near:
        if hit := left & at.get(w, 0):
            left = (left + hit | left - hit) & full
    return len(body) - left.bit_count()


def examine(line: list[bytes], index: Index, vocabulary: set, least: float):
    """(n_base, first, last, base labels, all labels, score) of a file."""
    have = vocabulary.intersection(line)
    phrases = [(p, label) for p, label in index.phrases if have.issuperset(p)]
    chosen = index.possible(have, least)
    if not phrases and not chosen:
        return 0, None, None, [], [], 0.0
    where = spots(line, {w for ws in (*(index.rare[t] for t in chosen), *(p for p, _ in phrases)) for w in ws})
    starts, base = [], set()
    for phrase, label in phrases:
        if at := places(line, phrase, where):
            starts += at
            base.add(label)
    labels, score = set(base), 1.0 if base else 0.0
    for t in chosen:
        label, body, keys = index.templates[t]
        for start in regions(index.rare[t], index.needed[t], where):
            near = line[max(0, start - BAND):max(0, start + len(body) + 2 * BAND)]
            hit = aligned(body, near) / len(body)
            if hit >= least and all(places(near, k, spots(near, set(k))) for k in keys):
                labels.add(label)
                score = max(score, hit)
    return len(starts), min(starts, default=None), max(starts, default=None), sorted(base), sorted(labels), score


def _frequencies(vocabulary: frozenset):
    def run(batches):
        counts, rows = Counter(), 0
        for b in batches:
            for t in b.column("text").cast(pa.binary()).to_pylist():
                counts.update(vocabulary.intersection(words(t or b"")))
                rows += 1
        names = [w.decode() for w in counts]
        yield pa.RecordBatch.from_arrays([pa.array([*names, None], pa.string()), pa.array([*counts.values(), rows], pa.int64())], names=["word", "n"])
    return run


def document_frequencies(docs: DataFrame, templates=TEMPLATES) -> tuple[dict[str, int], int]:
    """Over all rows: for each template word the number of files with it,
    and the number of files.  One row per template word and task is summed."""
    vocabulary = frozenset(w.encode() for _, t, _ in templates for w in t.split())
    parts = docs.select("text").mapInArrow(_frequencies(vocabulary), "word string, n bigint")
    sums = {r.word: r.n for r in parts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return sums, sums.pop(None, 0)


def _examine(index: Index, least: float):
    vocabulary = set(index.postings) | {w for p, _ in index.phrases for w in p}

    def run(batches):
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            out = []
            for t in texts:
                line = words(t or b"")
                out.append((len(line), *examine(line, index, vocabulary, least)))
            cols = list(zip(*out, strict=True)) or [[]] * 7
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)]],
                                             names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    return run


def license_scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, min_score: float = MIN_SCORE) -> DataFrame:
    """One row per row: doc_id, n_words, n_base (places of base phrases),
    first_word, last_word (their smallest and largest start, else null),
    base_labels, labels (sorted arrays) and score (1 with a base phrase,
    else the best share of a template's words, in order, that was verified).

    Null text counts as empty and has no words; repeated rows are scanned
    alike; empty input gives an empty result; other columns are not read.
    Two passes read the texts: word statistics over all rows, then the
    scan; only counts of template words reach the driver."""
    counts, n = document_frequencies(docs, templates)
    index = Index(templates, phrases, counts, n, min_score)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        _examine(index, min_score),
        f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels array<string>, labels array<string>, score double")
