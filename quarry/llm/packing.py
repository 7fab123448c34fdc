"""Lexical retrieval packing of documents into token windows.

Documents that share their weightiest word, by BM25, are brought to one
index of bounded size; the first unused document opens a
window, the index scores all its unused documents by all words they share
with the seed, and the best fill the window greedily.  What crosses the
window's end is cut and its rest opens the next window.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back_memory, partitions

WINDOW = 2048
END_ID = 1
#: A shard closes at so many bytes of text or documents.
SHARD_BYTES, SHARD_DOCS = 8 << 20, 4096
#: Bytes of text that one packing task should get at most.
TASK_BYTES = 256 << 20
K1, B = 1.2, 0.75
#: A term of one in so many documents of a shard has its weights as a dense row.
OFTEN = 8
PIECES = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
#: Letter runs that are encoded as one line.
LINE_WORDS = 16384
#: Words of letters after which a worker's vocabulary learns no more (the rest is encoded as met).
KNOWN_WORDS = 1 << 19
#: A word of letters with ASCII marks behind it, which the tokenizer splits between the two.  (U+0130 is the
#: one letter that does not stay a letter in lower case.)
_PLAIN = r"^(?P<stem>[^\P{L}\x{130}]+)(?P<tail>[.,;:!?#*$%&|()\[\]{}\-_/+=~^@\\]*)$"


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every run, one after another."""
    out = np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
    out += np.arange(len(out))
    return out


def _bytes_of(data: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all large_binary values, one after another, where each
    begins and the last ends)."""
    if not len(data):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(data.buffers()[1], np.int64)[data.offset:data.offset + len(data) + 1]
    return np.frombuffer(data.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def _blobs(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The ids of each word, ``sizes`` many, as bytes."""
    ends = np.append(0, np.cumsum(4 * sizes)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(ids.astype(np.uint32, copy=False))])


def _hashes(words: pa.Array) -> np.ndarray:
    """A 32-bit hash of every word's bytes."""
    if not len(words):
        return np.zeros(0, np.uint32)
    data, ends = _bytes_of(words.cast(pa.large_binary()))
    sizes = np.diff(ends)
    at = np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)
    held = data.astype(np.uint64) + np.uint64(1)
    powers = np.cumprod(np.full(int(sizes.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    sums = np.append(np.uint64(0), np.cumsum(held * powers[at]))  # modulo 2^64, as its differences
    out = sums[ends[1:]] - sums[ends[:-1]]
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (out >> np.uint64(32)).astype(np.uint32)


class Words:
    """Token ids and term numbers of texts by their white-space words.

    The tokenizer never joins characters across white space, so a text's ids
    are those of its words in order, and each distinct word is encoded once.
    Words of letters with marks behind them are split there, so that fewer
    are distinct; all letter runs are encoded as one line, where the last
    token of each says so."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = tokenizer = Tokenizer.from_file(path)
        #: The same model without normalizer and pattern, if they leave a run of a to z as it is.
        self.ascii, run = tokenizer, "zyxwvutsrqponmlkjihgfedcba"
        norm, cut = tokenizer.normalizer, tokenizer.pre_tokenizer
        if cut and [w for w, _ in cut.pre_tokenize_str(norm.normalize_str(run) if norm else run)] == [run]:
            self.ascii = Tokenizer(tokenizer.model)
            self.ascii.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        #: Type of shuffled ids.
        self.kind = "<u2" if max(vocabulary.values()) < 1 << 16 else "<u4"
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        #: Words of letters met so far, and their ids.
        self.known, self.known_ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def _each(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False)]
        return np.array([i for ids in got for i in ids], np.uint32), np.array([len(ids) for ids in got], np.int64)

    def _letters(self, stems: pa.Array, tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters alone, many encoded as one line."""
        got = []
        for i in range(0, len(stems), LINE_WORDS):
            part = stems.slice(i, LINE_WORDS)
            line = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part), " ")[0].as_py()
            ids = np.array(tokenizer.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            whole = len(stops) == len(part) and stops[-1] == len(ids)
            got.append((ids, np.diff(stops, prepend=0)) if whole else self._each(part))
        return tuple(np.concatenate([g[j] for g in got]) for j in (0, 1)) if got else self._each(stems)

    def _stems(self, stems: pa.Array) -> pa.Array:
        """Ids of words of letters alone, those met before from the vocabulary."""
        stems = stems.cast(pa.string())
        places = pc.index_in(stems, self.known).fill_null(-1).to_numpy().copy()
        new = np.flatnonzero(places < 0)
        ascii = pc.string_is_ascii(stems.take(pa.array(new))).to_numpy(zero_copy_only=False)
        pool, known = [self.known_ids], [self.known]
        for at, tokenizer in ((new[ascii], self.ascii), (new[~ascii], self.tokenizer)):
            places[at] = np.arange(len(at)) + sum(map(len, pool))
            known.append(stems.take(pa.array(at)))
            pool.append(_blobs(*self._letters(known[-1], tokenizer)))
        ids = pa.concat_arrays(pool)
        if len(self.known) < KNOWN_WORDS:
            self.known, self.known_ids = pa.concat_arrays(known), ids
        return ids.take(pa.array(places))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text's ids, term of every word, end
        of each text's words); null texts have none.  A term is a hash of the
        word, without marks behind letters, that is the same everywhere."""
        lines = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        coded = lines.flatten().dictionary_encode()
        words, at = coded.dictionary, coded.indices.to_numpy()
        parts = pc.extract_regex(words, _PLAIN)
        plain = parts.is_valid().to_numpy(zero_copy_only=False)
        stems = pc.struct_field(parts, "stem").drop_null().dictionary_encode()
        tails = pc.struct_field(parts, "tail").drop_null().dictionary_encode()
        odd = words.filter(pa.array(~plain))
        # every distinct word is a stem and a tail, or itself
        place = np.empty(len(words), np.int64)
        place[plain], place[~plain] = np.arange(len(stems)), np.arange(len(stems), len(words))
        both = pc.binary_join_element_wise(self._stems(stems.dictionary).take(stems.indices), _blobs(*self._each(tails.dictionary)).take(tails.indices),
                                           pa.scalar(b"", pa.large_binary()))
        blobs = pa.concat_arrays([both, _blobs(*self._each(odd))]).take(pa.array(place))
        ids, ends = _bytes_of(blobs.take(coded.indices))
        cut = lines.offsets.to_numpy()[1:] - lines.offsets[0].as_py()
        real = (pc.binary_length(words).to_numpy() > 0)[at]  # splitting leaves empty words at a text's ends
        term = np.empty(len(words), np.uint32)
        term[plain], term[~plain] = _hashes(stems.dictionary)[stems.indices.to_numpy()], _hashes(odd)
        return ids.view(np.uint32), ends[cut] // 4, term[at][real], np.append(0, np.cumsum(real))[cut]


@lru_cache(maxsize=1)
def _words(path: str, run: str) -> Words:
    """The words of one run of :func:`pack`, for all its tasks in a worker."""
    return Words(path)


def _weights(number: np.ndarray, tf: np.ndarray, sizes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents of each term, BM25 weight of each pair of a term and a
    document) over the documents of ``sizes`` words."""
    n, df = len(sizes), np.bincount(number) if len(number) else np.zeros(0, np.int64)
    norm = K1 * (1 - B + B * sizes / max(1.0, sizes.mean() if n else 0.0))
    return df, np.log1p((n - df + 0.5) / (df + 0.5))[number] * tf * (K1 + 1) / (tf + norm[doc])


def _numbered(term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of every term, their places by number, then as they stand)."""
    by_term = np.argsort(term, kind="stable")
    ordered = term[by_term]
    number = np.empty(len(term), np.int64)
    number[by_term] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1])[:len(term)])
    return number, by_term


class Encoded:
    """Tokens, words and distinct terms, with their counts, of texts."""

    def __init__(self, texts: pa.Array, words: Words):
        ids, ids_end, term, words_end = words.encode(texts)
        ids = ids.astype(words.kind)
        self.tokens = [ids[a:z] for a, z in zip([0, *ids_end.tolist()], ids_end.tolist())]
        self.sizes = np.diff(words_end, prepend=0).astype(np.int64)
        self.bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()).to_numpy()
        n = len(texts)
        doc = np.repeat(np.arange(n, dtype=np.uint64), self.sizes)
        pair, self.tf = np.unique(doc << np.uint64(32) | term, return_counts=True)  # by document, then term
        self.doc, self.term = (pair >> np.uint64(32)).astype(np.int64), pair.astype(np.uint32)
        self.cut = np.append(0, np.cumsum(np.bincount(self.doc, minlength=n)))

    def routes(self, ids: list, total: int, shard_docs: int) -> np.ndarray:
        """One number per document: its weightiest term that others hold too,
        zero without one, by the statistics of these documents.  A term that
        more of all ``total`` documents seem to hold than a shard takes is
        split by doc_id, so no task gets all of a hot one."""
        route, held = np.zeros(len(ids), np.int64), np.full(len(ids), len(ids))
        number, _ = _numbered(self.term)
        df, weight = _weights(number, self.tf, self.sizes, self.doc)
        weight[df[number] < 2] = 0
        some = np.flatnonzero(np.diff(self.cut))
        if len(some):
            top = np.zeros(len(ids))
            top[some] = np.maximum.reduceat(weight, self.cut[some])
            best = np.flatnonzero((weight == top[self.doc]) & (weight > 0))[::-1]  # the smallest term comes last and stays
            route[self.doc[best]], held[self.doc[best]] = self.term[best], df[number[best]]
        parts = held * total // max(1, len(ids)) // shard_docs + 1
        salt = [zlib.crc32(str(i).encode()) % p for i, p in zip(ids, parts.tolist(), strict=True)]
        return (route << 31) + np.array(salt, np.int64)


class Shard:
    """Documents with a BM25 inverted index over all their words."""

    def __init__(self, doc_ids: list, texts: pa.Array, words: Words):
        e = Encoded(texts, words)
        self._index(doc_ids, e.tokens, e.sizes, e.doc, e.term, e.tf)

    @classmethod
    def of(cls, rows: pa.Table, kind: str) -> Shard:
        """The shard of encoded rows, whose tokens are of ``kind``."""
        def numbers(name, kind):
            return [np.frombuffer(x, kind) for x in rows.column(name).to_pylist()]
        terms = numbers("terms", "<u4")
        doc = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
        out = cls.__new__(cls)
        out._index(rows.column("doc_id").to_pylist(), numbers("ids", kind), rows.column("size").to_numpy(), doc,
                   np.concatenate(terms), np.concatenate(numbers("counts", "<u4")))
        return out

    def _index(self, doc_ids: list, tokens: list, sizes: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        n = len(doc_ids)
        end = np.array([END_ID], "<u4").tobytes()
        self.ids, self.tokens = doc_ids, [t.astype("<u4").tobytes() + end for t in tokens]
        number, by_term = _numbered(term)
        self.df, weight = _weights(number, tf, sizes, doc)
        cut = np.append(0, np.cumsum(np.bincount(doc, minlength=n)))
        self.terms_of = [number[a:z] for a, z in zip(cut[:-1].tolist(), cut[1:].tolist())]
        #: Documents that are held, and each term's places among them with their weights.
        self.held = np.arange(n)
        self.doc, self.weight = doc[by_term].astype(np.int32), weight[by_term]
        self.first = np.append(0, np.cumsum(self.df))
        self.size = np.where(self.df > 1, self.df, 0)  # one document's own terms find no other
        # terms of many documents have a row of weights each
        often = np.flatnonzero(self.df * OFTEN >= n)
        self.row = np.full(len(self.df), -1)
        self.row[often] = np.arange(len(often))
        self.rows = np.zeros((len(often), n))
        for i, t in enumerate(often.tolist()):
            at = slice(self.first[t], self.first[t + 1])
            self.rows[i, self.doc[at]] = self.weight[at]

    def forget(self, unused: np.ndarray) -> None:
        """Let go of used documents, which no seed finds again, once they are
        a quarter of those held; all statistics and scores stay."""
        keep = unused[self.held]
        if 4 * np.count_nonzero(keep) >= 3 * len(keep):
            return
        pairs = keep[self.doc]
        ends = np.append(0, np.cumsum(pairs))
        self.doc, self.weight = (np.cumsum(keep, dtype=np.int32) - 1)[self.doc[pairs]], self.weight[pairs]
        self.first = ends[self.first]
        self.size = np.where(self.df > 1, np.diff(self.first), 0)
        self.rows = np.take(self.rows, np.flatnonzero(keep), axis=1)
        self.held = self.held[keep]

    def neighbours(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """Unused documents that share a word with the seed, best score over
        all shared words first, then in order."""
        terms = self.terms_of[seed]
        row = self.row[terms]
        terms = terms[(row < 0) & (self.size[terms] > 0)]
        scores = self.rows.take(row[row >= 0], axis=0).sum(axis=0)
        if len(terms):
            at = _runs(self.first[terms], self.size[terms])
            scores += np.bincount(self.doc.take(at), self.weight.take(at), minlength=len(self.held))
        return _best_first(scores * unused[self.held], self.held)


def _best_first(scores: np.ndarray, held: np.ndarray) -> Iterator[int]:
    """The ``held`` of positive scores, largest first, then in order; sorted
    piece by piece, as most windows are full after a few."""
    at, block = np.flatnonzero(scores > 0), 32
    while len(at):
        s = scores[at]
        top = s >= (np.partition(s, -block)[-block] if len(s) > block else 0)
        yield from held[at[top][np.argsort(-s[top], kind="stable")]].tolist()
        at, block = at[~top], block * 8


class Packer:
    """Windows of one task; ``rows`` are its finished pieces."""

    def __init__(self, task: int, window: int):
        self.sequence, self.window, self.fill = task << 32, window, 0
        self.open: list[tuple] = []
        self.rows: list[tuple] = []

    def _close(self) -> None:
        self.rows += self.open
        self.open, self.fill, self.sequence = [], 0, self.sequence + 1

    def put(self, doc_id, tokens: bytes, start: int) -> int:
        """Put tokens from ``start`` on into the open window; where they end."""
        n = min(len(tokens) // 4 - start, self.window - self.fill)
        self.open.append((doc_id, start, n, tokens[4 * start:4 * (start + n)], len(tokens) // 4, self.sequence, self.fill))
        self.fill += n
        if self.fill == self.window:
            self._close()
        return start + n

    def pack(self, shard: Shard) -> None:
        """Pack all documents of a shard; the last window stays open."""
        unused = np.ones(len(shard.ids), bool)
        following, queue = 0, iter(())
        while True:
            doc = next((d for d in queue if unused[d]), None)
            if doc is None:  # nothing related is left: the next unused document is the seed
                while following < len(unused) and not unused[following]:
                    following += 1
                if following == len(unused):
                    return
                doc = following
                queue = None
            unused[doc] = False
            at, length, window = 0, len(shard.tokens[doc]) // 4, self.sequence
            while at < length:
                at = self.put(shard.ids[doc], shard.tokens[doc], at)
            if queue is None or self.sequence != window:  # a seed, or the rest of a cut document: look up its neighbours
                shard.forget(unused)
                queue = shard.neighbours(doc, unused)

    def finish(self) -> None:
        """Cut the last window into powers of two, which need no padding."""
        while self.fill:
            size = 1 << (self.fill.bit_length() - 1)
            head, rest, got = [], [], 0
            for doc_id, start, n, ids, total, _, _ in self.open:
                take = min(n, size - got)
                if take:
                    head.append((doc_id, start, take, ids[:4 * take], total, self.sequence, got))
                if n > take:
                    rest.append((doc_id, start + take, n - take, ids[4 * take:], total, 0, 0))
                got += take
            left = self.fill - size
            self.open = head
            self._close()
            self.open, self.fill = rest, left


def _encoded(path: str, run_id: str, total: int, routed: bool, shard_bytes: int, shard_docs: int):
    """mapInArrow function: tokens, terms and route of every row."""
    def run(batches):
        words = _words(path, run_id)
        kind, ids, texts, held = pa.null(), [], [], 0

        def out():
            e = Encoded(pa.concat_arrays(texts), words)
            route = e.routes(ids, total, shard_docs) if routed else np.zeros(len(ids), np.int64)
            cut, tf = e.cut.tolist(), e.tf.astype("<u4")
            for i in range(0, len(ids), 256):
                z = min(i + 256, len(ids))
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[i:z], kind), pa.array(route[i:z]), pa.array(e.sizes[i:z]), pa.array(e.bytes[i:z]), pa.array([t.tobytes() for t in e.tokens[i:z]], pa.binary()),
                    *(pa.array([x[a:b].tobytes() for a, b in zip(cut[i:z], cut[i + 1:z + 1])], pa.binary()) for x in (e.term, tf))],
                    names=["doc_id", "route", "size", "bytes", "ids", "terms", "counts"])

        for b in batches:
            kind = b.schema.field("doc_id").type
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                ids += part.column("doc_id").to_pylist()
                texts.append(part.column("text"))
                held += part.column("text").nbytes
                if held >= shard_bytes or len(ids) >= shard_docs:
                    yield from out()
                    ids, texts, held = [], [], 0
        if ids:
            yield from out()
        give_back_memory()
    return run


def _packed(tokens: str, window: int, shard_bytes: int, shard_docs: int):
    """mapInArrow function over encoded rows in the order of their routes."""
    def run(batches):
        from pyspark import TaskContext

        packer = Packer(TaskContext.get().partitionId(), window)
        kind, parts, docs, held = pa.null(), [], 0, 0

        def out():
            cols = list(zip(*packer.rows, strict=True))
            packer.rows = []
            kinds = (kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            for i in range(0, len(cols[0]) if cols else 0, 1024):
                yield pa.RecordBatch.from_arrays([pa.array(c[i:i + 1024], k) for c, k in zip(cols, kinds, strict=True)],
                                                 names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for b in batches:
            kind = b.schema.field("doc_id").type
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                parts.append(part)
                docs, held = docs + part.num_rows, held + pc.sum(part.column("bytes")).as_py()
                if held >= shard_bytes or docs >= shard_docs:
                    packer.pack(Shard.of(pa.Table.from_batches(parts), tokens))
                    parts, docs, held = [], 0, 0
                    yield from out()
        if parts:
            packer.pack(Shard.of(pa.Table.from_batches(parts), tokens))
        packer.finish()
        yield from out()
        give_back_memory()
    return run


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, shard_bytes: int = SHARD_BYTES,
         shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset)
    of all documents: ``ids`` are little-endian unsigned 32-bit token ids,
    ``doc_tokens`` counts the document's with the end id.  ``tokenizer`` is
    the path of a word-BPE file that never joins across white space.

    What fits one shard is packed by one index over everything.  Otherwise
    each document is encoded once and shuffled by its weightiest word, and
    each task packs its rows in the order of these words, shard by shard, so
    related texts of different files meet.  A word of more documents than a
    shard takes is split by doc_id.  Every window holds ``window`` ids
    but a task's last ones, which are cut at powers of two.  Null and empty
    texts are the end id alone; repeated rows are packed each for itself; a
    null doc_id passes through; empty input gives an empty result; other
    columns are not read.  ``docs`` is read twice and should be stored."""
    rows = docs.select("doc_id", "text")
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    shards = max(-(-n // shard_docs), -(-size // shard_bytes), 1)
    tasks = min(shards, max(partitions(docs), size // TASK_BYTES))
    kind = dict(docs.dtypes)["doc_id"]
    encoded = rows.mapInArrow(_encoded(tokenizer, uuid.uuid4().hex, n, shards > 1, shard_bytes, shard_docs),
                              f"doc_id {kind}, route bigint, size bigint, bytes bigint, ids binary, terms binary, counts binary")
    placed = encoded.repartition(tasks, "route").sortWithinPartitions("route", "doc_id", "ids")
    return placed.mapInArrow(_packed(Words(tokenizer).kind, window, shard_bytes, shard_docs), f"doc_id {kind}, {PIECES}")
