"""Benchmark decontamination by winnowing.

Of every ten words in a row the smallest hash of their five-word grams is
kept (the last of equals), by documents and benchmark alike, so whatever ten
words they share, they share the fingerprint chosen within.  Fingerprints
are joined; what meets is extended to the stretches of ten words that chose
it, which are compared by 128-bit digests.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

#: Words of a gram and of a window: every window of SPAN words chooses one of its SPAN - GRAM + 1 grams.
GRAM, SPAN = 5, 10
#: Bits of the filter of benchmark fingerprints per fingerprint, and the logarithms of its least and largest size.
FILTER_BITS, FILTER_LEAST, FILTER_MOST = 64, 16, 27
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 22
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Lower-cases A-Z and turns all other ASCII but letters and digits into spaces.
_TABLE = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


def word_hashes(text: bytes) -> np.ndarray:
    """Two 64-bit hashes of every word of a UTF-8 text (n x 2), split in
    pieces, so that the words of a long text are not held together."""
    from xxhash import xxh3_128_digest

    flat, out, a = text.translate(_TABLE), [], 0
    while a < len(flat):
        z = flat.find(b" ", a + PIECE)
        z = len(flat) if z < 0 else z
        out.append(b"".join(map(xxh3_128_digest, flat[a:z].split())))
        a = z
    return np.frombuffer(b"".join(out), "<u8").reshape(-1, 2)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` words from every place on, polynomials of their
    words' hashes; places without that many words after them hold no gram."""
    out = np.zeros_like(words)
    for j in range(size):
        out *= _BASE
        out[:max(len(words) - j, 0)] += words[j:]
    return out


def winnow(grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Place of the smallest gram hash, the last of equals, of the window at
    each of ``starts``."""
    at = starts.copy()
    for j in range(1, SPAN - GRAM + 1):
        at = np.where(grams[starts + j] <= grams[at], starts + j, at)
    return at


def fingerprints(words: np.ndarray, starts: np.ndarray, short: list[tuple[int, np.ndarray]], passes) -> tuple[np.ndarray, ...]:
    """(place of the first window, fingerprint, number of windows, digests of
    all windows), where ``passes`` lets the fingerprint through: of the
    windows of SPAN words at ``starts``, of which neighbours that choose one
    gram share its fingerprint, and of the windows of ``short`` (length,
    starts), which are their own."""
    grams = gram_hashes(words, GRAM)[:, 0]
    at = winnow(grams, starts)
    keep = passes(grams[at])
    starts, at = starts[keep], at[keep]
    new = np.flatnonzero(np.diff(at, prepend=-1))
    out = [(starts[new], grams[at[new]], np.diff(np.append(new, len(at))), gram_hashes(words, SPAN)[starts])]
    for size, here in short:
        small = gram_hashes(words, size)
        here = here[passes(small[here, 0])]
        out.append((here, small[here, 0], np.ones(len(here), np.int64), small[here]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _scan(chosen=None, short=()):
    """mapInArrow function over (row, text, further columns): per text a row
    with n_words and the further columns, and per fingerprint a row (h, start
    of its first window, digests of its windows).

    Documents pass ``chosen``, the broadcast filter of the benchmark's
    fingerprints, and the lengths ``short`` of its items of fewer than SPAN
    words; without them the texts are the items."""
    digest = pa.list_(pa.struct([("d1", pa.int64()), ("d2", pa.int64())]))

    def passes(h):
        if chosen is None:
            return np.ones(len(h), bool)
        bits, drop = chosen.value
        return bits[h >> np.uint64(drop + 6)] >> (h >> np.uint64(drop) & np.uint64(63)) & np.uint64(1) == 1

    def run(batches):
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
            cuts = [0, *(np.flatnonzero(np.diff(sizes // PIECE)) + 1).tolist(), batch.num_rows]
            for b in (batch.slice(a, z - a) for a, z in zip(cuts, cuts[1:], strict=False) if a < z):
                hashes = [word_hashes(t or b"") for t in b.column("text").cast(pa.binary()).to_pylist()]
                lens = np.array([len(h) for h in hashes], np.int64)
                words = np.concatenate(hashes)
                doc = np.repeat(np.arange(len(lens)), lens)
                begins = np.cumsum(lens) - lens
                left = np.cumsum(lens)[doc] - np.arange(len(words))  # words from here to the end of the text
                if chosen is None:
                    own = [(m, begins[lens == m]) for m in sorted({*lens.tolist()} & {*range(1, SPAN)})]
                else:
                    own = [(m, np.flatnonzero(left >= m)) for m in short]
                at, h, counts, pairs = fingerprints(words, np.flatnonzero(left >= SPAN), own, passes)
                pairs = pa.StructArray.from_arrays([pa.array(pairs[:, i].view(np.int64)) for i in (0, 1)], names=["d1", "d2"])
                pairs = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pairs)
                further = [c for c in b.schema.names if c not in ("row", "text")]
                names = ["row", "n_words", "h", "start", "digests", *further]
                none = [pa.nulls(b.num_rows, t) for t in (pa.int64(), pa.int64(), digest)]
                yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(lens), *none, *(b.column(c) for c in further)], names=names)
                d = doc[at]
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").take(pa.array(d)), pa.nulls(len(d), pa.int64()), pa.array(h.view(np.int64)), pa.array(at - begins[d]), pairs,
                     *(pa.nulls(len(d), b.schema.field(c).type) for c in further)], names=names)
    return run


def _scanned(texts: DataFrame, label: str, *args) -> DataFrame:
    kept = ", ".join(f"{c} {t}" for c, t in texts.dtypes if c != "text")
    rows = texts.withColumn("row", F.monotonically_increasing_id())
    schema = f"row bigint, n_words bigint, h bigint, start bigint, digests array<struct<d1: bigint, d2: bigint>>, {kept}"
    return stash(rows.mapInArrow(_scan(*args), schema), label)


def _windows(scan: DataFrame) -> DataFrame:
    return scan.select("row", "start", F.posexplode("digests").alias("i", "d")).select("row", (F.col("start") + F.col("i")).alias("s"), "d.d1", "d.d2")


def _filter(marks: DataFrame):
    """Broadcast filter of the fingerprints ``marks``: FILTER_BITS bits for
    each, 2**FILTER_MOST bits (16 MB) at most.  What a full filter lets
    through by mistake is dropped by the join."""
    n = marks.count()
    log = min(max((FILTER_BITS * n).bit_length(), FILTER_LEAST), FILTER_MOST)
    place = F.shiftrightunsigned("h", 64 - log)
    one = F.lit(1).cast("bigint")
    words = marks.select(F.shiftright(place, 6).alias("w"), F.call_function("shiftleft", one, place.bitwiseAND(63).cast("int")).alias("b"))         .groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    bits = np.zeros(2 ** (log - 6), np.uint64)
    bits[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).view(np.uint64)
    return marks.sparkSession.sparkContext.broadcast((bits, 64 - log))


def _set_of(column: str) -> list:
    """Name of the set of the distinct values of ``column`` in a group: their
    number and two order-free digests."""
    return [F.count(column).alias("k0"), F.coalesce(F.bit_xor(F.xxhash64(column)), F.lit(0)).alias("k1"),
            F.coalesce(F.bit_xor(F.xxhash64(F.lit(1), F.col(column))), F.lit(0)).alias("k2")]


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit (words
    inside any occurrence of a window of a benchmark text), n_items and items
    (their item_ids as strings, sorted), contaminated.

    A window is SPAN words of an item in a row; an item of fewer words, but
    not none, is one window.  Null and empty texts have no words; an item
    without an item_id hits words but is not listed, equal item_ids are
    listed once; repeated documents are answered each; empty tables give no
    rows or no hits; other columns are not read.

    Texts are read once and not moved.  Only fingerprints that pass a filter
    of the benchmark's (of fixed size) are joined, never in pairs with items:
    each of their windows meets the one row of that window.  Windows in the
    same items form a set, and documents with the same sets are answered
    once, so a passage that many documents and items share is not paired out."""
    items = _scanned(benchmark.select("text", F.col("item_id").cast("string").alias("item")), "items")
    names = items.where("h is null").select("row", "item", "n_words")
    marks = stash(items.where("h is not null").select("h").distinct(), "marks")
    short = sorted(r.n_words for r in names.where((F.col("n_words") > 0) & (F.col("n_words") < SPAN)).select("n_words").distinct().collect())
    held = _windows(items.where("h is not null")).join(names, "row")         .select("d1", "d2", F.least("n_words", F.lit(SPAN)).alias("size"), "item").distinct()
    held = stash(held, "item-windows")
    windows = stash(held.groupBy("d1", "d2", "size").agg(*_set_of("item")), "windows")
    listed = windows.where("k0 > 0").groupBy("k0", "k1", "k2").agg(F.min(F.struct("d1", "d2")).alias("d")).select("k0", "k1", "k2", "d.*")         .join(held, ["d1", "d2"]).where("item is not null").select(F.struct("k0", "k1", "k2").alias("items"), "item")

    chosen = _filter(marks)
    scan = _scanned(docs.select("doc_id", "text"), "fingerprints", chosen, short)
    ids = scan.where("h is null").select("row", "doc_id", "n_words")
    met = scan.where("h is not null").join(marks, "h", "left_semi")
    hits = stash(_windows(met).join(windows, ["d1", "d2"]).select(
        "row", "s", (F.col("s") + F.col("size")).alias("e"), F.when(F.col("k0") > 0, F.struct("k0", "k1", "k2")).alias("items")), "hits")
    before = Window.partitionBy("row").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("e") - F.greatest("s", F.coalesce(F.max("e").over(before), F.lit(0)))
    n_hit = hits.select("row", F.greatest(fresh, F.lit(0)).alias("n")).groupBy("row").agg(F.sum("n").alias("n_hit"))
    sets = stash(hits.select("row", "items").where("items is not null").distinct(), "item-sets")
    kinds = stash(sets.groupBy("row").agg(*_set_of("items")), "kinds")
    key = ["k0", "k1", "k2"]
    first = kinds.groupBy(*key).agg(F.min("row").alias("row"))
    answers = first.join(sets, "row").join(listed, "items").select(*key, "item").distinct()         .groupBy(*key).agg(F.array_sort(F.collect_list("item")).alias("items"))  # the answer itself
    found = n_hit.join(kinds, "row", "left").join(answers, key, "left").select("row", "n_hit", "items")
    none = F.array().cast("array<string>")
    return ids.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"), F.size(F.coalesce("items", none)).cast("bigint").alias("n_items"),
        F.coalesce("items", none).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))
