"""Repeated passages by content-defined chunking.

A gear rolling hash over the UTF-8 bytes cuts each text where the hash of
the last 32 bytes is small and no such place lies just before; where they
lie in a row, every so often.  Cuts depend on nearby content alone and a passage
gets the same inner chunks wherever it stands.  Chunks are deduplicated by
a 128-bit digest; of neighbouring repeated chunks short sequences are
digested in turn, and those that repeat join to passages.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY, columns_of, discard, keyed, meet, repeated, stash

#: One byte in RATE is a candidate cut; a candidate counts if none lies in the MIN_CHUNK bytes before it.
RATE, MIN_CHUNK, MAX_CHUNK = 16, 12, 1024
#: Code points that a passage of repeated chunks must have.
MIN_PASSAGE = 80
_WINDOW = 32
#: The gear table, from a rule.
GEAR = np.array([int.from_bytes(hashlib.sha256(bytes([c])).digest()[:4], "little") for c in range(256)], np.uint32)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: the sum of the table entries of the last 32
    bytes, each shifted by its distance, built by doubling."""
    h = GEAR[data]
    reach = 1
    while reach < _WINDOW:
        h[reach:] += h[:-reach] << np.uint32(reach)
        reach *= 2
    return h


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text's bytes, at starts of characters."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    starts = (data & 0xC0) != 0x80
    at = np.flatnonzero((gear_hash(data)[:-1] < np.uint32(2**32 // RATE)) & starts[1:]) + 1
    lead = np.flatnonzero(np.diff(at, prepend=-MIN_CHUNK) >= MIN_CHUNK)
    tail = np.append(lead[1:], len(at))[:len(lead)] - 1
    dense = np.flatnonzero(at[tail] - at[lead] >= 2 * MIN_CHUNK)
    more = []
    for a, z in zip(lead[dense].tolist(), tail[dense].tolist(), strict=True):  # repetitive text: candidates in a row
        last = at[a]
        for c in at[a + 1:z + 1].tolist():
            if c - last >= MIN_CHUNK:
                more.append(c)
                last = c
    at = at[lead]
    if more:
        at = np.union1d(at, more)
    ends = np.append(at, n)
    if (np.diff(ends, prepend=0) > MAX_CHUNK).any():
        more = []
        for a, z in zip(np.append(0, at).tolist(), ends.tolist(), strict=True):
            while z - a > MAX_CHUNK:
                a += MAX_CHUNK
                while not starts[a]:
                    a -= 1
                more.append(a)
            more.append(z)
        ends = np.array(more)
    return ends


def chunks(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start and length in code points, two halves of the digest) of the chunks."""
    from xxhash import xxh3_128_digest

    data = np.frombuffer(text, np.uint8)
    ends = cuts(data)
    if not len(ends):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    begins = np.append(0, ends[:-1])
    count = np.cumsum((data & 0xC0) != 0x80)
    stops = count[ends - 1]
    starts = np.append(0, stops[:-1])
    digests = list(map(xxh3_128_digest, map(text.__getitem__, map(slice, begins.tolist(), ends.tolist()))))
    halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return starts, stops - starts, halves[:, 0], halves[:, 1]


def _rows(batches):
    """Chunk rows of the texts, and one row without a place per text."""
    names = ["row", "place", "d1", "d2", "doc_id", KEY]
    for b in batches:
        none = pa.nulls(b.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("row"), none, none, none, b.column("doc_id"), b.column(KEY)], names=names)
        for i in range(0, b.num_rows, 256):
            part = b.slice(i, 256)
            got = [chunks(t or b"") for t in part.column("text").cast(pa.binary()).to_pylist()]
            row = np.repeat(part.column("row").to_numpy(), [len(g[0]) for g in got])
            start, length, d1, d2 = (np.concatenate([g[j] for g in got]) for j in range(4))
            place = (start << 11) | length
            rest = [pa.nulls(len(row), b.schema.field(x).type) for x in ("doc_id", KEY)]
            yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int64)) for x in (row, place, d1, d2)), *rest], names=names)


def _start():
    return F.shiftright("place", 11)


def _length():
    return F.col("place").bitwiseAND(2047)


def _digest(frame) -> list:
    """Two halves of the digest of the chunks that a window frame holds."""
    d = F.collect_list(F.struct("d1", "d2")).over(frame)
    return [F.xxhash64(F.lit(i), d).alias(f"h{i}") for i in (1, 2)]


def passages(docs: DataFrame, min_passage: int = MIN_PASSAGE) -> DataFrame:
    """Repeated passages of a :func:`keyed` frame: KEY, doc_id, start, end
    (code points, end exclusive), copy_doc_id, kept and cuts.

    The shortest sequences of whole chunks of together ``min_passage`` code
    points or more are looked up by digest.  Of those that repeat, each has a
    nearest copy: the one before it, in row order and then by place, or for
    the first one the copy after it.  Touching or overlapping sequences whose
    nearest copies lie in one text at one distance are a passage, so its
    whole text stands there too, in the document copy_doc_id (it may be the
    same one); passages may overlap.  ``kept`` is true for passages of first
    copies.  ``cuts`` is what may go: the passage itself where ``kept`` is
    false, else nothing; the first copy of a chunk is in no cut.  Null and
    empty texts have no passages; repeated rows repeat all their text; empty
    input gives an empty result; other columns are not read.

    The texts are read once and not moved.  Chunks, four numbers each, are
    shuffled once, range-sorted by digest (:func:`repeated`), so a very
    common passage is spread; only repeated chunks go back to their texts,
    and only the sequences of touching ones are sorted in turn."""
    rows = docs.select(KEY, "doc_id", "text", F.monotonically_increasing_id().alias("row"))
    kind = dict(rows.dtypes)
    cut = stash(rows.mapInArrow(_rows, f"row bigint, place bigint, d1 bigint, d2 bigint, doc_id {kind['doc_id']}, {KEY} {kind[KEY]}"), "chunks")
    ids = stash(cut.where("place is null").select("row", "doc_id", KEY), "ids")
    hit = repeated(cut.where("place is not null").select("row", "place", "d1", "d2"), ["d1", "d2"], ["row", "place"])
    w = Window.partitionBy("row").orderBy("place")
    runs = hit.select("row", _start().alias("s"), (_start() + _length()).alias("e"), "d1", "d2",
                      F.coalesce(F.lag(_start() + _length()).over(w) != _start(), F.lit(True)).cast("int").alias("new"), "place") \
        .withColumn("run", F.sum("new").over(w))
    run = Window.partitionBy("row", "run")
    ahead = run.orderBy("s").rangeBetween(0, min_passage - 1)
    back = run.orderBy("e").rangeBetween(1 - min_passage, 0)
    far, near = F.max("e").over(ahead), F.min("s").over(back)
    parts = runs.select("row", "s", "e",
                        F.when(far - F.col("s") >= min_passage, F.struct(F.col("s"), far.alias("e"), *_digest(ahead))).alias("ahead"),
                        # one that is also the shortest from its start is there already
                        F.when(F.col("s") - near >= min_passage, F.struct(near.alias("s"), F.col("e"), *_digest(back))).alias("back"))
    parts = stash(parts.select("row", F.explode(F.array_compact(F.array("ahead", "back"))).alias("x")).select("row", "x.*"), "parts")
    again = repeated(parts, ["h1", "h2"], ["row", "s"]).select("row", "s", "e", "first", "near_row", (F.col("s") - F.col("near_s")).alias("shift"))
    same = ["row", "first", "near_row", "shift"]  # sequences that stand alike at one other place: so does their union
    w = Window.partitionBy(*same).orderBy("s", "e")
    reach = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    again = again.withColumn("new", F.coalesce(reach < F.col("s"), F.lit(True)).cast("int")).withColumn("part", F.sum("new").over(w))
    found = stash(again.groupBy(*same, "part").agg(F.min("s").alias("start"), F.max("e").alias("end")), "passages")
    for done in (cut, parts):
        discard(done)
    copy = ids.select(F.col("row").alias("near_row"), F.col("doc_id").alias("copy_doc_id"))
    whole = F.array(F.struct("start", "end"))
    return found.join(copy, "near_row").join(ids, "row").select(
        KEY, "doc_id", "start", "end", "copy_doc_id", F.col("first").alias("kept"), F.filter(whole, lambda x: ~F.col("first")).alias("cuts"))


def strip_repeats(docs: DataFrame, min_passage: int = MIN_PASSAGE) -> DataFrame:
    """``docs`` with the cuts of its passages taken out of ``text``."""
    rows, cut = keyed(docs), f"{KEY}_cut"
    w = Window.partitionBy(KEY).orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    cuts = passages(rows, min_passage).select(KEY, F.explode("cuts").alias("x")).select(KEY, "x.*") \
        .withColumn("new", F.coalesce(reach < F.col("start"), F.lit(True)).cast("int")).withColumn("n", F.sum("new").over(w))
    cuts = cuts.groupBy(KEY, "n").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    gone = stash(cuts.groupBy(KEY).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(cut)), "gone")  # one text's own cuts
    none, end = F.lit(0).cast("bigint"), F.char_length("text").cast("bigint")
    keep = F.transform(F.sequence(F.lit(0), F.size(cut)), lambda i: F.struct(
        F.coalesce(F.get(cut, i - 1)["end"], none).alias("a"), F.coalesce(F.get(cut, i)["start"], end).alias("z")))
    left = F.array_join(F.transform(keep, lambda x: F.substring("text", (x["a"] + 1).cast("int"), (x["z"] - x["a"]).cast("int"))), "")
    text = F.when(F.col(cut).isNull(), F.col("text")).otherwise(left)
    return meet(rows, gone, KEY, "left").withColumn("text", text).select(*columns_of(docs))
