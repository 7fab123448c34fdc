"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the bit radius;
two fingerprints within the radius meet at a common variant.  What meets is
deduplicated, verified and joined to components.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY, columns_of, keyed, meet, stash
from .components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
_BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of a text: words between ASCII white space with
    A-Z lower-cased, ``shingle``-word windows hashed by XXH64; a bit is one
    if set in over half the hashes.  No words: zero."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    spans = map(slice, starts[:n].tolist(), last.tolist())
    hashes = np.fromiter(map(partial(xxh64_intdigest, seed=SEED), map(line.__getitem__, spans)), "<u8", n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _BLOCK):  # bounds memory for very long texts
        bits = np.unpackbits(hashes[i:i + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def _batches(shingle: int):
    def run(batches):
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            fp = pa.array([fingerprint(t or b"", shingle) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(KEY), b.column("doc_id"), fp], names=[KEY, "doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(KEY, doc_id, fp) of every row of a :func:`keyed` frame, stored."""
    d = docs.select(KEY, "doc_id", "text")
    kind = dict(d.dtypes)
    out = d.mapInArrow(_batches(shingle), f"{KEY} {kind[KEY]}, doc_id {kind['doc_id']}, fp bigint")
    return stash(out, "fingerprints")


def ball(bits: int) -> list[tuple[int, int]]:
    """(mask, flipped bits) of all variants within ``bits``."""
    masks = []
    for r in range(bits + 1):
        for places in combinations(range(64), r):
            m = sum(1 << p for p in places)
            masks.append((m - (1 << 64) if m >> 63 else m, r))
    return masks


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links between distinct fingerprints that keep every component of the
    graph "at most ``max_bits`` differing bits".

    Variants reach ceil(radius / 2) bits.  Members within floor(radius / 2)
    of a variant are within the radius of everything that meets there, so
    each member is linked to the smallest of those alone: no pairs of a
    group are listed, and no component is cut."""
    far, near = (max_bits + 1) // 2, max_bits // 2
    masks = F.array(*[F.struct(F.lit(m).cast("bigint").alias("m"), F.lit(r <= near).alias("near")) for m, r in ball(far)])
    spread = fps.select("fp", F.explode(masks).alias("x")).select(
        F.col("fp").bitwiseXOR(F.col("x.m")).alias("variant"), "fp", "x.near")
    centre = F.min(F.when(F.col("near"), F.col("fp"))).over(Window.partitionBy("variant"))
    met = spread.select("fp", centre.alias("other")).where("other is not null and fp != other").distinct()
    return met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of a :func:`keyed` frame: KEY, doc_id, fp (signed),
    component_id (smallest doc_id reachable over links of at most
    ``max_bits`` bits) and kept (true for one row of each component: its
    smallest doc_id, then the first row).

    Null and empty texts, and texts without words, have fingerprint zero
    and link like any other.  Null doc_ids count after all others; a
    component of null ids alone has a null component_id.  Repeated rows
    share a component and all but one are not kept.  Empty input gives an
    empty result; other columns are not read."""
    rows = fingerprints(docs, shingle)
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(KEY).alias("key"))
    fps = stash(rows.groupBy("fp").agg(F.min(first).alias("first")), "fps")
    roots = components(fingerprint_links(fps.select("fp"), max_bits), "fp", "other")
    member = stash(fps.join(roots, F.col("fp") == F.col("node"), "left")
                   .select("fp", "first", F.coalesce("root", "fp").alias("root")), "members")
    top = stash(member.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("top")), "tops")
    labels = stash(member.join(top, F.col("root") == F.col("r")).select(F.col("fp").alias("lfp"), "top"), "labels")
    return rows.join(labels, F.col("fp") == F.col("lfp")).select(
        KEY, "doc_id", "fp", F.col("top.id").alias("component_id"), (F.col(KEY) == F.col("top.key")).alias("kept"))


def near_dedup(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component, see :func:`near_duplicates`."""
    rows = keyed(docs)
    stay = stash(near_duplicates(rows, shingle, max_bits).where("kept").select(KEY), "kept")
    return meet(rows, stay, KEY, "left_semi").select(*columns_of(docs))


def fingerprint_hex(column: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
