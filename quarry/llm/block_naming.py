"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of a fixed size.  Distinct blocks get
integer names by sorting, then adjacent pairs of names are named the same
way, level by level, until each document has one name.  Two documents with
as many blocks share that name exactly if their texts are equal: names are
ranks of distinct values, not hashes, so there are no collisions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.frames import once
from .common import KEY, SPACES, columns_of, keyed, meet, sorted_names, stash, text_of

BLOCK_BYTES = 4096


def normalised(column: str = "text") -> Column:
    """UTF-8 of the text without ASCII white space."""
    return F.translate(text_of(column), SPACES, "").cast("binary")


def _blocks(rows: DataFrame, size: int, hashed) -> DataFrame:
    """(*rows but norm, n_blocks, pos, block, h): the blocks of ``norm``."""
    n = F.greatest(F.lit(1), F.ceil(F.octet_length("norm") / size)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.col("n_blocks") - 1),
                      lambda i: F.substring(F.col("norm"), i * size + 1, F.lit(size)))
    return rows.withColumn("n_blocks", n).select("*", F.posexplode(cut).alias("pos", "block")) \
        .drop("norm").withColumn("h", hashed(F.col("block")))


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hashed=F.xxhash64) -> DataFrame:
    """(KEY, doc_id, n_chars, text_sha256, n_blocks, name) of every row of a
    :func:`keyed` frame, stored.  (n_blocks, name) is the same exactly for
    equal normalised texts.

    Block texts move once, combined before the shuffle, to be compared.  The
    occurrences refer to them by a 64-bit hash; blocks that differ but share
    one are told apart by their rank among those (``hashed`` is a parameter
    so that tests can force that)."""
    base = once(docs.select(KEY, "doc_id", "text"), "norm", normalised())
    rows = base.select(KEY, "doc_id", F.char_length(text_of()).cast("bigint").alias("n_chars"),
                       F.sha2("norm", 256).alias("text_sha256"), "norm")
    occ = stash(_blocks(rows, block_bytes, hashed).drop("block"), "blocks")
    blocks = _blocks(base.select(KEY, "norm"), block_bytes, hashed)
    per_hash = stash(blocks.select("h", "block").distinct().groupBy("h").agg(F.count("*").alias("n")), "hashes")
    shared = per_hash.where("n > 1").select("h")
    occ = occ.withColumn("rank", F.lit(0).cast("bigint"))
    if shared.limit(1).count():
        told = stash(blocks.join(shared, "h"), "shared")
        ranks = sorted_names(told, ["h", "block"], "rank")
        at = told.join(ranks, ["h", "block"]).select(F.col(KEY).alias("k"), F.col("pos").alias("p"), F.col("rank").alias("r"))
        occ = occ.join(at, (F.col(KEY) == F.col("k")) & (F.col("pos") == F.col("p")), "left") \
            .withColumn("rank", F.coalesce("r", "rank")).drop("k", "p", "r")
    named = stash(occ.join(sorted_names(occ, ["h", "rank"]), ["h", "rank"]), "level")
    facts = ["doc_id", "n_chars", "text_sha256", "n_blocks"]
    out = named.where("n_blocks = 1").select(KEY, *facts, "name")
    heads = named.where("n_blocks > 1 and pos = 0").select(KEY, *facts)
    longest = named.agg(F.max("n_blocks")).first()[0] or 1
    level, width, done = named.where("n_blocks > 1").select(KEY, "n_blocks", "pos", "name"), 1, None
    while width < longest:
        width *= 2
        half = F.pmod("pos", F.lit(2))
        pairs = stash(level.groupBy(KEY, "n_blocks", F.floor(F.col("pos") / 2).alias("pos")).agg(
            F.max(F.when(half == 0, F.col("name"))).alias("l"),
            F.coalesce(F.max(F.when(half == 1, F.col("name"))), F.lit(-1)).alias("r")), "pairs")
        level = stash(pairs.join(sorted_names(pairs, ["l", "r"]), ["l", "r"]).select(KEY, "n_blocks", "pos", "name"), "level")
        ended = level.where(F.col("n_blocks") <= width).select(F.col(KEY).alias("k"), "name")
        done = ended if done is None else done.unionAll(ended)
        level = level.where(F.col("n_blocks") > width)
    if done is not None:
        out = out.unionAll(heads.join(done, F.col(KEY) == F.col("k")).select(KEY, *facts, "name"))
    return stash(out, "identities")


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hashed=F.xxhash64) -> DataFrame:
    """One row per row of a :func:`keyed` frame: KEY, doc_id, keep_id,
    group_size, kept, text_sha256.

    Texts are equal when identical without ASCII white space; null counts
    as empty, and empty texts equal each other.  Of equal texts the row with
    the most code points stays, then the smallest doc_id (null last), then
    the first row, so of repeated rows one stays.  Empty input gives an
    empty result; other columns are not read."""
    rows = identities(docs, block_bytes, hashed)
    best = F.struct((-F.col("n_chars")).alias("c"), F.col("doc_id").isNull().alias("none"),
                    F.col("doc_id").alias("id"), F.col(KEY).alias("key"))
    groups = stash(rows.groupBy(F.col("n_blocks").alias("gb"), F.col("name").alias("gn")).agg(
        F.count("*").alias("group_size"), F.min(best).alias("best")), "groups")
    return rows.join(groups, (F.col("n_blocks") == F.col("gb")) & (F.col("name") == F.col("gn"))).select(
        KEY, "doc_id", F.col("best.id").alias("keep_id"), "group_size",
        (F.col(KEY) == F.col("best.key")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with one row of each group, see :func:`exact_duplicates`."""
    rows = keyed(docs)
    stay = stash(exact_duplicates(rows, block_bytes).where("kept").select(KEY), "kept")
    return meet(rows, stay, KEY, "left_semi").select(*columns_of(docs))
