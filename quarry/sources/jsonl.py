"""JSONL scans.

Every reader attaches ``ord``: a struct that reproduces input order
(argument index, file path, split start, row within split).  It is taken
right after the scan, before any shuffle, so "first occurrence wins"
semantics survive any later partitioning.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import render_chat, strip

MESSAGES_TYPE = "array<struct<role:string,content:string>>"


def read_lines(spark: SparkSession, path, src: int = 0, recursive: bool = True,
               glob: str | None = None) -> DataFrame:
    """Non-blank lines of text files with an input-order key ``ord``."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.text(path)
    df = df.select(
        F.struct(
            F.lit(src).alias("src"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("ord"),
        F.col("value"),
    )
    return df.where(strip("value") != F.lit(""))


def strict_json(c) -> Column:
    """Parse one JSON value strictly: trailing garbage or several values make
    it null (``try_parse_json`` alone accepts ``{"a":1} trailing``)."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), strip(c), F.lit("]")))
    items = F.try_variant_get(wrapped, "$", "array<variant>")
    return F.when(F.size(items) == F.lit(1), F.get(items, 0))


def is_object(v) -> Column:
    """True for a JSON object (a cast, not a walk of the whole value)."""
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def parse_records(lines: DataFrame) -> DataFrame:
    """``value`` -> ``rec`` VARIANT (objects only) + ``bad_json`` flag.

    The parsed value is produced by a one-row ``explode`` (a Generate):
    predicates on it cannot be pushed below the Generate, so every line is
    parsed exactly once instead of once per pushed-down reference."""
    keep = [c for c in lines.columns if c != "value"]
    parsed = lines.select(*keep, F.explode(F.array(strict_json(F.col("value")))).alias("_v"))
    v = F.col("_v")
    return parsed.select(
        *keep,
        F.when(is_object(v), v).alias("rec"),
        (~is_object(v)).alias("bad_json"),
    )


# ------------------------------------------------------------------- S1
JSONL_GLOB = "*.[jJ][sS][oO][nN][lL]"


def read_logs(spark: SparkSession, path, keep_bad: bool = False, glob: str = JSONL_GLOB) -> DataFrame:
    """Recursive scan of ``*.jsonl`` logs (extension case-insensitive);
    blank and unparsable lines are skipped unless ``keep_bad``."""
    lines = read_lines(spark, path, glob=glob)
    recs = parse_records(lines)
    return recs if keep_bad else recs.where(~F.col("bad_json"))


def messages_of(rec) -> Column:
    """``obj.get("messages") or []`` typed as array<struct<role, content>>."""
    m = F.try_variant_get(rec, "$.messages", MESSAGES_TYPE)
    return F.coalesce(m, F.array().cast(MESSAGES_TYPE))


def _with_raw(lines: DataFrame) -> DataFrame:
    """``raw``: the JSON text of a line's messages, streamed through without
    a parsed value in between."""
    return lines.withColumn("raw", F.get_json_object("value", "$.messages"))


# ------------------------------------------------------------------- S2
def read_chat(spark: SparkSession, path) -> DataFrame:
    """Chat JSONL; bad lines are kept and flagged (the QC counts them).
    ``messages`` is the typed view that the operators read (a content that is
    no text is its JSON text); ``rec`` is the whole record, and ``raw`` the
    text of its messages, so the writers put out every key in its order and
    every number as it was written."""
    recs = parse_records(_with_raw(read_lines(spark, path, recursive=False)))
    return recs.select("ord", messages_of(F.col("rec")).alias("messages"), "rec", "raw", "bad_json")


# ------------------------------------------------------------------- S3
def read_chat_many(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Several inputs in argument order; bad lines and rows with empty
    ``messages`` are skipped.  ``rec`` and ``raw`` as in :func:`read_chat`."""
    out = None
    for i, p in enumerate(paths):
        recs = parse_records(_with_raw(read_lines(spark, p, src=i, recursive=False)))
        df = recs.where(~F.col("bad_json")).select(
            "ord", F.lit(i).alias("src"), messages_of(F.col("rec")).alias("messages"), "rec", "raw")
        df = df.where(F.size("messages") > 0)
        out = df if out is None else out.unionByName(df)
    return out


# ------------------------------------------------------------------- S4
def read_examples(spark: SparkSession, path, keep_empty: bool = False, **render_kw) -> DataFrame:
    """Rows with ``text`` (preferred) or ``messages``; rows with neither are
    skipped, or stay with an empty ``text`` when ``keep_empty`` (so that a
    report can count them).  ``text`` here is the training text of the row;
    ``rec`` is the whole record and ``line`` its JSON text."""
    lines = read_lines(spark, path, recursive=False).withColumn("line", F.col("value"))
    recs = parse_records(lines).where(~F.col("bad_json"))
    raw_text = F.try_variant_get(F.col("rec"), "$.text", "string")
    msgs = F.try_variant_get(F.col("rec"), "$.messages", MESSAGES_TYPE)
    text = F.coalesce(
        F.nullif(raw_text, F.lit("")),
        F.when(F.size(msgs) > 0, render_chat(msgs, **render_kw)),
    )
    out = recs.select("ord", F.coalesce(text, F.lit("")).alias("text"), msgs.alias("messages"), "rec", "line")
    return out if keep_empty else out.where(F.col("text") != F.lit(""))


# ------------------------------------------------------------------- S7
def _load(spark: SparkSession, path: str) -> DataFrame:
    recs = parse_records(_with_raw(read_lines(spark, path, recursive=False)))

    def field(name, kind="string"):
        return F.try_variant_get("rec", f"$.{name}", kind).alias(name)
    return recs.select(field("messages", MESSAGES_TYPE), field("text"), field("assistant"), "rec", "raw")


def load_dataset(spark: SparkSession, train: str, eval: str | None = None, schema: str | None = None):
    """Training set plus optional eval set; a missing eval path gives
    ``None`` (a warning), any other error propagates.

    Every column of the records is there: ``messages``, ``text`` and
    ``assistant`` typed, all keys in ``rec``, and the messages as written in
    ``raw``; no pass over the data infers a schema.  With ``schema`` the
    columns are those of the schema instead."""
    def load(path):
        return spark.read.schema(schema).json(path) if schema else _load(spark, path)
    tr = load(train)
    ev = None
    if eval is not None:
        try:
            ev = load(eval)
        except AnalysisException as e:  # only a missing path is tolerated
            if "PATH_NOT_FOUND" not in str(e.getCondition() or e):
                raise
            import warnings
            warnings.warn(f"no eval set: {eval}")
    return tr, ev
