"""Structured Streaming versions of the nightly export.

* T1 ``incremental``: new chat JSONL files -> QC -> de-duplicated clean
  examples appended to the output; the checkpoint remembers which files
  were processed, so a rerun exports only new material.
* T2 ``stream_qc``: the QC cascade on a stream; the ``seen`` signature set
  is streaming de-duplication state (unbounded, or bounded by a watermark
  horizon with ``dropDuplicatesWithinWatermark``).  "First" means first to
  arrive.  ``seen.py`` keeps the set as a bucketed table instead.
* T3 ``incremental_pairs``: raw logs to pairs; ``sessions.py`` holds the
  pair builder and the follow windows (T4) over streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from ..operators import segments as SG
from ..session import exists
from ..sources.jsonl import messages_of, strict_json, is_object
from .sessions import pairs_job


# ------------------------------------------------------------------- T2
def passes_qc(df: DataFrame, min_user_chars: int) -> Column:
    """Whether a row passes the stages of the cascade before de-duplication."""
    user = T.first_content("messages", "user")
    bad = F.col("bad_json") if "bad_json" in df.columns else F.lit(False)
    return (~bad & T.has_role("messages", "assistant") & ~T.is_blank(user)
            & (F.length(T.strip(user)) >= F.lit(min_user_chars)))


def stream_qc(sdf: DataFrame, min_user_chars: int = K.DEFAULT_MIN_USER_CHARS,
              max_tokens: int = K.DEFAULT_MAX_TOKENS, horizon: str | None = None,
              event_time: str | None = None) -> DataFrame:
    """Kept rows of the QC cascade over a stream with ``messages``
    (and optionally ``bad_json``).  With ``horizon`` (an interval) and
    ``event_time`` a signature is held only until the watermark is that far
    past it, so the state is bounded and a copy beyond is kept again."""
    s = sdf.where(passes_qc(sdf, min_user_chars)).withColumn("sig", T.qc_signature("messages"))
    if horizon is not None and event_time is not None:
        s = s.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(["sig"])
    else:
        s = s.dropDuplicates(["sig"])
    return s.withColumn("n_tok", T.token_estimate("messages")).where(F.col("n_tok") <= F.lit(max_tokens))


def read_chat_stream(spark: SparkSession, src: str, max_files: int | None = None) -> DataFrame:
    """Streaming scan of chat JSONL files (blank lines skipped, bad lines
    flagged)."""
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    lines = r.load(src).where(T.strip("value") != F.lit(""))
    v = strict_json(F.col("value"))
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.when(is_object(v), messages_of(v)).alias("messages"),
        (~is_object(v)).alias("bad_json"))


# ------------------------------------------------------------------- T1
#: New files that one micro-batch takes; bounds what a session has in memory.
MAX_FILES = 1000


def _run(df: DataFrame, out: str, checkpoint: str) -> int:
    """Append ``df`` (one ``value`` column) as text files until all available
    input is taken; the number of rows written and not reported before."""
    q = (df.writeStream.format("text").option("path", out)
         .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return unreported(df.sparkSession, out, checkpoint)


def unreported(spark: SparkSession, out: str, checkpoint: str) -> int:
    """Rows that the file sink has committed to ``out`` since the last call.

    The folder is read through the sink's commit log, which lists whole
    batches only; the time of the newest file counted is kept in the
    checkpoint, and only newer files are read.  A run that ends between two
    batches loses no count: the next one reports what it wrote."""
    if not exists(spark, f"{out}/_spark_metadata"):
        return 0
    mark = f"{checkpoint}/reported"
    changed = F.col("_metadata.file_modification_time")
    rows = spark.read.text(out)
    if exists(spark, mark):
        rows = rows.where(changed > F.timestamp_micros(F.lit(int(spark.read.text(mark).first()[0]))))
    n, newest = rows.agg(F.count(F.lit(1)), F.max(F.unix_micros(changed))).first()
    if newest is not None:
        spark.createDataFrame([(str(newest),)], "value string").coalesce(1).write.mode("overwrite").text(mark)
    return n


def incremental(spark: SparkSession, src: str, out: str, checkpoint: str,
                min_user_chars: int = K.DEFAULT_MIN_USER_CHARS,
                max_tokens: int = K.DEFAULT_MAX_TOKENS, max_files: int = MAX_FILES) -> int:
    """Run one incremental export (``availableNow``, at most ``max_files``
    new files a batch) and return the number of rows written in this run."""
    kept = stream_qc(read_chat_stream(spark, src, max_files), min_user_chars, max_tokens)
    return _run(kept.select(F.to_json(F.struct("messages"), {"ignoreNullFields": "false"}).alias("value")), out, checkpoint)


def normalise_stream(lines: DataFrame, max_tool_chars: int = K.DEFAULT_PAIR_TOOL_CHARS,
                     tool_fallback: bool = True) -> DataFrame:
    """Raw log lines (``value`` + ``seq``) from a stream -> normalised turns."""
    v = strict_json(F.col("value"))
    recs = lines.select(F.col("seq").alias("ord"), F.when(is_object(v), v).alias("rec")).where(
        F.col("rec").isNotNull())
    return SG.normalise(recs, max_tool_chars, tool_fallback).withColumnRenamed("ord", "seq")


# ------------------------------------------------------------------- T1 + T3
def incremental_pairs(spark: SparkSession, src: str, out: str, checkpoint: str,
                      max_tool_chars: int = K.DEFAULT_PAIR_TOOL_CHARS,
                      system: str = K.PAIR_SYSTEM_PROMPT, ttl: str | None = None, max_files: int = MAX_FILES) -> int:
    """Raw agent logs -> pairs, incrementally: new ``*.jsonl`` files under
    ``src`` (at most ``max_files`` a batch) are parsed, normalised and fed to
    the stateful pair builder; a user turn still pending at the end of a run
    is completed by a later run, or forgotten after ``ttl``.  Returns the
    number of pairs written in this run."""
    lines = (spark.readStream.format("text")
             .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[jJ][sS][oO][nN][lL]")
             .option("maxFilesPerTrigger", str(max_files))
             .load(src)
             .where(~T.is_blank("value"))
             # streams have no row ids: ties on the timestamp are broken by
             # file path, then place in the micro-batch
             .select("value", F.col("_metadata.file_path").alias("seq")))
    turns = normalise_stream(lines, max_tool_chars=max_tool_chars, tool_fallback=True)
    pairs_job(turns, out, checkpoint, system, ttl, as_json=True)
    return unreported(spark, out, checkpoint)
