"""Streaming runs (T1-T4) over driver tables: the rows arrive as files in
several runs, each run takes what is available (``availableNow``), and what
the sink holds must equal the batch answer."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import ensure_checkpoint_dir
from ..sources import jsonl as J
from ..streaming import incremental as I
from ..streaming import seen as N
from ..streaming import sessions as SS
from . import oracle as O
from . import standins as S
from .queries import FOLLOW_K, FOLLOW_MIN_CHARS, FOLLOW_MINUTES, QC_MAX_TOKENS, query, transcript_md5

SQL = O.SQL
RUNS = 3


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("stream_export")
def stream_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + T2: three nightly exports of new chat files; the cascade's kept
    signatures, and how many rows the runs said they wrote."""
    ex = S.chat_examples(spark, sf_dir, upper_copy=True).select(
        "conv_id", F.to_json(F.struct("messages")).alias("value"))
    base = _folder(spark, "export")
    said = 0
    for run in range(RUNS):
        ex.where(F.col("conv_id") % RUNS == run).select("value").write.mode("append").text(f"{base}/in")
        said += I.incremental(spark, f"{base}/in", f"{base}/out", f"{base}/state", max_tokens=QC_MAX_TOKENS, max_files=4)
    back = J.read_chat(spark, f"{base}/out")
    return back.select(T.qc_signature("messages").alias("sig"), F.lit(said).cast("bigint").alias("written"))


def _turn_stream(spark: SparkSession, base: str, turns: DataFrame, files: int = 64):
    return spark.readStream.schema(turns.schema).option("maxFilesPerTrigger", str(files)).parquet(f"{base}/in")


def _slice(turns: DataFrame):
    """Which third of the time a turn lies in."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    cut = turns.agg(F.min(us), F.max(us)).first()
    return F.least(F.lit(RUNS - 1), F.floor((us - cut[0]) * RUNS / (cut[1] - cut[0] + 1)))


def _runs(turns: DataFrame, base: str, part, job) -> None:
    """The turns arrive in ``RUNS`` parts; after each the stream takes what
    is new."""
    for run in range(RUNS):
        turns.where(part == run).write.mode("append").parquet(f"{base}/in")
        job()


@query("stream_seen")
def stream_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + T2 with the signatures of earlier runs in a bucketed table."""
    ex = S.chat_examples(spark, sf_dir, upper_copy=True).select(
        "conv_id", F.to_json(F.struct("messages")).alias("value"))
    base = _folder(spark, "seen")
    said = 0
    for run in range(RUNS):
        ex.where(F.col("conv_id") % RUNS == run).select("value").write.mode("append").text(f"{base}/in")
        said += N.incremental_seen(spark, f"{base}/in", f"{base}/out", f"{base}/state", max_tokens=QC_MAX_TOKENS, max_files=64, buckets=8)
    back = J.read_chat(spark, f"{base}/out/*")
    return back.select(T.qc_signature("messages").alias("sig"), F.lit(said).cast("bigint").alias("written"))


HORIZON_DAYS = 2


@query("stream_horizon")
def stream_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 with a horizon: every conversation comes twice, the second time
    upper-cased, half of them within the horizon and half beyond it.  The
    days are files, taken one after another."""
    at = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(
        days=F.when(F.col("ord.src") == 0, 0).when(F.col("conv_id") % 2 == 0, 1).otherwise(9).cast("int"))
    ex = S.chat_examples(spark, sf_dir, upper_copy=True).select("messages", at.alias("at"))
    one = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(c).alias("content")) for r, c in (("user", "x" * 100), ("assistant", "y"))])
    ex = ex.unionByName(spark.range(1).select(one.alias("messages"), F.lit("2024-01-06").cast("timestamp").alias("at")))  # time passes
    base = _folder(spark, "horizon")
    for day in (1, 2, 6, 10):
        ex.where(F.dayofmonth("at") == day).write.mode("append").parquet(f"{base}/in")
        for _ in range(2):
            stream = spark.readStream.schema(ex.schema).parquet(f"{base}/in")
            q = (I.stream_qc(stream, max_tokens=QC_MAX_TOKENS, horizon=f"{HORIZON_DAYS} days", event_time="at").select("sig", "at")
                 .writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state")
                 .outputMode("append").trigger(availableNow=True).start())
            q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("sig", F.dayofmonth("at").cast("bigint").alias("day"))


@query("stream_pairs")
def stream_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of the event turns, pending user text kept between runs."""
    turns = S.event_turns(spark, sf_dir).withColumn("seq", F.col("event_id")).drop("ord")
    base = _folder(spark, "pairs")
    _runs(turns, base, _slice(turns), lambda: SS.pairs_job(_turn_stream(spark, base, turns), f"{base}/out", f"{base}/state", ttl="7 days"))
    return spark.read.parquet(f"{base}/out").select("session_id", transcript_md5().alias("msg_md5"))


@query("stream_pairs_one_session")
def stream_pairs_one_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 where one session holds every row: its islands are closed by the
    segmented scan, and the state sees one row per batch."""
    turns = S.event_turns(spark, sf_dir).withColumns({"seq": F.col("event_id"), "session_id": F.lit("default")}).drop("ord")
    base = _folder(spark, "pairs-one")
    _runs(turns, base, _slice(turns), lambda: SS.pairs_job(_turn_stream(spark, base, turns), f"{base}/out", f"{base}/state", hot_rows=100))
    return spark.read.parquet(f"{base}/out").select("session_id", transcript_md5().alias("msg_md5"))


def _follow(spark: SparkSession, turns: DataFrame, name: str, part, files: int = 64, **options) -> DataFrame:
    base = _folder(spark, name)

    def job():
        SS.follow_job(_turn_stream(spark, base, turns, files), f"{base}/out", f"{base}/state", FOLLOW_K, FOLLOW_MINUTES, FOLLOW_MIN_CHARS, **options)
    _runs(turns, base, part, job)
    ahead = turns.limit(1).withColumns({"session_id": F.lit("~"), "ts": F.col("ts") + F.make_dt_interval(days=F.lit(36500)),
                                        "role": F.lit("error"), "has_human": F.lit(False)})
    ahead.write.mode("append").parquet(f"{base}/in")
    for _ in range(2):  # a row far ahead moves the watermark, the next run closes what is open
        job()
    return spark.read.parquet(f"{base}/out").select("session_id", "n_follow", transcript_md5().alias("msg_md5"))


def _follow_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.event_turns(spark, sf_dir).withColumns({"seq": F.col("event_id"), "ts": F.col("ts").cast("timestamp")}).drop("ord")


@query("stream_follow")
def stream_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: follow windows of the event turns, which arrive in order."""
    turns = _follow_turns(spark, sf_dir)
    return _follow(spark, turns, "follow", _slice(turns))


@query("stream_follow_shuffled")
def stream_follow_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 where the turns arrive in no order: each run brings a third of the
    turns of all times, and the reorder buffer holds them until the
    watermark passes."""
    turns = _follow_turns(spark, sf_dir)
    return _follow(spark, turns, "follow-shuffled", F.col("event_id") % RUNS, lateness="20000 days", hot_rows=100)


SQL["stream_export"] = f"""WITH {O.QC}, k AS (
  SELECT DISTINCT sig FROM qc JOIN s2 USING (src, conv_id) WHERE qc.stage1 IS NULL AND NOT dup AND n_tok <= 700
) SELECT sig, (SELECT count(*) FROM k) AS written FROM k"""
SQL["stream_seen"] = SQL["stream_export"]
SQL["stream_horizon"] = f"""WITH {O.QC}, d AS (
  SELECT DISTINCT sig, CASE WHEN src = 0 THEN 1 WHEN conv_id % 2 = 0 THEN 2 ELSE 10 END AS day FROM s2 WHERE stage1 IS NULL
    AND floor(length(array_to_string(list_transform(messages, lambda m: coalesce(m.content, '')), chr(10))) / 4) <= 700
) SELECT sig, CAST(day AS BIGINT) AS day FROM d
WHERE day = 1 OR (day = 2 AND sig NOT IN (SELECT sig FROM d WHERE day = 1)) OR day = 10
UNION ALL SELECT md5('user:' || repeat('x', 100) || chr(10) || 'assistant:y'), 6"""
SQL["stream_pairs"] = "WITH " + O._EVENT_TURNS.format(session="CAST(user_id AS VARCHAR)", system=O.PAIR_SYS) + \
    " SELECT session_id, msg_md5 FROM p"
SQL["stream_pairs_one_session"] = "WITH " + O._EVENT_TURNS.format(session="'default'", system=O.PAIR_SYS) + \
    " SELECT session_id, msg_md5 FROM p"
SQL["stream_follow"] = f"SELECT session_id, n_follow, msg_md5 FROM ({O.follow_sql(FOLLOW_K, FOLLOW_MINUTES, FOLLOW_MIN_CHARS)}) w"
SQL["stream_follow_shuffled"] = SQL["stream_follow"]
