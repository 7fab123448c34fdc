"""Nightly export against a table of the signatures exported before.

``dropDuplicates`` keeps every signature in the state store of each run.
Here they are a table: bucketed by signature, one partition per day and
micro-batch, so a batch shuffles only its own new signatures to the buckets,
old days are dropped whole, and any job can read what was exported.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from ..session import exists, hadoop, materialize
from .incremental import MAX_FILES, passes_qc, read_chat_stream
from .sessions import _stream_batches

BUCKETS = 64


class SeenTable:
    """Signatures ``sig`` of earlier batches below ``path``.

    The folder holds Parquet files bucketed by ``sig`` in partitions (day,
    batch).  The number of buckets is fixed when the folder is made.  The
    catalog entry lasts for the session; the files are the table."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, keep_days: int | None = None):
        self.spark, self.keep_days, self.path = spark, keep_days, path
        self.name = f"seen_{hashlib.md5(path.encode()).hexdigest()}"
        if exists(spark, f"{path}/_table"):
            buckets = int(spark.read.text(f"{path}/_table").first()[0])
        else:
            spark.createDataFrame([(str(buckets),)], "value string").coalesce(1).write.text(f"{path}/_table")
        self.buckets = buckets
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.name} (sig STRING, day DATE, batch BIGINT) USING parquet
            PARTITIONED BY (day, batch) CLUSTERED BY (sig) SORTED BY (sig) INTO {buckets} BUCKETS LOCATION '{path}/rows'""")

    def table(self, batch: int, day) -> DataFrame:
        """What batches before ``batch`` kept and ``day`` has not outlived."""
        self.spark.catalog.refreshTable(self.name)
        seen = self.spark.table(self.name).where(F.col("batch") < batch)
        return seen if self.keep_days is None else seen.where(F.col("day") > F.date_sub(F.lit(day), self.keep_days))

    def fresh(self, sigs: DataFrame, batch: int, day) -> DataFrame:
        """Rows of ``sigs`` (with a column sig) that were not kept before."""
        return sigs.join(self.table(batch, day).select("sig"), "sig", "left_anti")

    def add(self, sigs: DataFrame, batch: int, day) -> None:
        """Keep ``sigs`` for ``batch``; a repeated attempt replaces the one before."""
        view, spark = f"{self.name}_new", sigs.sparkSession  # a micro-batch has a session of its own
        sigs.select("sig").repartition(self.buckets, "sig").createOrReplaceTempView(view)
        spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION (day = DATE '{day}', batch = {int(batch)}) SELECT sig FROM {view}")
        spark.catalog.dropTempView(view)

    def expire(self, day) -> None:
        """Delete the partitions of days that ``day`` has outlived."""
        if self.keep_days is None:
            return
        last = self.spark.range(1).select(F.date_sub(F.lit(day).cast("date"), self.keep_days).cast("string")).first()[0]
        fs, root = hadoop(self.spark, f"{self.path}/rows")
        if fs.exists(root):
            for s in fs.listStatus(root):  # one folder per day
                name = s.getPath().getName()
                if name.startswith("day=") and name[4:] <= last:
                    fs.delete(s.getPath(), True)
        self.spark.catalog.refreshTable(self.name)


def incremental_seen(spark: SparkSession, src: str, out: str, checkpoint: str, min_user_chars: int = K.DEFAULT_MIN_USER_CHARS,
                     max_tokens: int = K.DEFAULT_MAX_TOKENS, max_files: int = MAX_FILES, keep_days: int | None = None,
                     buckets: int = BUCKETS, today: str | None = None) -> int:
    """One export run like ``incremental.incremental``, with the signatures
    seen before in a bucketed table below ``checkpoint``.  With ``keep_days``
    a signature is forgotten that many days after the run that kept it
    (``today``, a date, stands for the current one).

    Every micro-batch writes its own folder ``out/batch=N``; a batch that is
    repeated after a crash replaces it.  Returns the rows in the folders that
    no earlier run has reported, so a crash loses no count."""
    day = today or spark.sql("SELECT CAST(current_date() AS STRING)").first()[0]
    seen = SeenTable(spark, f"{checkpoint}/seen", buckets, keep_days)

    def export(df: DataFrame, batch: int) -> None:
        ok = df.where(passes_qc(df, min_user_chars)).select("path", "messages", T.qc_signature("messages").alias("sig"))
        rows = materialize(ok.withColumn("_id", F.monotonically_increasing_id()), "export")
        first = rows.groupBy("sig").agg(F.min(F.struct("path", "_id")).alias("_first")).select("sig", F.col("_first._id").alias("_id"))
        new = materialize(seen.fresh(first, batch, day), "fresh")
        kept = rows.join(new.select("_id"), "_id").where(T.token_estimate("messages") <= F.lit(max_tokens))
        kept.select(F.to_json(F.struct("messages"), {"ignoreNullFields": "false"}).alias("value")) \
            .write.mode("overwrite").text(f"{out}/batch={batch}")
        seen.add(new, batch, day)

    _stream_batches(read_chat_stream(spark, src, max_files), checkpoint, export)
    seen.expire(day)
    return _report(spark, out, checkpoint)


def _report(spark: SparkSession, out: str, checkpoint: str) -> int:
    """Rows of the batches after the last reported one, which is kept in the
    checkpoint."""
    fs, root = hadoop(spark, out)
    if not fs.exists(root):
        return 0
    done, mark = -1, f"{checkpoint}/reported"
    if exists(spark, mark):
        done = json.loads(spark.read.text(mark).first()[0])["batch"]
    batches = sorted(int(s.getPath().getName()[6:]) for s in fs.listStatus(root) if s.getPath().getName().startswith("batch="))
    new = [b for b in batches if b > done]
    if not new:
        return 0
    n = spark.read.text([f"{out}/batch={b}" for b in new]).count()
    spark.createDataFrame([(json.dumps({"batch": new[-1]}),)], "value string").coalesce(1).write.mode("overwrite").text(mark)
    return n
