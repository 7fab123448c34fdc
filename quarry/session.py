"""Session helpers: a sane local session for tests and the checkpoint
directory contract for clusters."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quarry") -> SparkSession:
    """A local session for tests and benchmarks.

    AQE stays on (coalescing, skew-join splitting), the UI stays off and
    the session time zone is UTC so timestamp arithmetic is reproducible.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", os.environ.get("QUARRY_TZ", "UTC"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only when it is unset and the master is local (tests) do
    we create a scratch directory; a cluster without one is an error,
    because a machine-local folder does not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    path = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def materialize(df, label: str = "table"):
    """Write ``df`` once as Parquet into the shared checkpoint folder and read
    it back: cuts lineage, survives executor loss, nothing is kept on
    executor disks, and later readers prune its columns."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_materialized(spark: SparkSession) -> None:
    """Delete this application's own folder below the checkpoint folder; call
    it when no frame of the session is needed any more."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        fs, path = hadoop(spark, current)
        fs.delete(path, True)


def hadoop(spark: SparkSession, path: str):
    """File system and Hadoop path of ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, path)
    return fs.exists(p)
