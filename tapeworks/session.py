"""Session and shared scratch location."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tapeworks",
                  event_log_dir: str | None = None) -> SparkSession:
    """A local session for tests and the benchmark (cluster jobs get theirs
    from ``spark-submit``). UI off, UTC, adaptive execution on."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.driver.memory", "8g"))
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A session that names none gets a folder in its warehouse, the one other
    location that every executor reaches; never a machine-local temporary one.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        sc.setCheckpointDir(conf or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch")
        d = sc.getCheckpointDir()
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, for tables a job writes and reads
    back. It is deleted when the driver's file system closes, with the session."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path
