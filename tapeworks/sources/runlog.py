"""Job status log as an append-only Parquet table (K4, K5)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schema as S


def job_id(name: str, day) -> str:
    """``<job name>_<processing day>``."""
    return f"{name}_{day}"


def append_status(spark: SparkSession, path: str, name: str, day, status: str,
                  when: _dt.datetime | None = None) -> None:
    """K4: append one (job_id, update_time, status) row; times are UTC, whatever
    the driver's zone."""
    when = when or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = [(job_id(name, day), when, status)]
    spark.createDataFrame(row, S.RUN_LOG_SCHEMA).write.mode("append").parquet(path)


def latest_status(log: DataFrame, job: str | None = None) -> DataFrame:
    """K5: the latest row (by ``update_time``) of each job id, or of ``job``.

    The source returned an arbitrary row when a job ran more than once; this
    returns the most recent one.
    """
    if job is not None:
        log = log.where(F.col("job_id") == job)
    latest = F.max(F.struct("update_time", "status"))
    return (log.groupBy("job_id").agg(latest.alias("__last"))
               .select("job_id", "__last.update_time", "__last.status"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.RUN_LOG_SCHEMA).parquet(path)
