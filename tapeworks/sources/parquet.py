"""Parquet scans and sinks for the staged table and the dated reports
(S7-S9, K1-K3)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from .publish import publish, read_published

REPORT_DATE = "report_date"


def write_staged(staged: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: staged table partitioned by ``partition`` (T / Q / B).

    No shuffle before the write: each task writes at most one file per
    partition value (three), and the ingest stays a pure map stage. The new rows
    come into force at once, when all are written; a failed job leaves the
    table as it was (:mod:`tapeworks.sources.publish`).
    """
    publish(staged, path, ["partition"], mode)


def read_staged(spark: SparkSession, path: str, part: str | None = None,
                days=None) -> DataFrame:
    """S7/S8: the staged table, or one of its partitions. The partition filter
    is a directory filter (``PartitionFilters``), the day filter is pushed to
    the Parquet reader."""
    df = _published_or_plain(spark, path)
    if part is not None:
        df = df.where(F.col("partition") == part)
    if days is not None:
        days = [days] if isinstance(days, (str, _dt.date)) else list(days)
        days = [d if isinstance(d, _dt.date) else _dt.date.fromisoformat(d) for d in days]
        df = df.where(F.col("trade_dt").isin(*days))
    return df


def write_dated(report: DataFrame, path: str, day_col: str = "trade_dt", day=None) -> None:
    """K2/K3: write a report partitioned by ``report_date`` (= ``day_col``).

    With ``day``: the report is that day's; it is replaced as a whole,
    also when the report is empty, and rows of other days are refused. Without:
    the days present in ``report`` are replaced. Other days already in ``path`` stay.
    The days come into force together when all are written, so a failed job
    loses none (:mod:`tapeworks.sources.publish`).
    """
    if day is not None:
        d = day if isinstance(day, _dt.date) else _dt.date.fromisoformat(str(day))
        own = F.col(day_col).eqNullSafe(F.lit(d))
        checked = report.where(F.when(own, True).otherwise(
            F.raise_error(F.concat(F.lit(f"a row of another day than {d}: "),
                                   F.coalesce(F.col(day_col).cast("string"), F.lit("NULL"))))))
        publish(checked, path, [REPORT_DATE], only=f"{REPORT_DATE}={d.isoformat()}")
        return
    publish(report.withColumn(REPORT_DATE, F.col(day_col)), path, [REPORT_DATE])


def _published_or_plain(spark: SparkSession, path: str) -> DataFrame:
    """What is published at ``path``; a plain folder of Parquet files (another writer's, or
    a stream's) is read as it is."""
    df = read_published(spark, path)
    return spark.read.parquet(path) if df is None else df


def read_dated(spark: SparkSession, path: str, day=None) -> DataFrame:
    """S9: a dated report root, or one day of it (partition pruning)."""
    df = _published_or_plain(spark, path)
    if day is not None:
        d = day if isinstance(day, _dt.date) else _dt.date.fromisoformat(str(day))
        df = df.where(F.col(REPORT_DATE) == F.lit(d))
    return df
