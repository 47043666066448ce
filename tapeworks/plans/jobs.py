"""The two jobs: ingestion (lines -> staged table) and reports (staged table
-> EOD and analytics reports), with status logging (M3, M4, S2, U1)."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schema as S
from ..operators.ingest import empty_common, parse_lines
from ..sources.calendar import prior_day_with_input
from ..sources.lines import (FORMATS, INPUT_LAYOUT, input_glob, processing_days, read_lines,
                             split_by_format)
from ..sources.layout import read_clustered, write_clustered
from ..sources.parquet import read_staged, write_dated, write_staged
from ..sources.runlog import append_status
from . import reports

log = logging.getLogger(__name__)


def stage_lines(spark: SparkSession, paths_by_format: dict[str, Sequence[str]],
                strict_json_types: bool = True, missing_ok: bool = False) -> DataFrame:
    """Parse every format's lines and union them by name (one scan per format).
    With no input at all, an empty typed table."""
    parts = []
    for fmt, paths in paths_by_format.items():
        if not paths:
            continue
        lines = read_lines(spark, paths, missing_ok=missing_ok)
        kw = {"strict_json_types": strict_json_types} if fmt == "json" else {}
        parts.append(parse_lines(lines, fmt, **kw))
    if not parts:
        return empty_common(spark)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stage_paths(spark: SparkSession, paths: Sequence[str], **kw) -> DataFrame:
    """S3: stage files whose format is known from their extension or folder;
    other paths are skipped with a warning."""
    return stage_lines(spark, split_by_format(paths), **kw)


def ingest(spark: SparkSession, input_root: str, staged_path: str, day, prior_day=None,
           layout: str = INPUT_LAYOUT, missing_prior_ok: bool = False,
           strict_json_types: bool = True, calendar: DataFrame | None = None) -> DataFrame:
    """S2: read the processing day and the prior day, both formats, parse, and
    write the staged table partitioned by T / Q / B. Returns the staged rows
    (lazy) that were written.

    ``prior_day``: a date; by default the day before; ``"session"`` the last day before with
    input, looked for back over weekends and holidays, on the open days of ``calendar``
    if one is given."""
    if prior_day == "session":
        prior_day = prior_day_with_input(spark, input_root, day, calendar, layout)
        missing_prior_ok = True  # a session may come in one format only
    d, p = processing_days(day, prior_day)
    paths = {fmt: [input_glob(input_root, fmt, d, layout)] for fmt in FORMATS}
    staged = stage_lines(spark, paths, strict_json_types)
    prior = {fmt: [input_glob(input_root, fmt, p, layout)] for fmt in FORMATS}
    staged = staged.unionByName(
        stage_lines(spark, prior, strict_json_types, missing_ok=missing_prior_ok))
    write_staged(staged, staged_path)
    return staged


def run_reports(spark: SparkSession, staged_path: str, eod_trades_path: str,
                eod_quotes_path: str, analytics_path: str, day, clustered_path: str | None = None,
                buckets: int = 64, **analytics_kw) -> None:
    """M3: both reports for one day, each replacing its day's folder.

    Without ``clustered_path`` nothing is shared: every report's scan reads its own
    partition, days and columns of the staged table. With it (M1) the staged ticks that the reports
    need are scanned and exchanged once, into clustered ticks at that path, from which
    all three reports read without a further exchange of ticks.
    """
    d, _ = processing_days(day)
    ticks = read_staged(spark, staged_path)
    if clustered_path is not None:
        lookback = analytics_kw.get("lookback_days")
        own = (F.col("partition") == S.TRADE) | (F.col("trade_dt") == F.lit(d))
        needed = reports._days_read(ticks, d, lookback).where(own)
        write_clustered(needed, clustered_path, buckets, window=analytics_kw.get("window", "30 minutes"))
        ticks = read_clustered(spark, clustered_path)
    write_dated(reports.eod_trades(ticks, d), eod_trades_path, day=d)
    write_dated(reports.eod_quotes(ticks, d), eod_quotes_path, day=d)
    write_dated(reports.quote_analytics(ticks, d, **analytics_kw), analytics_path, day=d)


def run_job(spark: SparkSession, log_path: str, name: str, day, fn: Callable[[], object]):
    """M4: run ``fn``, log ``success`` or ``failed`` for ``<name>_<day>``, and
    re-raise a failure (the job's exit status reflects it)."""
    try:
        result = fn()
    except Exception:
        try:
            append_status(spark, log_path, name, day, "failed")
        except Exception:  # the job's own error is the one to see
            log.exception("the failure of %s_%s could not be logged", name, day)
        raise
    append_status(spark, log_path, name, day, "success")
    return result
