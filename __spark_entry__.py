"""
``oracle_sql`` (DuckDB side) for every registered query.

Every query reads the driver's tables (``events``, ``lineitem``, ``orders``)
whole and derives its input from them with Spark (see ``tapeworks.fixtures``).
Queries that exercise a file source or sink write to the session's shared
checkpoint folder (``spark.checkpoint.dir``) and read the result back.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tapeworks import fixtures as fx
from tapeworks import oracle
from tapeworks import schema as S
from tapeworks.operators.ingest import parse_csv, parse_json
from tapeworks.operators.latest import keep_latest
from tapeworks.operators.merge import merge_latest, read_latest
from tapeworks.operators.series import last_known, trailing_mean
from tapeworks.plans import reports as R
from tapeworks.functions.text import lenient_timestamp
from tapeworks.plans.jobs import ingest, run_job, run_reports, stage_lines, stage_paths
from tapeworks.session import scratch_path
from tapeworks.sources.calendar import prior_sessions
from tapeworks.sources.lines import line_count, read_whole_files
from tapeworks.sources.layout import read_clustered, write_clustered
from tapeworks.sources.parquet import read_dated, read_staged, write_dated, write_staged
from tapeworks.sources.runlog import latest_status, read_log
from tapeworks.streaming.ingest import stage_streams

try:  # the training-data operators are an optional subpackage
    import tapeworks.llm.queries as llm
except ImportError:  # deleted, or one of its libraries is missing
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ticks(spark, sf_dir):
    """The staged-shaped ticks."""
    return fx.ticks(_t(spark, sf_dir, "events"))


def _staged_cols(df: DataFrame) -> DataFrame:
    return df.select(*[f.name for f in S.COMMON_SCHEMA.fields])


def _valid(df: DataFrame) -> DataFrame:
    return df.where(F.col("partition") != S.BAD).drop("line")


def _bad(df: DataFrame) -> DataFrame:
    return df.where(F.col("partition") == S.BAD)


def _feed(spark, sf_dir, build, spread: bool = True, **kw) -> DataFrame:
    """Feed lines from ``events``; ``spread`` deals them over the session's
    cores like a multi-file feed (queries that first write the feed to files
    read it back as many splits anyway)."""
    n = spark.sparkContext.defaultParallelism if spread else None
    return build(_t(spark, sf_dir, "events"), partitions=n, **kw)


def _write_feed(spark, sf_dir) -> str:
    """Write CSV and JSON feed lines under <root>/<fmt>/feed_date=<day>/batch=0/."""
    root = scratch_path(spark, "feed")
    for fmt, build in (("csv", fx.csv_lines), ("json", fx.json_lines)):
        # Each task writes its lines of each day: a day is as many files as tasks.
        (_feed(spark, sf_dir, build, with_day=True)
           .withColumn("batch", F.lit(0))
           .write.partitionBy("feed_date", "batch").text(f"{root}/{fmt}"))
    return root


def q_text_line_count(spark, sf_dir):
    root = _write_feed(spark, sf_dir)
    return line_count(spark, [f"{root}/csv/*/*/*", f"{root}/json/*/*/*"])


def q_stage_multi_source(spark, sf_dir):
    root = _write_feed(spark, sf_dir)
    return _staged_cols(stage_lines(spark, {"csv": [f"{root}/csv/*/*/*"],
                                            "json": [f"{root}/json/*/*/*"]}))


def _staged_from_lines(spark, sf_dir) -> DataFrame:
    return parse_csv(_feed(spark, sf_dir, fx.csv_lines, spread=False)).unionByName(
        parse_json(_feed(spark, sf_dir, fx.json_lines, spread=False)))


def q_stage_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "staged")
    write_staged(_staged_from_lines(spark, sf_dir), path)
    parts = [read_staged(spark, path, part=p) for p in (S.TRADE, S.QUOTE, S.BAD)]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("partition").agg(F.count(F.lit(1)).alias("n_rows"),
                                      F.sum(F.col("event_seq_nb").cast("long")).alias("sum_seq"))


def q_dated_report_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "eod_trades")
    write_dated(R.eod_trades(_ticks(spark, sf_dir)), path)
    back = read_dated(spark, path)
    return back.select(*S.TRADE_COLUMNS, F.col("report_date").cast("date").alias("report_date"))


def q_trailing_mean(bucket):
    def run(spark, sf_dir):
        t = R.trades_of(_ticks(spark, sf_dir))
        out = trailing_mean(t, "trade_pr", "event_tm", S.SERIES_KEY, "30 minutes",
                            out="mov_avg_trade_pr", bucket=bucket)
        return out.withColumn("mov_avg_trade_pr", F.col("mov_avg_trade_pr").cast(S.PRICE))
    return run


def q_trailing_mean_events(bucket):
    def run(spark, sf_dir):
        ev = _t(spark, sf_dir, "events").select(
            "event_id", "event_type", "ts", F.col("value").cast(S.PRICE).alias("px"))
        out = trailing_mean(ev, "px", "ts", ["event_type"], "30 minutes", out="mean_px",
                            bucket=bucket)
        return out.withColumn("mean_px", F.col("mean_px").cast(S.PRICE))
    return run


def q_trailing_mean_double(bucket):
    """A mean of binary fractions, which no decimal holds exactly."""
    def run(spark, sf_dir):
        ev = _t(spark, sf_dir, "events").select("event_id", "event_type", "ts", (F.col("value") / 7).alias("x"))
        out = trailing_mean(ev, "x", "ts", ["event_type"], "30 minutes", out="mean_x", bucket=bucket)
        return out.select("event_id", F.round("mean_x", 6).cast("decimal(18,6)").alias("mean_x"))
    return run


def q_eod_trades_merged(spark, sf_dir):
    """Three batches of arrivals, each merged into the days and buckets it touches."""
    root, trades = scratch_path(spark, "latest"), R.trades_of(_ticks(spark, sf_dir))
    batch = F.pmod(F.crc32(F.concat_ws("|", "event_seq_nb", "arrival_tm").cast("binary")), F.lit(3))
    for i in range(3):
        merge_latest(trades.where(batch == i), root, buckets=2)
    return read_latest(spark, root).select(*S.TRADE_COLUMNS)


def q_trades_union_quotes(spark, sf_dir):
    staged = _ticks(spark, sf_dir)
    t = trailing_mean(staged.where(F.col("partition") == S.TRADE), "trade_pr", "event_tm",
                      S.SERIES_KEY, "30 minutes", out="mov_avg_trade_pr")
    q = staged.where(F.col("partition") == S.QUOTE).withColumn(
        "mov_avg_trade_pr", F.lit(None).cast(S.PRICE))
    u = t.unionByName(q).distinct()
    return u.withColumn("mov_avg_trade_pr", F.col("mov_avg_trade_pr").cast(S.PRICE))


def q_last_trade_asof(bucket, **kw):
    def run(spark, sf_dir):
        staged = _ticks(spark, sf_dir)
        return last_known(R.quotes_of(staged), R.trades_of(staged), S.SERIES_KEY, "event_tm",
                          {"prior_trade_pr": "trade_pr"}, tie=R.TIE, bucket=bucket, **kw)
    return run


def q_last_avg_asof(spark, sf_dir):
    staged = _ticks(spark, sf_dir)
    t = trailing_mean(R.trades_of(staged), "trade_pr", "event_tm", S.SERIES_KEY, "30 minutes",
                      out="mov_avg_trade_pr")
    out = last_known(R.quotes_of(staged), t, S.SERIES_KEY, "event_tm",
                     {"prior_mov_avg_trade_pr": "mov_avg_trade_pr"}, tie=R.TIE)
    return out.withColumn("prior_mov_avg_trade_pr", F.col("prior_mov_avg_trade_pr").cast(S.PRICE))


def q_last_known_events(bucket):
    def run(spark, sf_dir):
        ev = _t(spark, sf_dir, "events").withColumn("k", F.col("user_id") % 10)
        views = ev.where(F.col("event_type") == "view").select("event_id", "k", "ts")
        buys = ev.where(F.col("event_type") == "purchase").select(
            "k", "ts", "event_id", F.col("value").cast(S.PRICE).alias("px"))
        return last_known(views, buys, ["k"], "ts", {"last_purchase_px": "px"},
                          tie=["event_id"], bucket=bucket)
    return run


def q_analytics(**kw):
    def run(spark, sf_dir):
        return R.quote_analytics(_ticks(spark, sf_dir), **kw)
    return run


def q_run_log_latest(spark, sf_dir):
    return latest_status(fx.run_log(_t(spark, sf_dir, "orders")))


#: The processing day of the queries of one day, as the jobs run in production.
DAY = "2024-01-15"


def q_dated_report_day(spark, sf_dir):
    """Two runs for the day (the second replaces the first) beside another day."""
    path, ticks = scratch_path(spark, "eod_quotes"), _ticks(spark, sf_dir)
    write_dated(R.eod_quotes(ticks, "2024-01-14"), path, day="2024-01-14")
    write_dated(R.eod_trades(ticks, DAY).limit(0), path, day=DAY)
    write_dated(R.eod_quotes(ticks, DAY), path, day=DAY)
    return read_dated(spark, path, DAY).select(*S.QUOTE_COLUMNS)


def q_ingest_two_days(spark, sf_dir):
    root, path = _write_feed(spark, sf_dir), scratch_path(spark, "staged")
    ingest(spark, root, path, DAY, layout="{root}/{fmt}/feed_date={date}/*/*")
    return (read_staged(spark, path).groupBy("partition", "trade_dt")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum(F.col("event_seq_nb").cast("long")).alias("sum_seq")))


def _calendar(spark, sf_dir) -> DataFrame:
    """Weekdays with a trade are sessions."""
    days = R.trades_of(_ticks(spark, sf_dir)).select(F.col("trade_dt").alias("day")).distinct()
    return days.withColumn("is_open", F.dayofweek("day").between(2, 6))


def q_ingest_prior_session(spark, sf_dir):
    """A Monday's run: the feed of the weekend lies there, the session before is Friday's."""
    root, path = _write_feed(spark, sf_dir), scratch_path(spark, "staged")
    ingest(spark, root, path, DAY, prior_day="session", calendar=_calendar(spark, sf_dir),
           layout="{root}/{fmt}/feed_date={date}/*/*")
    return (read_staged(spark, path).groupBy("partition", "trade_dt")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum(F.col("event_seq_nb").cast("long")).alias("sum_seq")))


def q_stage_paths(spark, sf_dir):
    """Extension before folder: CSV files in a folder named json are read as CSV."""
    root = scratch_path(spark, "mixed")
    _feed(spark, sf_dir, fx.csv_lines).write.option("compression", "none").text(f"{root}/json/x.csv")
    _feed(spark, sf_dir, fx.json_lines).write.text(f"{root}/json/plain")
    staged = stage_paths(spark, [f"{root}/json/x.csv", f"{root}/json/plain/", f"{root}/notes.md"])
    return staged.groupBy("partition").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.sum(F.col("event_seq_nb").cast("long")).alias("sum_seq"))


def q_whole_files(spark, sf_dir):
    """Lines of whole files: their line ends, all files together."""
    root = _write_feed(spark, sf_dir)
    files = read_whole_files(spark, [f"{root}/csv/*/*/*", f"{root}/json/*/*/*"])
    ends = F.length("value") - F.length(F.replace(F.col("value"), F.lit("\n"), F.lit("")))
    return files.agg(F.sum(ends).cast("long").alias("n_lines"))


def _clustered(spark, sf_dir):
    """The ticks clustered in eight buckets, read back."""
    root = scratch_path(spark, "clustered")
    write_clustered(_ticks(spark, sf_dir), root, buckets=8)
    return read_clustered(spark, root)


def q_run_reports(shared: bool):
    """Both jobs of a day, their statuses logged; the reports read back. ``shared``: from
    ticks that are scanned and exchanged once."""
    return lambda spark, sf_dir: _run_reports(spark, sf_dir, shared)


def _run_reports(spark, sf_dir, shared):
    root = scratch_path(spark, "jobs")
    kw = {"clustered_path": f"{root}/clustered", "buckets": 8} if shared else {}
    log = f"{root}/log"
    run_job(spark, log, "ingestion", DAY, lambda: write_staged(_ticks(spark, sf_dir), f"{root}/staged"))
    run_job(spark, log, "reports", DAY, lambda: run_reports(
        spark, f"{root}/staged", f"{root}/trades", f"{root}/quotes", f"{root}/analytics", DAY, **kw))
    said = latest_status(read_log(spark, log)).select(F.col("job_id").alias("what"), F.lit(1).cast("long").alias("n_rows"),
                                                      F.col("status").alias("note"))
    parts = [read_dated(spark, f"{root}/{r}", DAY).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(r).alias("what"), "n_rows", F.lit(DAY).alias("note"))
             for r in ("trades", "quotes", "analytics")]
    return functools.reduce(DataFrame.unionByName, parts, said)


def q_stream_both_formats(spark, sf_dir):
    root, path = _write_feed(spark, sf_dir), scratch_path(spark, "streamed")
    stage_streams(spark, {f: f"{root}/{f}/*/*" for f in ("csv", "json")}, path,
                  scratch_path(spark, "stream-state")).awaitTermination()
    return (read_staged(spark, path).groupBy("partition")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum(F.col("event_seq_nb").cast("long")).alias("sum_seq")))


def q_null_keys(bucket):
    """As-of and trailing mean over series with NULL keys and events without a time."""
    def run(spark, sf_dir):
        ev = _t(spark, sf_dir, "events").withColumn("k", F.when(
            F.col("user_id") % 4 != 0, F.col("user_id") % 4))
        views = ev.where(F.col("event_type") == "view").select("event_id", "k", "ts")
        buys = ev.where(F.col("event_type") == "purchase").select(
            "k", F.when(F.col("event_id") % 10 != 0, F.col("ts")).alias("ts"), "event_id",
            F.col("value").cast(S.PRICE).alias("px"))
        out = last_known(views, buys, ["k"], "ts", {"last_px": "px"}, tie=["event_id"],
                         bucket=bucket, means={"last_mean": ("px", "30 minutes")})
        return out.withColumn("last_mean", F.col("last_mean").cast(S.PRICE))
    return run


def q_report_sorted_files(spark, sf_dir):
    """The sorted report written to files; its order read back from the files'
    names and the rows' places in them."""
    path = scratch_path(spark, "sorted")
    R.quote_analytics(_ticks(spark, sf_dir)).write.parquet(path)
    rows = spark.read.parquet(path).select(*R.REPORT_ORDER, F.col("_metadata.file_name").alias("file"),
                                           F.col("_metadata.row_index").alias("row"))
    # Rows of earlier files: a running sum over one row per file.
    sizes = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    return rows.join(before, "file").select((F.col("before") + F.col("row") + 1).alias("place"), *R.REPORT_ORDER)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "text_line_count": q_text_line_count,
    "stage_csv_valid": lambda s, d: _valid(parse_csv(_feed(s, d, fx.csv_lines))),
    "stage_csv_quarantine": lambda s, d: _bad(parse_csv(_feed(s, d, fx.csv_lines))),
    "stage_json_valid": lambda s, d: _valid(parse_json(_feed(s, d, fx.json_lines))),
    "stage_json_quarantine": lambda s, d: _bad(parse_json(_feed(s, d, fx.json_lines))),
    "stage_multi_source": q_stage_multi_source,
    "stage_roundtrip": q_stage_roundtrip,
    "trades_only": lambda s, d: R.trades_of(_ticks(s, d)),
    "quotes_only": lambda s, d: R.quotes_of(_ticks(s, d)),
    "quotes_extended": lambda s, d: R.quotes_of(_ticks(s, d)).withColumn(
        "mov_avg_trade_pr", F.lit(None).cast(S.PRICE)),
    "keep_latest_lineitem": lambda s, d: keep_latest(
        _t(s, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate"),
    "eod_trades": lambda s, d: R.eod_trades(_ticks(s, d)),
    "eod_quotes": lambda s, d: R.eod_quotes(_ticks(s, d)),
    "dated_report_roundtrip": q_dated_report_roundtrip,
    "trailing_mean_30m": q_trailing_mean(None),
    "trailing_mean_bucketed": q_trailing_mean("30 minutes"),
    "trailing_mean_events": q_trailing_mean_events(None),
    "trailing_mean_events_bucketed": q_trailing_mean_events("2 hours"),
    "trailing_mean_events_fine": q_trailing_mean_events("5 minutes"),
    "trailing_mean_double": q_trailing_mean_double("1 minute"),
    "eod_trades_merged": q_eod_trades_merged,
    "trades_union_quotes": q_trades_union_quotes,
    "last_trade_asof": q_last_trade_asof(None),
    "last_trade_asof_bucketed": q_last_trade_asof("1 hour"),
    "last_trade_asof_two_level": q_last_trade_asof("1 minute", block=16),
    "last_avg_asof": q_last_avg_asof,
    "last_known_events": q_last_known_events(None),
    "last_known_events_bucketed": q_last_known_events("6 hours"),
    "daily_close": lambda s, d: R.daily_close(R.trades_of(_ticks(s, d))),
    "prior_close": lambda s, d: R.prior_close(R.trades_of(_ticks(s, d))),
    "quote_analytics": q_analytics(),
    "quote_analytics_unbucketed": q_analytics(bucket=None),
    "quote_analytics_bucketed": q_analytics(bucket="1 minute"),
    "quote_analytics_ghost": q_analytics(bucket="2 hours"),
    "quote_analytics_left": q_analytics(keep_untraded=True),
    "quote_analytics_latest": q_analytics(latest_only=True),
    "analytics_all_days": lambda s, d: R.analytics_all_days(_ticks(s, d)),
    "eod_trades_tie_break": lambda s, d: R.eod_trades(_ticks(s, d), tie_break=["trade_pr"]),
    "price_movement": lambda s, d: R.price_movement(_ticks(s, d)),
    "eod_trades_day": lambda s, d: R.eod_trades(_ticks(s, d), DAY),
    "quote_analytics_day": lambda s, d: R.quote_analytics(_ticks(s, d), DAY),
    "dated_report_day": q_dated_report_day,
    "ingest_two_days": q_ingest_two_days,
    "prior_sessions": lambda s, d: prior_sessions(_calendar(s, d)),
    "ingest_prior_session": q_ingest_prior_session,
    "stage_paths": q_stage_paths,
    "whole_files": q_whole_files,
    "run_reports_day": q_run_reports(False),
    "run_reports_shared": q_run_reports(True),
    "eod_quotes_clustered": lambda s, d: R.eod_quotes(_clustered(s, d)),
    "quote_analytics_clustered": lambda s, d: R.quote_analytics(_clustered(s, d)),
    "stream_both_formats": q_stream_both_formats,
    "lenient_timestamps": lambda s, d: fx.timestamp_texts(_t(s, d, "events")).select(
        "event_id", lenient_timestamp(F.col("value")).alias("event_tm")),
    "null_keys": q_null_keys(None),
    "null_keys_bucketed": q_null_keys("1 hour"),
    "report_sorted_files": q_report_sorted_files,
    "report_head": lambda s, d: R.report_head(R.quote_analytics(_ticks(s, d), sort=False)),
    "run_log_latest": q_run_log_latest,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: quote analytics over the sf0.001 tables."""
    return R.quote_analytics(_ticks(spark, SMOKE_DIR))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **(llm.queries() if llm else {})}


def oracle_sql() -> dict[str, str]:
    sql = oracle.queries()
    return {**{k: sql[k] for k in _QUERIES if k in sql}, **(llm.oracle_sql() if llm else {})}
