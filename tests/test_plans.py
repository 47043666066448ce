"""Physical plan checks: what should not shuffle does not, filters reach the scan."""

import datetime as dt

from tapeworks.plans import jobs
from tapeworks.plans import reports as R
from tapeworks.sources.parquet import read_staged, write_staged

Q = "2020-08-06,2020-08-06 09:30:00,Q,SYMA,2020-08-06 10:22:28.125,7,NASDAQ,77.76,100,79.25,100"
T = "2020-08-06,2020-08-06 09:30:00,T,SYMA,2020-08-06 10:00:05.500,10,NASDAQ,78.93,300"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ingest_is_one_map_stage(spark, tmp_path):
    d = tmp_path / "csv" / "2020-08-06" / "b"
    d.mkdir(parents=True)
    (d / "a.txt").write_text(Q + "\n" + T + "\n")
    staged = jobs.stage_lines(spark, {"csv": [str(tmp_path / "csv/*/*/*")]})
    plan = _plan(staged)
    assert "Exchange" not in plan and "Python" not in plan
    assert "WholeStageCodegen" in plan or "*(" in plan


def test_report_day_filter_reaches_the_scan(spark, tmp_path):
    from tapeworks.operators.ingest import parse_csv
    lines = spark.createDataFrame([(Q,), (T,)], "value string")
    write_staged(parse_csv(lines), str(tmp_path / "staged"))
    staged = read_staged(spark, str(tmp_path / "staged"))
    plan = _plan(R.quote_analytics(staged, dt.date(2020, 8, 6), bucket=None))
    assert "PushedFilters: [IsNotNull(trade_dt), EqualTo(trade_dt,2020-08-06)" in plan
    assert "PartitionFilters: [isnotnull(partition" in plan
    # The quarantine text never enters the report.
    assert "line:" not in plan.split("ReadSchema:")[1].split("\n")[0]
    eod = _plan(R.eod_trades(staged, "2020-08-06"))
    assert "(partition#" in eod and "= T)" in eod


def test_eod_scan_reads_only_report_columns(spark, tmp_path):
    from tapeworks.operators.ingest import parse_csv
    lines = spark.createDataFrame([(Q,), (T,)], "value string")
    write_staged(parse_csv(lines), str(tmp_path / "staged"))
    plan = _plan(R.eod_quotes(read_staged(spark, str(tmp_path / "staged"))))
    schemas = [l.split("ReadSchema: ")[1] for l in plan.split("\n") if "ReadSchema: " in l]
    assert schemas and all("line" not in s and "trade_pr" not in s for s in schemas)


def test_latest_version_shuffles_rows_once(spark):
    from tapeworks.operators.latest import keep_latest
    df = spark.range(10).selectExpr("id % 3 k", "id v", "id w")
    assert _plan(keep_latest(df, ["k"], "v")).count("Exchange hashpartitioning") == 1
    assert _plan(keep_latest(df, ["k"], "v", method="aggregate")).count("Exchange hashpartitioning") <= 2
