"""Sources, sinks, run log and jobs (S1-S9, K1-K5, M3, M4)."""

import datetime as dt
import os

import pytest

from tapeworks.plans import jobs
from tapeworks.sources import lines as L
from tapeworks.sources import parquet as P
from tapeworks.sources import runlog

Q = "2020-08-06,2020-08-06 09:30:00,Q,SYMA,2020-08-06 10:22:28.125,7,NASDAQ,77.76,100,79.25,100"
T = "2020-08-05,2020-08-05 09:30:00,T,SYMA,2020-08-05 15:42:05.500,10,NASDAQ,78.93,300"
JT = ('{"trade_dt":"2020-08-06","file_tm":"2020-08-06 09:30:00","event_type":"T","symbol":"SYMA",'
      '"event_tm":"2020-08-06 10:00:00","event_seq_nb":30,"exchange":"NASDAQ","price":80.15,"size":100}')


def _put(root, fmt, day, name, text):
    d = os.path.join(root, fmt, day, "batch1")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


@pytest.fixture
def feed(tmp_path):
    root = str(tmp_path / "in")
    _put(root, "csv", "2020-08-06", "a.txt", Q + "\n\n")
    _put(root, "csv", "2020-08-05", "a.txt", T + "\nbad\n")
    _put(root, "json", "2020-08-06", "a.txt", JT + "\n")
    _put(root, "json", "2020-08-05", "a.txt", "{}\n")
    return root


def test_input_rule_and_days():
    assert L.input_glob("/in/", "csv", dt.date(2020, 8, 6)) == "/in/csv/2020-08-06/*/*"
    assert L.processing_days("2020-08-06") == [dt.date(2020, 8, 6), dt.date(2020, 8, 5)]
    assert L.processing_days("2020-08-10", "2020-08-07")[1] == dt.date(2020, 8, 7)
    with pytest.raises(ValueError):
        L.processing_days("2020-8-6")


def test_ingest_two_days_two_formats(spark, feed, tmp_path):
    out = str(tmp_path / "staged")
    jobs.ingest(spark, feed, out, "2020-08-06")
    staged = P.read_staged(spark, out)
    got = {r.partition: r["count"] for r in staged.groupBy("partition").count().collect()}
    assert got == {"Q": 1, "T": 2, "B": 3}  # blank line, 'bad', '{}'
    assert staged.count() == 6  # every line accounted for
    t = P.read_staged(spark, out, part="T")
    assert "PartitionFilters: [isnotnull(partition" in t._jdf.queryExecution().executedPlan().toString()
    assert t.count() == 2
    one_day = P.read_staged(spark, out, days="2020-08-05")
    assert one_day.where("partition != 'B'").count() == 1


def test_missing_prior_day(spark, feed, tmp_path):
    with pytest.raises(Exception):
        jobs.ingest(spark, feed, str(tmp_path / "s1"), "2020-08-04").count()
    df = jobs.stage_lines(spark, {"csv": [L.input_glob(feed, "csv", dt.date(2020, 8, 2))]}, missing_ok=True)
    assert df.count() == 0 and len(df.columns) == 14


def test_line_count_whole_files_and_format_split(spark, feed):
    assert L.line_count(spark, [f"{feed}/csv/*/*/*"]).collect()[0].n_lines == 4
    whole = L.read_whole_files(spark, f"{feed}/csv/*/*/*").collect()
    assert len(whole) == 2 and any(Q in r.value for r in whole)
    split = L.split_by_format(["/a/csv/x.txt", "/a/b.json", "/a/c.parquet"])
    assert split == {"csv": ["/a/csv/x.txt"], "json": ["/a/b.json"]}


def test_dated_sink_overwrites_only_its_days(spark, tmp_path):
    path = str(tmp_path / "rep")
    mk = lambda d, v: spark.createDataFrame([(d, v)], "trade_dt date, v int")
    P.write_dated(mk(dt.date(2020, 8, 5), 1), path)
    P.write_dated(mk(dt.date(2020, 8, 6), 2), path)
    P.write_dated(mk(dt.date(2020, 8, 6), 3), path)
    got = sorted((str(r.report_date), r.v) for r in P.read_dated(spark, path).collect())
    assert got == [("2020-08-05", 1), ("2020-08-06", 3)]
    assert P.read_dated(spark, path, "2020-08-05").collect()[0].v == 1


def test_run_log_and_job_wrapper(spark, tmp_path):
    log = str(tmp_path / "log")
    runlog.append_status(spark, log, "reports", "2020-08-06", "failed", dt.datetime(2020, 8, 6, 1))
    runlog.append_status(spark, log, "reports", "2020-08-06", "success", dt.datetime(2020, 8, 6, 2))
    assert jobs.run_job(spark, log, "ingestion", "2020-08-06", lambda: 42) == 42
    with pytest.raises(RuntimeError):
        jobs.run_job(spark, log, "ingestion", "2020-08-07", lambda: (_ for _ in ()).throw(RuntimeError("x")))
    latest = {r.job_id: r.status for r in runlog.latest_status(runlog.read_log(spark, log)).collect()}
    assert latest == {"reports_2020-08-06": "success", "ingestion_2020-08-06": "success",
                      "ingestion_2020-08-07": "failed"}
    only = runlog.latest_status(runlog.read_log(spark, log), "reports_2020-08-06").collect()
    assert len(only) == 1 and only[0].update_time == dt.datetime(2020, 8, 6, 2)


def test_run_reports_end_to_end(spark, feed, tmp_path):
    staged = str(tmp_path / "staged")
    jobs.ingest(spark, feed, staged, "2020-08-06")
    paths = [str(tmp_path / n) for n in ("eod_t", "eod_q", "qa")]
    jobs.run_reports(spark, staged, *paths, "2020-08-06")
    assert P.read_dated(spark, paths[0]).count() == 1
    assert P.read_dated(spark, paths[1]).count() == 1
    qa = P.read_dated(spark, paths[2]).collect()
    assert len(qa) == 1 and float(qa[0].prior_trade_pr) == 80.15
    assert float(qa[0].prior_close_trade_pr) == 78.93


def test_stage_paths_by_extension(spark, tmp_path):
    (tmp_path / "a.csv").write_text(Q + "\n")
    (tmp_path / "b.json").write_text(JT + "\n")
    (tmp_path / "c.parquet").write_text("not read\n")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.json", "c.parquet")]
    got = sorted(r.partition for r in jobs.stage_paths(spark, paths).collect())
    assert got == ["Q", "T"]


def test_an_empty_rerun_replaces_its_day(spark, tmp_path):
    from tapeworks.sources.parquet import read_dated, write_dated
    path = str(tmp_path / "report")
    df = spark.createDataFrame([("2020-08-06", 1), ("2020-08-07", 2)], "d string, v int").selectExpr(
        "cast(d as date) trade_dt", "v")
    write_dated(df, path)
    write_dated(df.limit(0), path, day="2020-08-07")
    assert [r.v for r in read_dated(spark, path).collect()] == [1]
    write_dated(df.where("v = 2"), path, day="2020-08-07")
    assert sorted(r.v for r in read_dated(spark, path).collect()) == [1, 2]
    with pytest.raises(Exception, match="another day"):
        write_dated(df, path, day="2020-08-07")


def test_extension_before_folder():
    from tapeworks.sources.lines import split_by_format
    assert split_by_format(["/feeds/csv/x.json", "/feeds/csv/y", "/feeds/z.CSV"]) == {
        "csv": ["/feeds/csv/y", "/feeds/z.CSV"], "json": ["/feeds/csv/x.json"]}
