"""The session before a day, by calendar and by input folders."""

import datetime as dt
import os

import pytest

from tapeworks.plans import jobs
from tapeworks.sources import calendar as C
from tapeworks.sources import parquet as P

MON, FRI, THU = dt.date(2020, 8, 10), dt.date(2020, 8, 7), dt.date(2020, 8, 6)
T = "{d},{d} 09:30:00,T,SYMA,{d} 15:42:05.500,10,NASDAQ,78.93,300\n"


def _feed(tmp_path, *days, fmt="csv"):
    for d in days:
        folder = tmp_path / "in" / fmt / str(d) / "b"
        os.makedirs(folder, exist_ok=True)
        (folder / "a.txt").write_text(T.format(d=d))
    return str(tmp_path / "in")


def test_prior_sessions(spark):
    cal = C.weekdays(spark, "2020-08-05", "2020-08-12", closed=["2020-08-07"])
    got = {str(r.day): str(r.prior_day) for r in C.prior_sessions(cal).collect()}
    assert got == {"2020-08-05": "None", "2020-08-06": "2020-08-05", "2020-08-07": "2020-08-06",
                   "2020-08-08": "2020-08-06", "2020-08-09": "2020-08-06", "2020-08-10": "2020-08-06",
                   "2020-08-11": "2020-08-10", "2020-08-12": "2020-08-11"}
    assert C.prior_session(cal, "2020-08-10") == THU
    assert C.prior_session(cal, "2021-01-01") == dt.date(2020, 8, 12)
    assert C.prior_session(cal, "2020-08-05") is None


def test_exchanges_repeats_and_nulls(spark):
    rows = [("A", FRI, True), ("A", MON, True), ("B", THU, True), ("B", FRI, False), ("B", MON, None),
            ("B", MON, True), ("B", None, True), (None, MON, True)]
    cal = spark.createDataFrame(rows, "x string, day date, is_open boolean")
    got = {(r.x, r.day): r.prior_day for r in C.prior_sessions(cal, ["x"]).collect()}
    assert got == {("A", FRI): None, ("A", MON): FRI, ("B", THU): None, ("B", FRI): THU, ("B", MON): THU,
                   (None, MON): None}
    assert C.prior_sessions(cal.limit(0)).count() == 0


def test_search_over_input(spark, tmp_path):
    root = _feed(tmp_path, THU, FRI, dt.date(2020, 8, 9), MON)
    assert C.prior_day_with_input(spark, root, MON) == dt.date(2020, 8, 9)
    cal = C.weekdays(spark, "2020-08-01", "2020-08-31")
    assert C.prior_day_with_input(spark, root, MON, cal) == FRI  # Sunday's folder is no session
    holiday = C.weekdays(spark, "2020-08-01", "2020-08-31", closed=[FRI])
    assert C.prior_day_with_input(spark, root, MON, holiday) == THU
    with pytest.raises(FileNotFoundError):
        C.prior_day_with_input(spark, root, THU, cal)
    with pytest.raises(FileNotFoundError):
        C.prior_day_with_input(spark, root, "2020-09-30", cal, back=3)


def test_monday_run_reads_friday(spark, tmp_path):
    root, out = _feed(tmp_path, FRI, MON), str(tmp_path / "staged")
    jobs.ingest(spark, root, out, MON, prior_day="session", calendar=C.weekdays(spark, "2020-08-01", "2020-08-31"),
                layout="{root}/csv/{date}/*/*")
    days = {r.trade_dt for r in P.read_staged(spark, out, part="T").select("trade_dt").collect()}
    assert days == {FRI, MON}
