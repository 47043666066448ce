"""Clustered ticks: the same reports, without an exchange of ticks."""

import datetime as dt
import random
import re
from decimal import Decimal

import pytest

from tapeworks import schema as S
from tapeworks.plans import jobs
from tapeworks.plans import reports as R
from tapeworks.sources import layout as L
from tapeworks.sources import parquet as P
from tapeworks.sources import publish as U

D5 = dt.date(2020, 8, 5)


def _staged(spark, n=500, seed=3, hot=0.5):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        day = D5 + dt.timedelta(days=rnd.randrange(3))
        at = dt.datetime(day.year, day.month, day.day, 9, 30) + dt.timedelta(minutes=rnd.randrange(-200, 800))
        px = None if rnd.random() < .1 else Decimal(rnd.randrange(1000, 9000)) / 100
        kind = rnd.choice("TQQB")
        trade = kind == "T"
        rows.append((day, kind, "A" if rnd.random() < hot else rnd.choice("BCD"), rnd.choice(["N", "Q"]), at, i % 50,
                     at + dt.timedelta(hours=rnd.randrange(3)), px if trade else None, None if trade else px, 1,
                     None if trade else px, 1, kind, "x" if kind == "B" else None))
    return spark.createDataFrame(rows + rows[::9], S.COMMON_SCHEMA)


@pytest.fixture
def both(spark, tmp_path):
    staged = _staged(spark)
    L.write_clustered(staged, str(tmp_path / "c"), buckets=4, slot="1 hour")
    return staged, L.read_clustered(spark, str(tmp_path / "c"))


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("day", [None, D5, D5 + dt.timedelta(days=2)])
def test_reports_are_the_same(both, day):
    staged, ticks = both
    assert _rows(R.eod_trades(ticks, day)) == _rows(R.eod_trades(staged, day))
    assert _rows(R.eod_quotes(ticks, day, tie_break=["bid_pr"])) == _rows(R.eod_quotes(staged, day, tie_break=["bid_pr"]))
    for kw in ({}, {"latest_only": True}, {"keep_untraded": True}, {"with_movement": True}, {"lookback_days": 1}):
        if day or "lookback_days" not in kw:
            got, want = (R.quote_analytics(x, day, **kw) for x in (ticks, staged))
            assert got.columns == want.columns and _rows(got) == _rows(want), kw


def _final(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[:plan.rindex("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan


def _above(plan):
    """For each scan of the plan: the operators between it and the plan's top."""
    stack, out = [], []
    for line in plan.split("\n"):
        m = re.match(r"^([ :+\-]*)(.*)$", line)
        depth, name = len(m.group(1)), m.group(2)
        stack = [(d, n) for d, n in stack if d < depth] + [(depth, name)]
        if "FileScan" in name:
            out.append((name, [n for _, n in stack[:-1]]))
    return out


def test_no_exchange_below_the_windows(both):
    _, ticks = both
    for df in (R.eod_trades(ticks), R.eod_quotes(ticks)):
        assert "Exchange" not in _final(df)
    scans = _above(_final(R.quote_analytics(ticks, sort=False)))
    asof = [up for scan, up in scans if any("Window [last(__v0" in n for n in up)
            and not any("Exchange" in n for n in up)]
    assert len(asof) == 2  # trades with their copies, and quotes
    assert all("Bucketed: true" in scan for scan, up in scans if up in asof)


def test_days_and_kinds_are_pruned_by_folder(both):
    _, ticks = both
    plan = _final(R.eod_trades(ticks, D5))
    assert re.search(r"PartitionFilters: \[[^\]]*partition#", plan)
    files = ticks.kind("T").where(f"trade_dt = DATE'{D5}'").inputFiles()
    assert files and all("/partition=T/trade_dt=2020-08-05/" in f for f in files)


def test_shared_reports_scan_the_staged_table_once(spark, tmp_path, monkeypatch):
    staged = str(tmp_path / "staged")
    P.write_staged(_staged(spark), staged)
    plans = []
    monkeypatch.setattr(jobs, "write_dated", lambda df, *a, **k: plans.append(_final(df)))
    jobs.run_reports(spark, staged, "", "", "", D5 + dt.timedelta(days=1), clustered_path=str(tmp_path / "c"), buckets=4)
    assert len(plans) == 3 and all(f"{staged}/" not in p for p in plans)
    assert all("Bucketed: true" in p for p in plans)


def test_ghosts_slots_and_hot_symbols(spark):
    staged = _staged(spark, hot=1.0)
    rows = L.with_slots(staged, "1 hour", "30 minutes")
    kinds = {r.partition: r["count"] for r in rows.groupBy("partition").count().collect()}
    trades = staged.where("partition = 'T'").count()
    assert kinds["T"] == trades and 0 < kinds["G"] < trades and "B" not in kinds
    near = rows.where("partition = 'G'").selectExpr("max(slot - unix_micros(cast(event_tm as timestamp))) AS m").first()
    assert 0 < near.m <= 30 * 60 * 1_000_000
    with pytest.raises(ValueError):
        L.with_slots(staged, "10 minutes", "30 minutes")


def test_new_versions_and_wide_windows(spark, tmp_path, both):
    _, ticks = both
    with pytest.raises(ValueError):
        R.quote_analytics(ticks, window="2 hours")
    root = str(tmp_path / "v")
    with pytest.raises(ValueError):
        L.read_clustered(spark, root)
    L.write_clustered(_staged(spark, 40), root, buckets=2)
    first = L.read_clustered(spark, root)
    L.write_clustered(_staged(spark, 40).limit(0), root, buckets=3)
    assert first.ticks.count() > 0 and first.buckets == 2  # a reader keeps its version
    second = L.read_clustered(spark, root)
    assert second.buckets == 3 and second.ticks.count() == 0
    assert R.eod_trades(second).count() == 0 and R.quote_analytics(second).count() == 0
    assert len(U.clean(spark, root, keep=1)) == 1
