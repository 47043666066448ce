
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tapeworks import schema as S
from tapeworks.plans import reports as R

D1, D2 = dt.date(2020, 8, 5), dt.date(2020, 8, 6)


def tm(d, h, m=0, s=0):
    return dt.datetime(d.year, d.month, d.day, h, m, s)


def row(kind, d, t, seq, px=None, arrival=None, sym="SYMA", exch="NYSE", bid=None):
    arrival = arrival or t
    if kind == "T":
        return (d, "T", sym, exch, t, seq, arrival, Decimal(px) if px is not None else None,
                None, None, None, None, "T", None)
    b = Decimal(bid)
    return (d, "Q", sym, exch, t, seq, arrival, None, b, 100, b + 1, 100, "Q", None)


@pytest.fixture
def tape(spark):
    rows = [
        row("T", D1, tm(D1, 15, 0), 1, "10.00"),
        row("T", D1, tm(D1, 15, 50), 2, "12.00"),
        row("T", D1, tm(D1, 15, 50), 2, "12.00"),              # exact duplicate trade (E14)
        row("T", D1, tm(D1, 15, 59), 3, "20.00", arrival=tm(D1, 16)),
        row("T", D1, tm(D1, 15, 59), 3, "21.00", arrival=tm(D1, 17)),  # re-delivery (E13)
        row("Q", D2, tm(D2, 9, 30), 10, bid="15.00"),          # before any D2 trade (E16)
        row("Q", D2, tm(D2, 9, 30), 10, bid="15.00"),          # exact duplicate quote (E14)
        row("T", D2, tm(D2, 10, 0), 11, "30.00"),
        row("Q", D2, tm(D2, 10, 0), 12, bid="29.00"),          # same time as trade (E15)
        row("Q", D2, tm(D2, 9, 0), 1, bid="5.00", sym="SYMB"),  # SYMB never trades (E20)
        ("2000-01-01", "INVALID", "INVALID", "INVALID", None, -1, None, None, None, None, None, None, "B", "junk"),
    ]
    rows = [r if r[12] != "B" else (dt.date(2000, 1, 1), *r[1:4], dt.datetime(2000, 1, 1), -1,
                                    dt.datetime(2000, 1, 1), *r[7:]) for r in rows]
    return spark.createDataFrame(rows, S.COMMON_SCHEMA)


def test_quote_analytics_semantics(spark, tape):
    out = [r.asDict() for r in R.quote_analytics(tape, D2).collect()]
    assert [r["event_tm"] for r in out] == [tm(D2, 9, 30), tm(D2, 10, 0)]  # duplicate quote once, SYMB dropped
    first, second = out
    # D1 close: last trade 15:59, both versions counted; (seq, arrival) order -> 21.00.
    assert first["prior_close_trade_pr"] == Decimal("21.00")
    assert first["prior_trade_pr"] == Decimal("21.00")                  # carried across days
    # 30-minute mean at the last D1 trade: 12, 12, 20, 21 (15:29..15:59) -> 16.25
    assert first["prior_mov_avg_trade_pr"] == Decimal("16.25")
    assert second["prior_trade_pr"] == Decimal("30.00")                 # inclusive
    assert second["prior_mov_avg_trade_pr"] == Decimal("30.00")
    assert second["prior_close_trade_pr"] == Decimal("21.00")


@pytest.mark.parametrize("kw", [dict(bucket=None), dict(bucket="1 second"), dict(bucket="1 minute"),
                                dict(bucket="2 hours"), dict(bucket="7 days")])
def test_quote_analytics_forms_agree(spark, tape, kw):
    base = sorted(tuple(r) for r in R.quote_analytics(tape, None).collect())
    assert sorted(tuple(r) for r in R.quote_analytics(tape, None, **kw).collect()) == base


def test_latest_only_option(spark, tape):
    out = R.quote_analytics(tape, D2, latest_only=True).collect()
    # Re-delivery no longer counts: 12, 12, 21 -> 15.00
    assert out[0].prior_mov_avg_trade_pr == Decimal("15.00")


def test_keep_untraded_option(spark, tape):
    out = {(r.symbol, r.event_tm): r for r in R.quote_analytics(tape, D2, keep_untraded=True).collect()}
    assert (("SYMB", tm(D2, 9, 0)) in out) and out[("SYMB", tm(D2, 9, 0))].prior_trade_pr is None
    assert out[("SYMA", tm(D2, 9, 30))].prior_close_trade_pr == Decimal("21.00")


def test_price_movement(spark, tape):
    r = R.price_movement(tape, D2).collect()[1]
    assert r.bid_pr_move == Decimal("29.00") - Decimal("21.00")
    assert r.ask_pr_move == Decimal("30.00") - Decimal("21.00")


def test_eod_reports(spark, tape):
    trades = R.eod_trades(tape, D1).collect()
    assert len(trades) == 4  # duplicate kept (tie), older re-delivery dropped
    assert {r.trade_pr for r in trades if r.event_seq_nb == 3} == {Decimal("21.00")}
    assert R.eod_trades(tape, D1, tie_break=["trade_pr"]).count() == 3
    quotes = R.eod_quotes(tape, D2).collect()
    assert len(quotes) == 4 and set(quotes[0].asDict()) == set(S.QUOTE_COLUMNS)


def test_quarantine_never_reaches_reports(spark, tape):  # E21
    assert R.eod_trades(tape).where("symbol = 'INVALID'").count() == 0
    assert R.quote_analytics(tape).where("symbol = 'INVALID'").count() == 0


def test_report_head_is_total_order(spark, tape):
    rep = R.quote_analytics(tape, sort=False)
    a = [tuple(r) for r in R.report_head(rep, 2).collect()]
    b = [tuple(r) for r in R.report_head(rep.repartition(4), 2).collect()]
    assert a == b and len(a) == 2


def test_bad_processing_date(spark, tape):
    with pytest.raises(ValueError):
        R.quote_analytics(tape, "2020-8-6")


def test_building_a_report_runs_no_job(spark, tape, tmp_path):
    from tapeworks.sources.parquet import read_staged, write_staged
    write_staged(tape, str(tmp_path / "staged"))
    staged = read_staged(spark, str(tmp_path / "staged"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "building plans")
    try:
        for kw in (dict(), dict(day=D2), dict(bucket="1 second"), dict(keep_untraded=True)):
            R.quote_analytics(staged, **kw)
        assert not tracker.getJobIdsForGroup("lazy")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_plan_shape(spark, tape, tmp_path):
    from tapeworks.sources.parquet import read_staged, write_staged
    write_staged(tape, str(tmp_path / "staged"))
    staged = read_staged(spark, str(tmp_path / "staged"))
    report = R.quote_analytics(staged, D2, sort=False)
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString()
    plan = plan[:plan.rindex("== Initial Plan ==")]
    assert "PartitionFilters: [isnotnull(partition" in plan
    assert "Python" not in plan
    # Trades, quotes; the rest is one row per series and bucket (asked buckets, totals
    # of buckets and of blocks, carried rows) or day.
    assert plan.count("Exchange hashpartitioning(__series") <= 6
    # Later days are never read.
    assert "LessThanOrEqual(trade_dt" in plan


def test_a_small_estimate_is_no_broadcast_hint(spark, tape):
    from tapeworks.operators.joins import join_small
    small = R.prior_close(R.trades_of(tape.repartition(2)))
    plan = join_small(R.quotes_of(tape), small, ["trade_dt", "symbol", "exchange"]
                      )._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan.lower()


def test_day_equals_that_day_of_all(spark, tape):
    for kw in (dict(), dict(keep_untraded=True), dict(lookback_days=1), dict(bucket="1 minute")):
        every = R.quote_analytics(tape, None, **{k: v for k, v in kw.items() if k != "lookback_days"})
        want = sorted(tuple(r) for r in every.where(every.trade_dt == D2).collect())
        assert sorted(tuple(r) for r in R.quote_analytics(tape, D2, **kw).collect()) == want


def test_null_keys_and_times_and_a_hot_series(spark):
    import random
    rng = random.Random(5)
    rows = []
    for i in range(600):
        kind = rng.choice("TTQ")
        r = list(row(kind, D1, tm(D1, 9 + rng.randrange(6), rng.randrange(60)), i, 10 + i % 7, bid=9))
        names = [f.name for f in S.COMMON_SCHEMA.fields]
        if rng.random() < 0.9:
            r[names.index("symbol")] = None
        rows.append(tuple(r))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in S.COMMON_SCHEMA.fields])
    df = spark.createDataFrame(rows, schema)
    outs = [sorted(map(str, R.quote_analytics(df, keep_untraded=True, bucket=b).collect()))
            for b in (None, "30 minutes", "5 minutes", "1 second")]
    assert outs[0] == outs[1] == outs[2] == outs[3]
    assert any("symbol=None" in r and "prior_trade_pr=Decimal" in r for r in outs[0])


def test_trade_without_price_all_forms(spark, tape):  # E27
    extra = spark.createDataFrame([row("T", D1, tm(D1, 16, 25), 4, None)], S.COMMON_SCHEMA)
    t2 = tape.unionByName(extra)
    forms = [dict(bucket=None), dict(bucket="1 second"), dict(bucket="1 hour")]
    outs = [sorted(map(tuple, R.quote_analytics(t2, D2, **kw).collect())) for kw in forms]
    assert outs[0] == outs[1] == outs[2]
    first = R.quote_analytics(t2, D2).collect()[0]
    assert first.prior_close_trade_pr is None            # the day's last trade has no price
    assert first.prior_trade_pr == Decimal("21.00")      # the as-of skips it
    # The mean is still taken at the price-less trade: 20, 21 in 15:55..16:25.
    assert first.prior_mov_avg_trade_pr == Decimal("20.50")


def test_input_order_does_not_matter(spark, tape):
    from pyspark.sql import functions as F
    shuffled = tape.repartition(5).orderBy(F.rand(3))
    for kw in (dict(bucket=None), dict(bucket="1 second")):
        a = sorted(map(tuple, R.quote_analytics(tape, **kw).collect()))
        b = sorted(map(tuple, R.quote_analytics(shuffled, **kw).collect()))
        assert a == b
