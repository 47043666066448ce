"""Series operators against brute force on small random series."""

import datetime as dt
import random
from decimal import Decimal, ROUND_HALF_UP

import pytest
from pyspark.sql import functions as F

from tapeworks.operators.latest import keep_latest
from tapeworks.operators.series import last_known, period_close, prior_period, trailing_mean

T0 = dt.datetime(2020, 8, 6, 9, 30)


def _events(n, seed, with_nulls=True, keys=("A", "B", "C")):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = rnd.choice(keys)
        # Coarse times make many equal times; some far gaps cross buckets.
        t = T0 + dt.timedelta(minutes=rnd.choice([0, 5, 10, 29, 30, 31, 45, 60, 95, 180, 1440]) * rnd.randint(0, 3)
                              + rnd.randint(0, 2) * 7)
        px = None if with_nulls and rnd.random() < 0.1 else Decimal(rnd.randint(100, 99999)) / 100
        rows.append((i, k, t, px))
    return rows


def _df(spark, rows):
    return spark.createDataFrame(rows, "id int, k string, t timestamp_ntz, px decimal(10,2)")


def _mean_brute(rows, width):
    out = {}
    for i, k, t, _ in rows:
        vals = [p for _, k2, t2, p in rows if k2 == k and t - width <= t2 <= t and p is not None]
        if not vals:
            out[i] = None
        else:
            m = (sum(vals) / len(vals)).quantize(Decimal("0.000001"), ROUND_HALF_UP)
            out[i] = m
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bucket,method", [(None, "prefix"), (None, "sliding"),
                                           ("30 minutes", "prefix"), ("2 hours", "prefix"),
                                           ("7 minutes", "prefix"), ("1 second", "prefix")])
def test_trailing_mean_matches_brute_force(spark, seed, bucket, method):
    rows = _events(300, seed)
    got = trailing_mean(_df(spark, rows), "px", "t", ["k"], "30 minutes", out="m",
                        bucket=bucket, method=method)
    got = {r.id: r.m for r in got.collect()}
    want = _mean_brute(rows, dt.timedelta(minutes=30))
    assert got == want


def test_trailing_mean_type_matches_avg(spark):
    df = trailing_mean(_df(spark, _events(10, 3)), "px", "t", ["k"])
    assert df.schema["mov_avg"].dataType.simpleString() == "decimal(14,6)"


def test_trailing_mean_narrow_bucket_needs_decimal_prefix(spark):
    with pytest.raises(ValueError):
        trailing_mean(_df(spark, _events(5, 1)), "px", "t", ["k"], "30 minutes", bucket="10 minutes",
                      method="sliding")


def _asof_brute(probes, events):
    out = {}
    for pid, k, t, _ in probes:
        cands = [(t2, i2, p2) for i2, k2, t2, p2 in events if k2 == k and t2 <= t and p2 is not None]
        out[pid] = max(cands)[2] if cands else None
    return out


@pytest.mark.parametrize("bucket", [None, "1 hour", "30 minutes", "1 day"])
def test_last_known_matches_brute_force(spark, bucket):
    events = _events(300, 5)
    probes = [(i + 1000, k, t + dt.timedelta(minutes=3 * (i % 3) - 3), None)
              for i, k, t, _ in _events(200, 6, with_nulls=False)]
    got = last_known(_df(spark, probes).drop("px"), _df(spark, events), ["k"], "t",
                     {"last_px": "px"}, tie=["id"], bucket=bucket)
    got = {r.id: r.last_px for r in got.collect()}
    assert got == _asof_brute(probes, events)


def test_last_known_is_inclusive_and_skips_nulls(spark):
    ev = _df(spark, [(1, "A", T0, Decimal("1.00")), (2, "A", T0 + dt.timedelta(minutes=1), None),
                     (3, "A", T0 + dt.timedelta(minutes=2), Decimal("3.00"))])
    pr = _df(spark, [(10, "A", T0 + dt.timedelta(minutes=1), None),
                     (11, "A", T0 + dt.timedelta(minutes=2), None),
                     (12, "A", T0 - dt.timedelta(minutes=1), None),
                     (13, "B", T0, None)]).drop("px")
    got = {r.id: r.v for r in last_known(pr, ev, ["k"], "t", {"v": "px"}, tie=["id"]).collect()}
    assert got == {10: Decimal("1.00"), 11: Decimal("3.00"), 12: None, 13: None}


def test_last_known_ties_are_deterministic(spark):
    # Same time: the larger tie column wins, whatever the input order.
    rows = [(1, "A", T0, Decimal("5.00")), (2, "A", T0, Decimal("4.00")), (3, "A", T0, Decimal("6.00"))]
    pr = _df(spark, [(9, "A", T0, None)]).drop("px")
    for perm in (rows, rows[::-1]):
        got = last_known(pr, _df(spark, perm).repartition(3), ["k"], "t", {"v": "px"}, tie=["id"])
        assert got.collect()[0].v == Decimal("6.00")


def test_period_close_keeps_null_last_price(spark):  # E27
    d = dt.date(2020, 8, 6)
    df = spark.createDataFrame(
        [("A", d, T0, 1, Decimal("1.00")), ("A", d, T0 + dt.timedelta(hours=1), 2, None),
         ("B", d, T0, 1, Decimal("2.00")), ("B", d, T0, 2, Decimal("3.00"))],
        "k string, d date, t timestamp_ntz, seq int, px decimal(10,2)")
    got = {r.k: r.close for r in period_close(df, ["k"], "d", "t", "px", tie=["seq"]).collect()}
    assert got == {"A": None, "B": Decimal("3.00")}


def test_prior_period_is_previous_present_period(spark):
    df = spark.createDataFrame([("A", dt.date(2020, 8, 3), 1), ("A", dt.date(2020, 8, 6), 2),
                                ("B", dt.date(2020, 8, 6), 3)], "k string, d date, v int")
    got = {(r.k, r.d): r.prior_v for r in prior_period(df, ["k"], "d", "v").collect()}
    assert got == {("A", dt.date(2020, 8, 3)): None, ("A", dt.date(2020, 8, 6)): 1,
                   ("B", dt.date(2020, 8, 6)): None}


def test_keep_latest_keeps_ties_and_tie_break(spark):
    rows = [(1, T0, 1.0), (1, T0, 2.0), (1, T0 - dt.timedelta(hours=1), 3.0), (2, T0, 4.0)]
    df = spark.createDataFrame(rows, "key int, arrival timestamp_ntz, v double")
    kept = sorted(r.v for r in keep_latest(df, ["key"], "arrival").collect())
    assert kept == [1.0, 2.0, 4.0]  # E12: both tied rows stay
    one = sorted(r.v for r in keep_latest(df, ["key"], "arrival", tie_break=["v"]).collect())
    assert one == [2.0, 4.0]
    again = keep_latest(keep_latest(df, ["key"], "arrival"), ["key"], "arrival")
    assert sorted(r.v for r in again.collect()) == kept  # idempotent


def test_keep_latest_ignores_partitioning(spark):
    rows = [(i % 7, T0 + dt.timedelta(minutes=i % 5), float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "key int, arrival timestamp_ntz, v double")
    a = sorted(tuple(r) for r in keep_latest(df, ["key"], "arrival").collect())
    b = sorted(tuple(r) for r in keep_latest(df.repartition(5).orderBy(F.rand(1)), ["key"], "arrival").collect())
    assert a == b


@pytest.mark.parametrize("tie_break", [None, ["v"]])
def test_keep_latest_methods_agree(spark, tie_break):
    import random
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 5) if rnd.random() > 0.05 else None, T0 + dt.timedelta(minutes=rnd.randint(0, 3)),
             float(rnd.randint(0, 4))) for _ in range(400)]
    # One hot key holding a third of the rows.
    rows += [(99, T0 + dt.timedelta(minutes=rnd.randint(0, 3)), float(rnd.randint(0, 4))) for _ in range(200)]
    df = spark.createDataFrame(rows, "key int, arrival timestamp_ntz, v double")
    a = sorted(map(tuple, keep_latest(df, ["key"], "arrival", tie_break, method="window").collect()), key=str)
    b = sorted(map(tuple, keep_latest(df, ["key"], "arrival", tie_break, method="aggregate").collect()), key=str)
    assert a == b


def test_last_known_means_equals_mean_then_lookup(spark):
    events = _events(300, 11)
    probes = [(i + 1000, k, t + dt.timedelta(minutes=1), None) for i, k, t, _ in _events(150, 12)]
    ev, pr = _df(spark, events), _df(spark, probes).drop("px")
    fused = last_known(pr, ev, ["k"], "t", {"last_px": "px"}, tie=["id"],
                       means={"last_mean": ("px", "30 minutes")})
    with_mean = trailing_mean(ev, "px", "t", ["k"], "30 minutes", out="m")
    twostep = last_known(pr, with_mean, ["k"], "t", {"last_px": "px", "last_mean": "m"}, tie=["id"])
    key = lambda r: (r.id, r.last_px, r.last_mean)
    assert sorted(map(key, fused.collect())) == sorted(map(key, twostep.collect()))


@pytest.mark.parametrize("bucket", [None, "30 minutes", "2 hours"])
def test_looked_up_mean_equals_mean_then_lookup(spark, bucket):
    rows = _events(250, 11, keys=("A", None, "C"))
    ev = _df(spark, rows).withColumn("t", F.when(F.col("id") % 17 != 0, F.col("t")))
    pr = _df(spark, _events(80, 12, keys=("A", None, "D"))).select("id", "k", "t")
    got = last_known(pr, ev, ["k"], "t", {"px_": "px"}, tie=["id"], bucket=bucket,
                     means={"m": ("px", "30 minutes")})
    timed = [r for r in rows if r[0] % 17]
    mean = _mean_brute(timed, dt.timedelta(minutes=30))
    for r in got.collect():
        before = sorted((t, i, p) for i, k, t, p in timed if k == r.k and t <= r.t)
        want = next((p for _, _, p in reversed(before) if p is not None), None)
        at = next((mean[i] for _, i, _ in reversed(before) if mean[i] is not None), None)
        assert (r.px_, r.m) == (want, at)


@pytest.mark.parametrize("bucket", ["5 minutes", "30 minutes", "3 hours"])
def test_null_keys_are_a_series_in_every_form(spark, bucket):
    rows = _events(200, 21, keys=("A", None))
    df = _df(spark, rows)
    plain = {r.id: r.m for r in trailing_mean(df, "px", "t", ["k"], out="m").collect()}
    assert plain == {r.id: r.m for r in trailing_mean(df, "px", "t", ["k"], out="m", bucket=bucket).collect()}
    probes = df.select("id", "k", "t")
    a, b = (sorted((r.id, r.v) for r in last_known(probes, df, ["k"], "t", {"v": "px"}, tie=["id"],
                                                   bucket=x).collect()) for x in (None, bucket))
    assert a == b
