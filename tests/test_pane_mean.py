"""Trailing means of floating values from sums of panes, against exact sums."""

import datetime as dt
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tapeworks.operators.series import _dyadic, trailing_mean

T0 = dt.datetime(2020, 8, 6, 9, 30)
SCHEMA = "id int, k string, t timestamp_ntz, x double"
WIDTH = dt.timedelta(minutes=30)


def _rows(n, seed, draw):
    rnd = random.Random(seed)
    return [(i, rnd.choice(["A", "B", None]), T0 + dt.timedelta(seconds=rnd.randrange(9000)) * rnd.choice([1, 1, 5]),
             None if rnd.random() < .1 else draw(rnd)) for i in range(n)]


def _exact(rows):
    """(mean, mean size) of each row's frame, with rational sums."""
    out = {}
    for i, k, t, _ in rows:
        v = [Fraction(x) for _, k2, t2, x in rows if k2 == k and t - WIDTH <= t2 <= t and x is not None]
        out[i] = (sum(v) / len(v), sum(map(abs, v)) / len(v)) if v else None
    return out


def _got(spark, rows, bucket):
    df = trailing_mean(spark.createDataFrame(rows, SCHEMA), "x", "t", ["k"], "30 minutes", out="m", bucket=bucket)
    assert df.columns == ["id", "k", "t", "x", "m"]
    return {r.id: r.m for r in df.collect()}


@pytest.mark.parametrize("bucket", ["1 minute", "7 minutes", "30 minutes", "2 hours", "1 second"])
@pytest.mark.parametrize("draw", [lambda r: r.uniform(1, 999), lambda r: r.gauss(0, 1) * 10 ** r.randint(-9, 9),
                                  lambda r: r.choice([1e15, -1e15]) + r.random()], ids=["plain", "sizes", "cancel"])
def test_matches_exact_sums(spark, bucket, draw):
    rows = _rows(250, 3, draw)
    got, want = _got(spark, rows, bucket), _exact(rows)
    for i in want:
        if want[i] is None:
            assert got[i] is None
        else:
            mean, size = want[i]
            assert abs(Fraction(got[i]) - mean) <= Fraction(1e-12) * abs(mean) + Fraction(1e-18) * size, i


def test_not_finite_values_touch_their_frames_only(spark):
    at = [0, 10, 50, 100, 140]
    rows = [(i, "A", T0 + dt.timedelta(minutes=m), x) for i, (m, x) in
            enumerate(zip(at, [1.0, math.inf, 3.0, math.nan, 5.0]))]
    got = _got(spark, rows, "1 minute")
    assert got[0] == 1 and got[1] == math.inf and got[2] == 3 and math.isnan(got[3]) and got[4] == 5
    huge = [(0, "A", T0, 1e300), (1, "A", T0, -1e300), (2, "A", T0, None)]
    assert set(_got(spark, huge, "1 minute").values()) == {0.0}


def test_no_rows_no_values_and_no_times(spark):
    assert _got(spark, [], "1 minute") == {}
    rows = [(0, "A", T0, None), (1, "A", None, 2.0)]
    assert _got(spark, rows, "1 minute") == {0: None, 1: None}


def test_floats_and_narrow_buckets_of_other_types(spark):
    df = spark.createDataFrame(_rows(30, 4, lambda r: float(r.randrange(9))), SCHEMA)
    f = trailing_mean(df.withColumn("x", F.col("x").cast("float")), "x", "t", ["k"], out="m", bucket="1 minute")
    d = trailing_mean(df, "x", "t", ["k"], out="m", bucket="2 hours")
    assert {r.id: r.m for r in f.collect()} == pytest.approx({r.id: r.m for r in d.collect()})
    with pytest.raises(ValueError):
        trailing_mean(df.withColumn("x", F.col("x").cast("int")), "x", "t", ["k"], bucket="1 minute")


def test_dyadic_ranges(spark):
    pairs = [(a, a + n) for a in (-9, -1, 0, 1, 6, 13) for n in range(0, 34)] + [(5, 4)]
    df = spark.createDataFrame(pairs, "l long, r long").withColumn("nodes", _dyadic(F.col("l"), F.col("r"), 6))
    for row in df.collect():
        covered = sorted(p for n in row.nodes for p in range(n.node << n.level, (n.node + 1) << n.level))
        assert covered == list(range(row.l, row.r))
        assert len(row.nodes) <= 10
