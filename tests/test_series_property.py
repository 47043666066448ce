"""Property tests: bucketed forms equal brute force on adversarial inputs
(times on a grid that hits bucket edges, heavy ties, NULL values)."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings, strategies as st

from tapeworks.operators.series import last_known, trailing_mean

T0 = dt.datetime(2020, 8, 6, 9, 30)
point = st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 12),
                  st.one_of(st.none(), st.integers(1, 500)))


def _rows(points):
    return [(i, k, T0 + dt.timedelta(seconds=30 * s), None if v is None else Decimal(v) / 100)
            for i, (k, s, v) in enumerate(points)]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(point, min_size=1, max_size=25), st.lists(point, min_size=1, max_size=10),
       st.sampled_from(["1 minute", "2 minutes"]))
def test_bucketed_asof_and_mean_match_brute_force(spark, events, probes, bucket):
    ev = _rows(events)
    pr = [(1000 + i, k, t, None) for i, k, t, _ in _rows(probes)]
    schema = "id int, k string, t timestamp_ntz, px decimal(10,2)"
    edf, pdf = spark.createDataFrame(ev, schema), spark.createDataFrame(pr, schema).drop("px")

    got = {r.id: r.v for r in last_known(pdf, edf, ["k"], "t", {"v": "px"}, tie=["id"],
                                         bucket=bucket).collect()}
    for pid, k, t, _ in pr:
        cands = [(t2, i2, p2) for i2, k2, t2, p2 in ev if k2 == k and t2 <= t and p2 is not None]
        assert got[pid] == (max(cands)[2] if cands else None)

    width = dt.timedelta(minutes=1)
    got_m = {r.id: r.m for r in trailing_mean(edf, "px", "t", ["k"], "1 minute", out="m",
                                              bucket="30 seconds").collect()}
    for i, k, t, _ in ev:
        vals = [p for _, k2, t2, p in ev if k2 == k and t - width <= t2 <= t and p is not None]
        want = (sum(vals) / len(vals)).quantize(Decimal("0.000001"), ROUND_HALF_UP) if vals else None
        assert got_m[i] == want
