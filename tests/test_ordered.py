"""Globally ordered output, and the as-of's carry, by plan and by brute force."""

import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tapeworks.operators import series
from tapeworks.operators.ordered import range_ordered
from tapeworks.operators.series import last_known

T0 = dt.datetime(2020, 8, 6, 9, 30)
SCHEMA = "id int, k string, x string, t timestamp_ntz, px decimal(10,2)"


def _rows(n, seed, keys=("A", "B", None), hot=0.0, minutes=2000):
    rnd = random.Random(seed)
    return [(i, "A" if rnd.random() < hot else rnd.choice(keys), rnd.choice(["N", "Q"]),
             T0 + dt.timedelta(minutes=rnd.randrange(minutes)), None if rnd.random() < .2 else Decimal(rnd.randrange(999)))
            for i in range(n)]


def _parts(df):
    """Key tuples of each partition, in the partitions' order."""
    rows = df.withColumn("__p", F.spark_partition_id()).collect()
    out = {}
    for r in rows:
        out.setdefault(r["__p"], []).append(tuple((v is not None, v) for v in (r.k, r.x, r.t)))
    return [out[p] for p in sorted(out)]


@pytest.mark.parametrize("partitions", [1, 2, 3, 8, 13])
@pytest.mark.parametrize("hot", [0.0, 0.9])
def test_order_over_partitions(spark, partitions, hot):
    df = spark.createDataFrame(_rows(700, 4, hot=hot), SCHEMA).repartition(5)
    got = _parts(range_ordered(df, ["k", "x", "t"], tell_apart=["id"], partitions=partitions))
    flat = [key for part in got for key in part]
    assert len(flat) == 700 and flat == sorted(flat)
    if partitions == 8:  # a hot series is cut by time
        assert len(got) == 8 and max(map(len, got)) < 700 / 8 * 2.5


def test_order_with_a_sketch_of_other_rows(spark):
    """The sketch decides how even the parts are, never what they hold."""
    df = spark.createDataFrame(_rows(300, 5), SCHEMA)
    for sketched in (df.limit(0), df.limit(3), df.where("k = 'A'")):
        flat = [key for part in _parts(range_ordered(df, ["k", "x", "t"], sketched, partitions=4)) for key in part]
        assert len(flat) == 300 and flat == sorted(flat)


def test_empty_and_equal_rows(spark):
    df = spark.createDataFrame(_rows(40, 6), SCHEMA)
    assert range_ordered(df.limit(0), ["k", "t"], partitions=4).count() == 0
    same = df.withColumn("k", F.lit("A"))
    assert range_ordered(same, ["k"], partitions=4).count() == 40


def _executed(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("== Final Plan =="):plan.rindex("== Initial Plan ==")]


def test_sorting_evaluates_nothing_twice(spark, tmp_path):
    spark.createDataFrame(_rows(300, 7), SCHEMA).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    work = df.groupBy("k", "x", "t").agg(F.sum("px").alias("px"))
    plan = _executed(range_ordered(work, ["k", "x", "t"], sketched=df, partitions=4))
    assert "rangepartitioning" not in plan
    assert plan.count("partial_sum(px") == 1


def _last_brute(probes, events):
    out = {}
    for i, k, x, t, _ in probes:
        seen = [(te, ie, p) for ie, ke, xe, te, p in events if (ke, xe) == (k, x) and te <= t and p is not None]
        out[i] = max(seen)[2] if seen else None
    return out


@pytest.mark.parametrize("bucket,block", [("1 minute", 2), ("1 minute", 16), ("7 minutes", 3), ("1 hour", 1024)])
def test_carry_over_blocks_matches_brute_force(spark, bucket, block):
    events, probes = _rows(150, 8), _rows(150, 9)
    ev, pr = (spark.createDataFrame(r, SCHEMA) for r in (events, probes))
    got = last_known(pr, ev.withColumnRenamed("id", "seq"), ["k", "x"], "t", {"last": "px"}, tie=["seq"],
                     bucket=bucket, block=block)
    got = {r.id: None if r["last"] is None else int(r["last"]) for r in got.collect()}
    assert got == _last_brute(probes, events)


def test_events_are_scanned_and_shuffled_once(spark, tmp_path):
    for name, seed in (("e", 10), ("p", 11)):
        spark.createDataFrame(_rows(200, seed), SCHEMA).write.parquet(str(tmp_path / name))
    ev = spark.read.parquet(str(tmp_path / "e")).withColumnRenamed("id", "seq")
    pr = spark.read.parquet(str(tmp_path / "p"))
    df = last_known(pr, ev, ["k", "x"], "t", {"last": "px"}, tie=["seq"], bucket="1 hour",
                    means={"mean": ("px", "30 minutes")})
    plan = _executed(df)
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert sum("/e]" in line for line in scans) == 1
    # Events, probes and carried rows meet without a further shuffle.
    top = plan[:plan.index("Union")]
    assert "Exchange" not in top


def test_a_long_series_spreads(spark):
    """10^6 buckets of one series: no task sees more than a block or the blocks."""
    n = 1_000_000
    rows = spark.range(n).selectExpr("struct(concat('A', id % 1) AS k) AS __series", "id AS __at", "id % 3 = 0 AS __asked",
                                     "if(id % 1000 = 1, id, null) AS v")
    out = series._prefix_last(rows, ["v"], 1024)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(__series#\d+, __block2#", plan)
    wrong = out.where("v IS DISTINCT FROM if(__at <= 1, null, ((__at - 2) DIV 1000) * 1000 + 1)")
    assert out.count() == (n + 2) // 3 and wrong.count() == 0
