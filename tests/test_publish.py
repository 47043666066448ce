"""Atomic publishing of tables, and incremental latest versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tapeworks.operators.latest import keep_latest
from tapeworks.operators.merge import merge_latest, read_latest
from tapeworks.sources import parquet as P
from tapeworks.sources import publish as U

D5, D6 = dt.date(2020, 8, 5), dt.date(2020, 8, 6)


def _mk(spark, *rows):
    return spark.createDataFrame(list(rows), "trade_dt date, v int")


def _vals(df):
    return sorted(r.v for r in df.collect())


def _failing(df):
    return df.withColumn("v", F.when(F.col("v") < 0, F.col("v")).otherwise(F.raise_error(F.lit("lost"))).cast("int"))


def test_a_job_that_fails_midway_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "rep")
    P.write_dated(_mk(spark, (D5, 1), (D6, 2)), path)
    before = U.manifest(spark, path)
    for day in (D6, None):
        with pytest.raises(Exception, match="lost"):
            P.write_dated(_failing(_mk(spark, (D6, 3), (D6, 4))), path, day=day)
    assert U.manifest(spark, path) == before
    assert _vals(P.read_dated(spark, path)) == [1, 2] and _vals(P.read_dated(spark, path, D6)) == [2]
    P.write_dated(_mk(spark, (D6, 5)), path, day=D6)
    assert _vals(P.read_dated(spark, path)) == [1, 5]


def test_staged_table_is_replaced_at_once(spark, tmp_path):
    path = str(tmp_path / "staged")
    rows = lambda *vs: spark.createDataFrame([(p, v) for p, v in vs], "partition string, v int")
    P.write_staged(rows(("T", 1), ("Q", 2), ("B", 3)), path)
    with pytest.raises(Exception, match="lost"):
        P.write_staged(_failing(rows(("T", 7))), path)
    assert _vals(P.read_staged(spark, path)) == [1, 2, 3]
    P.write_staged(rows(("T", 4)), path)
    assert _vals(P.read_staged(spark, path)) == [4]  # overwrite: nothing of the old parts
    P.write_staged(rows(("T", 5), ("Q", 6)), path, mode="append")
    assert _vals(P.read_staged(spark, path)) == [4, 5, 6]
    assert _vals(P.read_staged(spark, path, part="T")) == [4, 5]


def test_readers_keep_their_version_and_clean_removes_old_ones(spark, tmp_path):
    path = str(tmp_path / "rep")
    P.write_dated(_mk(spark, (D5, 1)), path)
    early = P.read_dated(spark, path)
    P.write_dated(_mk(spark, (D5, 2)), path)
    assert _vals(early) == [1] and _vals(P.read_dated(spark, path)) == [2]
    P.write_dated(_mk(spark, (D5, 3)), path)
    with pytest.raises(Exception):
        P.write_dated(_failing(_mk(spark, (D5, 4))), path)
    gone = U.clean(spark, path, keep=1)
    assert len(gone) == 3  # two old versions and the failed one
    assert _vals(P.read_dated(spark, path)) == [3] and U.clean(spark, path, keep=1) == []


def test_two_writers_at_once(spark, tmp_path, monkeypatch):
    """The other writer's manifest takes the number first; ours is added to it."""
    path = str(tmp_path / "rep")
    P.write_dated(_mk(spark, (D5, 1)), path)
    add, done = U._Files.add, []

    def raced(self, name, text):
        if not done:
            done.append(1)
            monkeypatch.setattr(U._Files, "add", add)
            P.write_dated(_mk(spark, (D6, 2)), path)
            assert not add(self, name, text)
            return False
        return add(self, name, text)

    monkeypatch.setattr(U._Files, "add", raced)
    P.write_dated(_mk(spark, (D5, 3)), path)
    assert _vals(P.read_dated(spark, path)) == [2, 3]


def test_unpublished_and_plain_folders(spark, tmp_path):
    assert U.manifest(spark, str(tmp_path / "none")) is None
    assert U.read_published(spark, str(tmp_path / "none")) is None
    _mk(spark, (D5, 1)).withColumn("report_date", F.col("trade_dt")).write.partitionBy("report_date").parquet(
        str(tmp_path / "plain"))
    assert _vals(P.read_dated(spark, str(tmp_path / "plain"), D5)) == [1]
    with pytest.raises(ValueError):
        U.publish(_mk(spark, (D5, 1)), str(tmp_path / "x"), ["trade_dt"], mode="merge")


KEYS = ["trade_dt", "k"]


def _arrivals(spark, seed, n=400):
    rnd = random.Random(seed)
    rows = [(rnd.choice([D5, D6, None]), rnd.choice(["a", "b", None, "c", "d"]),
             None if rnd.random() < .05 else dt.datetime(2020, 8, 6) + dt.timedelta(minutes=rnd.randrange(50)), i % 7)
            for i in range(n)]
    return spark.createDataFrame(rows, "trade_dt date, k string, at timestamp_ntz, v int")


def _rows(df):
    return sorted(map(repr, df.select("trade_dt", "k", "at", "v").collect()))


@pytest.mark.parametrize("kw", [{}, {"tie_break": ["v"]}, {"method": "aggregate"}])
def test_batches_give_what_one_run_gives(spark, tmp_path, kw):
    root, whole = str(tmp_path / "m"), _arrivals(spark, 5)
    batch = F.pmod(F.crc32(F.concat_ws("|", F.col("at").cast("string"), F.col("v").cast("string"), "k").cast("binary")),
                   F.lit(3))
    for i in (2, 0, 1):
        merge_latest(whole.where(batch == i), root, KEYS, "at", buckets=3, **kw)
    assert _rows(read_latest(spark, root)) == _rows(keep_latest(whole, KEYS, "at", **kw))


def test_only_touched_parts_are_rewritten(spark, tmp_path):
    root = str(tmp_path / "m")
    merge_latest(_arrivals(spark, 6), root, KEYS, "at", buckets=4)
    before = U.manifest(spark, root)
    late = spark.createDataFrame([(D6, "a", dt.datetime(2021, 1, 1), 99)], "trade_dt date, k string, at timestamp_ntz, v int")
    touched = merge_latest(late, root, KEYS, "at", buckets=4)
    after = U.manifest(spark, root)
    assert len(touched) == 1 and {p for p in after if after[p] != before.get(p)} == set(touched)
    got = read_latest(spark, root, days=[D6]).where("k = 'a'").collect()
    assert [r.v for r in got] == [99]
    assert merge_latest(late.limit(0), root, KEYS, "at", buckets=4) == []
    with pytest.raises(ValueError):
        merge_latest(late, root, ["k"], "at")


def test_one_shuffle_a_batch(spark, tmp_path):
    from tapeworks.operators import merge
    seen = []
    real = merge.publish
    merge.publish = lambda df, *a, **k: (seen.append(df._jdf.queryExecution().executedPlan().toString()), real(df, *a, **k))[1]
    try:
        merge_latest(_arrivals(spark, 7), str(tmp_path / "m"), KEYS, "at")
    finally:
        merge.publish = real
    assert seen[0].count("Exchange hashpartitioning") == 1
