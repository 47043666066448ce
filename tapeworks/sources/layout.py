"""The staged ticks clustered for the reports (S7, S8, K1; M1's shared data).

Trades and quotes are written once more, bucketed by (symbol, exchange, time slot), sorted
inside the buckets, in folders by kind and day. A report that groups or windows by these
columns (or more) then needs no exchange of ticks: the one made here serves all of them. The
copies of trades that a trailing window of ``window`` looks back at from the next slot are
stored as their own kind. A slot of a symbol is a task's unit of work, so a hot symbol
spreads over as many buckets as it has slots.

The table is published like any other (:mod:`.publish`). A reader registers the version in
force as an external table, as buckets are known to Spark by a table's definition only.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schema as S
from ..functions.time import epoch_micros, interval_micros, time_bucket
from .publish import DATA, _Files, commit, manifest

SLOT = "slot"
#: Kind of the copied trades beside ``T`` and ``Q``.
GHOST = "G"
BUCKET_COLUMNS = (*S.SERIES_KEY, SLOT)
_LAYOUT = "_layout.json"


@dataclass(frozen=True)
class Clustered:
    """The clustered ticks and how they are laid out (micros)."""

    ticks: DataFrame
    buckets: int
    slot: int
    window: int

    def kind(self, *kinds: str) -> DataFrame:
        """Ticks of some kinds, pruned by folder."""
        return self.ticks.where(F.col("partition").isin(*kinds))


def with_slots(staged: DataFrame, slot, window) -> DataFrame:
    """Trades, quotes and copied trades with their slots (start in epoch micros)."""
    slot_us, window_us = interval_micros(slot), interval_micros(window)
    if slot_us < window_us:
        raise ValueError("a slot narrower than the window")
    cols = [f.name for f in S.DATA_FIELDS]
    at = epoch_micros(staged, "event_tm")
    ticks = (staged.where(F.col("partition").isin(S.TRADE, S.QUOTE))
             .select(*cols, "partition", time_bucket(at, slot_us).alias(SLOT), at.alias("__at")))
    # One pass: a trade near its slot's end is emitted again for the next slot.
    near_end = (F.col("partition") == S.TRADE) & (F.col("__at") >= F.col(SLOT) + F.lit(slot_us - window_us))
    kinds = F.when(near_end, F.array(F.col("partition"), F.lit(GHOST))).otherwise(F.array(F.col("partition")))
    spread = ticks.withColumn("__kind", F.explode(kinds))
    return spread.select(*cols, F.col("__kind").alias("partition"), (
        F.col(SLOT) + F.when(F.col("__kind") == GHOST, F.lit(slot_us)).otherwise(F.lit(0))).alias(SLOT))


def write_clustered(staged: DataFrame, root: str, buckets: int = 64, slot="2 hours", window="30 minutes") -> None:
    """Cluster ``staged`` and put it in force at ``root`` in place of what was there.

    One scan of ``staged`` and one exchange by the bucket columns, so that a task holds one
    bucket and writes one file for each kind and day of it. ``buckets`` is the number of
    tasks that later read the table; a bucket should be a task's worth of ticks.
    """
    spark, version = staged.sparkSession, uuid.uuid4().hex
    files = _Files(spark, root)
    folder = f"{DATA}/version={version}"
    name = f"write_{version}"
    ticks = with_slots(staged, slot, window).repartition(buckets, *BUCKET_COLUMNS)
    try:
        (ticks.write.partitionBy("partition", "trade_dt").bucketBy(buckets, *BUCKET_COLUMNS)
         .sortBy(*S.SERIES_KEY, "event_tm").format("parquet").option("path", f"{files.root}/{folder}").saveAsTable(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: its files stay
    schema = ticks.drop("partition", "trade_dt").schema.simpleString()[len("struct<"):-1]
    files.add(f"{folder}/{_LAYOUT}", json.dumps({
        "buckets": buckets, "slot": interval_micros(slot), "window": interval_micros(window), "schema": schema}))
    commit(spark, root, {"": [version]}, "overwrite")


def read_clustered(spark: SparkSession, root: str) -> Clustered:
    """The version in force, registered in the session's catalog."""
    known = manifest(spark, root)
    if not known:
        raise ValueError(f"nothing is published at {root}")
    version, files = known[""][0], _Files(spark, root)
    folder = f"{DATA}/version={version}"
    layout = json.loads(files.read(f"{folder}/{_LAYOUT}"))
    name = f"clustered_{version}"
    columns = ", ".join(f"`{c}` {t}" for c, t in (f.split(":", 1) for f in _fields(layout["schema"])))
    if spark.catalog.tableExists(name):
        return Clustered(spark.table(name), layout["buckets"], layout["slot"], layout["window"])
    spark.sql(f"CREATE TABLE {name} ({columns}, `partition` string, `trade_dt` date) USING parquet "
              f"PARTITIONED BY (`partition`, `trade_dt`) CLUSTERED BY ({', '.join(BUCKET_COLUMNS)}) "
              f"SORTED BY ({', '.join([*S.SERIES_KEY, 'event_tm'])}) INTO {layout['buckets']} BUCKETS "
              f"LOCATION '{files.root}/{folder}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")  # one folder for each kind and day
    return Clustered(spark.table(name), layout["buckets"], layout["slot"], layout["window"])


def _fields(schema: str) -> list[str]:
    """``name:type`` of a simple struct; types here have commas in parentheses only."""
    out, depth = [""], 0
    for c in schema:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out
