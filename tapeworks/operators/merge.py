"""Incremental latest versions over re-arrivals (A1 without reading everything again).

The table holds the latest versions of each key in parts (day, bucket of the key's hash).
A batch of arrivals touches some parts; these alone are read, merged with the batch and
published in their place (:mod:`tapeworks.sources.publish`). The maximum of maxima is
the maximum, and rows tied on it are kept on both sides, so any sequence of batches gives what one
run over all arrivals gives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import schema as S
from ..sources.publish import publish, read_published
from .latest import keep_latest

DAY, BUCKET = "day", "bucket"
#: Buckets of a day. A part should be about a file's size.
BUCKETS = 16


def merge_latest(arrivals: DataFrame, root: str, keys: Sequence[str] = S.EVENT_KEY, version: str = S.VERSION_COL,
                 day_col: str = "trade_dt", buckets: int = BUCKETS, tie_break: Sequence[str] | None = None,
                 method: str = "window") -> list[str]:
    """Merge a batch into the table at ``root``; the parts that were rewritten.

    ``keys`` contain ``day_col``. ``tie_break`` and ``method`` are those of :func:`keep_latest`;
    ``buckets`` must be the same for all batches of a table. Rows without a version are never
    the latest. The parts touched are as many as days and buckets in the batch, and their
    names alone reach the driver.

    The batch is read twice (for its parts, and to be merged). One shuffle deals old and new
    rows by part, which also serves the latest-version window and leaves one file a part.
    """
    if day_col not in keys:
        raise ValueError(f"the keys must contain {day_col}")
    if len({DAY, BUCKET} & set(arrivals.columns)):
        raise ValueError(f"columns named {DAY} or {BUCKET} are taken by the table's parts")
    spark = arrivals.sparkSession
    # A NULL key is a key: its hash is that of the other columns.
    placed = arrivals.where(F.col(version).isNotNull()).withColumns({
        DAY: F.col(day_col).cast("string"), BUCKET: F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")})
    touched = [_part(r) for r in placed.select(DAY, BUCKET).distinct().collect()]
    if not touched:
        return []
    old = read_published(spark, root, touched)
    both = placed
    if old is not None:
        both = placed.unionByName(old.withColumns({DAY: F.col(day_col).cast("string"), BUCKET: F.col(BUCKET).cast("int")}))
    both = both.repartition(DAY, BUCKET)
    latest = keep_latest(both, [*keys, DAY, BUCKET], version, tie_break, method)
    return publish(latest, root, [DAY, BUCKET])


def _part(row) -> str:
    # As Spark names the folder of a NULL.
    return f"{DAY}={row[DAY] if row[DAY] is not None else '__HIVE_DEFAULT_PARTITION__'}/{BUCKET}={row[BUCKET]}"


def read_latest(spark, root: str, days: Sequence | None = None) -> DataFrame:
    """The merged table; ``days`` prunes by folder."""
    df = read_published(spark, root)
    if df is None:
        raise ValueError(f"nothing is published at {root}")
    if days is not None:
        df = df.where(F.col(DAY).cast("string").isin(*[str(d) for d in days]))
    return df.drop(DAY, BUCKET)
