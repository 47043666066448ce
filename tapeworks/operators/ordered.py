"""Globally ordered output without evaluating the sorted rows twice (O1).

``orderBy`` samples its input for range bounds, so everything since the last shuffle
runs twice. :func:`range_ordered` takes the bounds from a sketch of another, cheaper
frame with (about) the same distribution of the keys: the ``k`` rows with the smallest hashes,
a uniform sample of fixed size that tasks reduce and the driver merges. Rows then go
straight to their range (``repartitionById``) and are sorted there, so partition i
of the result, and file i of a written one, holds only keys before those of i + 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Sketched rows for each partition of the result, and altogether.
PER_PARTITION, MOST = 64, 200_000


def key_bounds(sketched: DataFrame, keys: Sequence[str], partitions: int, tell_apart: Sequence[str] = (),
               per_partition: int = PER_PARTITION) -> DataFrame:
    """One row, one column: ``partitions - 1`` key structs in order that cut the rows of
    ``sketched`` into equal parts. ``tell_apart``: further columns that are hashed, so that
    many rows of one key are as many chances to be sketched. No job runs here."""
    size = min(MOST, per_partition * partitions)
    hashed = F.xxhash64(*keys, *[c for c in tell_apart if c not in keys])
    sample = sketched.select(F.struct(*keys).alias("key"), hashed.alias("hash")).orderBy("hash", "key").limit(size)
    cuts = F.transform(F.sequence(F.lit(1), F.lit(max(1, partitions - 1))),
                       lambda i: F.get("all", F.floor(i * F.size("all") / partitions).cast("int")))
    return sample.agg(F.array_sort(F.collect_list("key")).alias("all")).select(cuts.alias("bounds"))


def _bounds_below(bounds: Column, key: Column, partitions: int) -> Column:
    """How many of the sorted bounds are below ``key``, by bisection."""
    steps = F.array(*[F.lit(1 << i) for i in range((partitions - 1).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(
        F.coalesce(F.get(bounds, at + step - 1) < key, F.lit(False)), step).otherwise(F.lit(0)))


def range_ordered(df: DataFrame, keys: Sequence[str], sketched: DataFrame | None = None,
                  tell_apart: Sequence[str] = (), partitions: int | None = None,
                  order: Sequence[str] | None = None) -> DataFrame:
    """``df`` in the order of ``keys`` (ascending, NULLs first) over its partitions.

    ``sketched`` (default: ``df``) has the key columns, and is scanned once for the
    bounds; it decides how even the partitions are and never what they hold. A long
    run of one leading key is cut by the following ones. Rows equal in all ``keys`` stay in
    one partition. ``partitions``: by default the session's ``spark.sql.shuffle.partitions``.
    ``order``: the order inside a partition, which begins with the keys (default: the keys).
    """
    order = list(order or keys)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if n < 2:
        return df.coalesce(1).sortWithinPartitions(*order)
    bounds = key_bounds(df if sketched is None else sketched, keys, n, tell_apart).scalar()
    place = df.withColumn("__bounds", bounds).withColumn(
        "__place", _bounds_below(F.col("__bounds"), F.struct(*keys), n)).drop("__bounds")
    return place.repartitionById(n, F.col("__place")).sortWithinPartitions(*order).drop("__place")
