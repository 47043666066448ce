"""Latest version per key (A1, W7, F3, F4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .. import schema as S


def keep_latest(df: DataFrame, keys: Sequence[str] = S.EVENT_KEY,
                version: str = S.VERSION_COL, tie_break: Sequence[str] | None = None,
                method: str = "window") -> DataFrame:
    """Keep the rows whose ``version`` equals the maximum for their ``keys``.

    Default: every row tied on the maximum is kept (the source behaviour: exact
    re-deliveries all survive). With ``tie_break`` exactly one row per key
    survives: the greatest by ``version``, then ``tie_break``, then the other
    columns, so the choice is deterministic. NULL keys group together. Rows
    without a version are never the latest: a key with no other rows is absent.

    ``method="window"`` (default): one hash exchange on the key; right when a key
    has few versions, as event keys do. ``method="aggregate"`` (skew-safe): the
    maximum per key comes from a partially aggregated ``groupBy`` (a hot key
    ships one row per map task), and rows are matched to it with an equi-join,
    which adaptive execution broadcasts when small or splits when one key is
    hot; for keys that may hold a large share of the rows.
    """
    keys = list(keys)
    df = df.where(F.col(version).isNotNull())
    if method == "window":
        return _by_window(df, keys, version, tie_break)
    if method != "aggregate":
        raise ValueError(f"unknown method {method!r}")
    if tie_break is not None:
        rest = [c for c in df.columns if c not in keys and c != version and c not in tie_break]
        best = F.max(F.struct(*[F.col(c) for c in [version, *tie_break, *rest]])).alias("__best")
        return (df.groupBy(*keys).agg(best)
                  .select(*keys, *[F.col(f"__best.{c}").alias(c) for c in [version, *tie_break, *rest]])
                  .select(*df.columns))
    # One struct of the keys: its equality takes NULLs as equal and keeps the
    # aggregate's partitioning for the join.
    keyed = df.withColumn("__key", F.struct(*keys))
    latest = keyed.groupBy("__key").agg(F.max(version).alias("__max_version"))
    joined = keyed.join(latest, "__key").where(F.col(version) == F.col("__max_version"))
    return joined.select(*df.columns)


def _by_window(df: DataFrame, keys: list[str], version: str, tie_break) -> DataFrame:
    w = Window.partitionBy(*keys)
    if tie_break is None:
        return (df.withColumn("__max_version", F.max(version).over(w))
                  .where(F.col(version) == F.col("__max_version"))
                  .drop("__max_version"))
    rest = [c for c in df.columns if c not in keys and c != version and c not in tie_break]
    order = [F.col(c).desc_nulls_last() for c in [version, *tie_break, *rest]]
    return (df.withColumn("__rank", F.row_number().over(w.orderBy(*order)))
              .where(F.col("__rank") == 1)
              .drop("__rank"))
