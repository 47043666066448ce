"""Equi-join with a side that is usually small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def join_small(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``big`` with ``small`` on ``on``.

    No broadcast hint: an estimate made before a job runs can be far too low (a
    well compressed text column, an exploding step). Adaptive execution
    broadcasts ``small`` when its *measured* size is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and else splits the hot
    partitions of a shuffle join. No job runs to decide.
    """
    return big.join(small, on=list(on), how=how)
