"""Time arithmetic as column expressions."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

_UNITS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
    "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
}


def interval_micros(width) -> int:
    """``'30 minutes'`` / ``timedelta`` / int micros -> int micros."""
    if isinstance(width, int):
        return width
    if isinstance(width, _dt.timedelta):
        return (width.days * 86_400 + width.seconds) * 1_000_000 + width.microseconds
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", str(width).lower())
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"cannot read interval {width!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP or TIMESTAMP_NTZ column.

    NTZ values are read as wall-clock (no zone shift), so differences are exact
    and independent of the session zone.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(col))
    raise TypeError(f"{col} is {dtype}, not a timestamp")


def time_bucket(micros: Column, width_micros: int) -> Column:
    """Start (epoch micros) of the fixed-width bucket holding ``micros``.

    Integer arithmetic only, so bucket edges are exact at any magnitude.
    """
    w = F.lit(width_micros).cast("long")
    return (micros - F.pmod(micros, w)).cast("long")
