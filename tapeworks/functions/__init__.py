"""Column-expression helpers: text conversion (strict and lenient) and time math.

Everything here returns a ``pyspark.sql.Column``; nothing runs Python per row.
"""

from .text import (strip_ws, strict_date, lenient_timestamp, strict_int,
                   strict_decimal, TIMESTAMP_FORMATS)
from .json import json_object, json_field, json_type
from .time import epoch_micros, interval_micros, time_bucket

__all__ = [
    "strip_ws", "strict_date", "lenient_timestamp", "strict_int", "strict_decimal",
    "TIMESTAMP_FORMATS", "json_object", "json_field", "json_type",
    "epoch_micros", "interval_micros", "time_bucket",
]
