"""The common event schema, the two CSV layouts, the key rename map and the
quarantine sentinels.

Everything in this module is a fixed value: readers of the staged table, the
reports and the error records depend on exactly these names, types and values.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Positional layout of a CSV quote line (11 fields) and a CSV trade line (9).
QUOTE_LAYOUT = (
    "trade_dt", "file_tm", "event_type", "symbol", "event_tm", "event_seq_nb",
    "exchange", "bid_pr", "bid_size", "ask_pr", "ask_size",
)
TRADE_LAYOUT = (
    "trade_dt", "file_tm", "event_type", "symbol", "event_tm", "event_seq_nb",
    "exchange", "price", "size",
)
# Input key -> common column name. Other keys keep their own name.
RENAMES = {"event_type": "rec_type", "file_tm": "arrival_tm", "price": "trade_pr"}
# Index (0-based) of the record kind in a CSV line.
KIND_POSITION = 2
QUOTE, TRADE, BAD = "Q", "T", "B"

# Quarantine sentinels, by Spark type name.
SENTINEL_DATE = _dt.date(2000, 1, 1)
SENTINEL_TIMESTAMP = _dt.datetime(2000, 1, 1, 0, 0, 0)
SENTINEL_INT = -1
SENTINEL_DECIMAL = Decimal("-1.00")
SENTINEL_STRING = "INVALID"
# --- end of fixed values ----------------------------------------------------

PRICE = T.DecimalType(10, 2)
# Timestamps in the feeds carry no zone, so they are kept as wall-clock
# TIMESTAMP_NTZ: the staged table then reads the same in every session zone.
TIMESTAMP = T.TimestampNTZType()

COMMON_SCHEMA = T.StructType([
    T.StructField("trade_dt", T.DateType(), False),
    T.StructField("rec_type", T.StringType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("exchange", T.StringType(), False),
    T.StructField("event_tm", TIMESTAMP, False),
    T.StructField("event_seq_nb", T.IntegerType(), False),
    T.StructField("arrival_tm", TIMESTAMP, False),
    T.StructField("trade_pr", PRICE, True),
    T.StructField("bid_pr", PRICE, True),
    T.StructField("bid_size", T.IntegerType(), True),
    T.StructField("ask_pr", PRICE, True),
    T.StructField("ask_size", T.IntegerType(), True),
    T.StructField("partition", T.StringType(), False),
    T.StructField("line", T.StringType(), True),
])

# Data columns: the schema without the routing tag and the raw line.
DATA_FIELDS = [f for f in COMMON_SCHEMA.fields if f.name not in ("partition", "line")]

# Identity of one event, and the column that orders its versions.
EVENT_KEY = ("trade_dt", "symbol", "exchange", "event_tm", "event_seq_nb")
VERSION_COL = "arrival_tm"
SERIES_KEY = ("symbol", "exchange")

TRADE_COLUMNS = ("trade_dt", "symbol", "exchange", "event_tm", "event_seq_nb",
                 "arrival_tm", "trade_pr")
QUOTE_COLUMNS = ("trade_dt", "symbol", "exchange", "event_tm", "event_seq_nb",
                 "arrival_tm", "bid_pr", "bid_size", "ask_pr", "ask_size")
ANALYTICS_COLUMNS = ("trade_dt", "symbol", "exchange", "event_tm", "prior_trade_pr",
                     "prior_mov_avg_trade_pr", "prior_close_trade_pr")

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("job_id", T.StringType(), False),
    T.StructField("update_time", TIMESTAMP, False),
    T.StructField("status", T.StringType(), False),
])


def sentinel_column(dtype: T.DataType):
    """The quarantine value as a typed literal column. Timestamps are built
    from text so no session time zone is applied to them."""
    from pyspark.sql import functions as F
    v = sentinel_for(dtype)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.lit(v.isoformat(sep=" ")).cast(dtype)
    return F.lit(v).cast(dtype)


def sentinel_for(dtype: T.DataType):
    """Quarantine value for a column of ``dtype``."""
    if isinstance(dtype, T.DateType):
        return SENTINEL_DATE
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return SENTINEL_TIMESTAMP
    if isinstance(dtype, T.IntegerType):
        return SENTINEL_INT
    if isinstance(dtype, T.DecimalType):
        return SENTINEL_DECIMAL
    if isinstance(dtype, T.StringType):
        return SENTINEL_STRING
    raise TypeError(f"no sentinel for {dtype}")
