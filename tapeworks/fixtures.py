"""Adapters from the driver's tables to market-shaped inputs.

The driver ships generic tables; these functions derive, with Spark
expressions only, the inputs the pipeline works on:

* ``ticks(events)``: a staged-shaped table of trades and quotes, with
  re-deliveries (later arrival, changed price) and exact duplicates.
* ``csv_lines(events)`` / ``json_lines(events)``: raw feed lines, including one
  class of bad or unusual line per ``event_id % 50`` residue listed below.
* ``run_log(orders)``: job status rows.

Rules (mirrored by the DuckDB oracle in :mod:`tapeworks.oracle`): every event is
a tick; purchase and signup -> trade, all others -> quote, but on every fifth day
of a month SYM3 only quotes (series-days without a trade); symbol
``'SYM' || user_id % 10``; exchange by ``user_id / 10``, independent of the
symbol; ``event_tm`` = ``ts`` truncated to the minute; ``arrival_tm`` = ``ts``;
``event_seq_nb`` = ``event_id``; price = ``value`` as decimal(10,2); bid = price,
ask = price + 1; in ``ticks`` the price is NULL for ``event_id % 13 = 5``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from . import schema as S

# --- fixed values: residues of event_id % 50 that select a line variant ------
CSV_BAD = {0: "wrong arity", 1: "blank line", 2: "two fields", 3: "unknown kind",
           4: "kind with trailing space", 5: "empty price", 6: "bad int",
           7: "year-only date", 8: "unpadded date", 9: "date with trailing text",
           10: "time without date", 11: "decimal out of range", 12: "int out of range"}
CSV_ODD = {13: "padded symbol and price", 14: "empty symbol", 15: "ISO T timestamp",
           16: "month-name timestamp", 17: "price with three decimals"}
JSON_BAD = {0: "broken JSON", 1: "array line", 2: "blank line", 3: "no event_type",
            4: "unknown kind", 5: "integer price", 6: "null price", 7: "fractional seq",
            8: "numeric symbol", 9: "missing exchange", 10: "year-only date",
            17: "string scalar line"}
JSON_ODD = {11: "numbers as strings", 12: "target key names", 13: "extra keys",
            14: "padded symbol", 15: "first price key missing", 16: "boolean size"}
REDELIVER_EVERY = 7   # event_id % 7 == 0: delivered again 1 hour later, price + 0.50
DUPLICATE_EVERY = 11  # event_id % 11 == 0: delivered twice, identical
NO_PRICE = (13, 5)    # event_id % 13 == 5: a staged tick without trade price or bid
UNTRADED = ("SYM3", 5)  # this symbol has no trade on every fifth day of a month
# --- end of fixed values ----------------------------------------------------


def base_ticks(events: DataFrame) -> DataFrame:
    """One staged row per event (plus ``event_id``)."""
    e = events
    symbol = F.concat(F.lit("SYM"), (F.col("user_id") % 10).cast("string"))
    quiet = (symbol == UNTRADED[0]) & (F.dayofmonth("ts") % UNTRADED[1] == 0)
    is_t = F.col("event_type").isin("purchase", "signup") & ~quiet
    ts = F.col("ts").cast(T.TimestampNTZType())
    price = F.col("value").cast(S.PRICE)
    minute = F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                  F.minute(ts), F.lit(0))
    return e.select(
        F.col("event_id"),
        ts.cast(T.DateType()).alias("trade_dt"),
        F.when(is_t, S.TRADE).otherwise(S.QUOTE).alias("rec_type"),
        symbol.alias("symbol"),
        F.when(F.floor(F.col("user_id") / 10) % 2 == 0, "NYSE").otherwise("NASDAQ").alias("exchange"),
        minute.alias("event_tm"),
        F.col("event_id").cast(T.IntegerType()).alias("event_seq_nb"),
        ts.alias("arrival_tm"),
        F.when(is_t, price).alias("trade_pr"),
        F.when(~is_t, price).alias("bid_pr"),
        F.when(~is_t, (100 * (1 + F.col("event_id") % 5)).cast("int")).alias("bid_size"),
        F.when(~is_t, (price + F.lit(1)).cast(S.PRICE)).alias("ask_pr"),
        F.when(~is_t, (100 * (1 + F.col("user_id") % 5)).cast("int")).alias("ask_size"),
        F.when(is_t, S.TRADE).otherwise(S.QUOTE).alias("partition"),
        F.lit(None).cast("string").alias("line"),
        F.when(is_t, (100 * (1 + F.col("event_id") % 3)).cast("int")).alias("trade_size"),
    )


def ticks(events: DataFrame) -> DataFrame:
    """Staged-shaped ticks with re-deliveries and exact duplicates.

    Every base tick is kept; the residue rules only choose which ticks get an
    *extra* copy (a later re-delivery, or an identical duplicate), so the
    result is the whole table plus copies.
    """
    b = base_ticks(events)
    priced = F.col("event_id") % NO_PRICE[0] != NO_PRICE[1]
    b = b.withColumns({c: F.when(priced, F.col(c)) for c in ("trade_pr", "bid_pr")})
    bump = F.lit(0.5).cast(S.PRICE)
    again = b.where(F.col("event_id") % REDELIVER_EVERY == 0).select(
        *[(F.col(c) + F.expr("INTERVAL 1 HOUR")).alias(c) if c == "arrival_tm"
          else (F.col(c) + bump).cast(S.PRICE).alias(c) if c in ("trade_pr", "bid_pr", "ask_pr")
          else F.col(c) for c in b.columns])
    twice = b.where(F.col("event_id") % DUPLICATE_EVERY == 0)
    cols = [f.name for f in S.COMMON_SCHEMA.fields]
    return b.unionByName(again).unionByName(twice).select(*cols)


def _fmt(c: Column, pattern: str) -> Column:
    return F.date_format(c, pattern)


def _line_fields(b: DataFrame):
    """Text of every field of a tick, as it appears in a feed line."""
    is_t = F.col("rec_type") == S.TRADE
    f = {
        "trade_dt": _fmt(F.col("trade_dt"), "yyyy-MM-dd"),
        "file_tm": _fmt(F.col("arrival_tm"), "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "event_type": F.col("rec_type"),
        "symbol": F.col("symbol"),
        "event_tm": _fmt(F.col("event_tm"), "yyyy-MM-dd HH:mm:ss.SSS"),
        "event_seq_nb": F.col("event_seq_nb").cast("string"),
        "exchange": F.col("exchange"),
        "price1": F.when(is_t, F.col("trade_pr")).otherwise(F.col("bid_pr")).cast("string"),
        "size1": F.when(is_t, F.col("trade_size")).otherwise(F.col("bid_size")).cast("string"),
        "ask_pr": F.col("ask_pr").cast("string"),
        "ask_size": F.col("ask_size").cast("string"),
    }
    return f, is_t


def _spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """A real feed arrives as many files, each its own input split; the
    driver's ``events`` table is a single split. ``partitions`` spreads the
    generated lines round-robin so the parse runs in parallel as it would."""
    return df.repartition(partitions) if partitions else df


def csv_lines(events: DataFrame, with_day: bool = False, partitions: int | None = None) -> DataFrame:
    """CSV feed lines (column ``value``) for every base tick, with bad and
    unusual lines selected by ``event_id % 50`` (see ``CSV_BAD``/``CSV_ODD``)."""
    b = base_ticks(events)
    f, is_t = _line_fields(b)
    c = F.col("event_id") % 50
    kind = (F.when(c == 3, F.lit("X")).when(c == 4, F.concat(f["event_type"], F.lit(" ")))
            .otherwise(f["event_type"]))
    d = (F.when(c == 7, _fmt(F.col("trade_dt"), "yyyy"))
         .when(c == 8, _fmt(F.col("trade_dt"), "yyyy-M-d"))
         .when(c == 9, F.concat(f["trade_dt"], F.lit(" x"))).otherwise(f["trade_dt"]))
    etm = (F.when(c == 10, _fmt(F.col("event_tm"), "HH:mm"))
           .when(c == 15, _fmt(F.col("event_tm"), "yyyy-MM-dd'T'HH:mm:ss"))
           .when(c == 16, _fmt(F.col("event_tm"), "MMM d yyyy HH:mm"))
           .otherwise(f["event_tm"]))
    seq = (F.when(c == 6, F.lit("abc")).when(c == 12, F.lit("3000000000"))
           .otherwise(f["event_seq_nb"]))
    sym = (F.when(c == 13, F.concat(F.lit("  "), f["symbol"], F.lit("  ")))
           .when(c == 14, F.lit("")).otherwise(f["symbol"]))
    p1 = (F.when(c == 5, F.lit("")).when(c == 11, F.lit("12345678901.00"))
          .when(c == 13, F.concat(F.lit(" "), f["price1"], F.lit(" ")))
          .when(c == 17, F.concat(f["price1"], F.lit("5"))).otherwise(f["price1"]))
    head = [d, f["file_tm"], kind, sym, etm, seq, f["exchange"], p1, f["size1"]]
    full = F.when(is_t, F.concat_ws(",", *head)).otherwise(
        F.concat_ws(",", *head, f["ask_pr"], f["ask_size"]))
    short = F.when(is_t, F.concat_ws(",", *head[:-1])).otherwise(
        F.concat_ws(",", *head, f["ask_pr"]))
    line = (F.when(c == 0, short).when(c == 1, F.lit(""))
            .when(c == 2, F.concat_ws(",", d, f["file_tm"])).otherwise(full))
    return _spread(b.select(line.alias("value"), *_day(with_day)), partitions)


def _day(with_day: bool) -> list[Column]:
    """The tick's day as ``feed_date``, for writing lines into dated folders."""
    return [F.col("trade_dt").alias("feed_date")] if with_day else []


def _kv(key: str, value: Column, quoted: bool) -> Column:
    v = F.concat(F.lit('"'), value, F.lit('"')) if quoted else value
    return F.concat(F.lit(f'"{key}":'), v)


def json_lines(events: DataFrame, with_day: bool = False, partitions: int | None = None) -> DataFrame:
    """JSON feed lines for every base tick, with bad and unusual lines selected
    by ``event_id % 50`` (see ``JSON_BAD``/``JSON_ODD``)."""
    b = base_ticks(events)
    f, is_t = _line_fields(b)
    c = F.col("event_id") % 50
    p1_key = F.when(is_t, F.when(c == 12, "trade_pr").otherwise("price")).otherwise("bid_pr")
    p1_val = (F.when(c == 5, F.floor(F.coalesce("trade_pr", "bid_pr")).cast("bigint").cast("string"))
              .when(c == 6, F.lit("null"))
              .when(c == 11, F.concat(F.lit('"'), f["price1"], F.lit('"')))
              .otherwise(f["price1"]))
    s1_key = F.when(is_t, F.lit("size")).otherwise(F.lit("bid_size"))
    s1_val = F.when(c == 16, F.lit("true")).otherwise(f["size1"])
    seq = (F.when(c == 7, F.concat(f["event_seq_nb"], F.lit(".5")))
           .when(c == 11, F.concat(F.lit('"'), f["event_seq_nb"], F.lit('"')))
           .otherwise(f["event_seq_nb"]))
    sym = (F.when(c == 8, F.lit("123"))
           .when(c == 14, F.concat(F.lit('" '), f["symbol"], F.lit(' "')))
           .otherwise(F.concat(F.lit('"'), f["symbol"], F.lit('"'))))
    d = F.when(c == 10, _fmt(F.col("trade_dt"), "yyyy")).otherwise(f["trade_dt"])
    kind = F.when(c == 4, F.lit("X")).otherwise(f["event_type"])
    parts = [
        _kv("trade_dt", d, True),
        F.when(c == 12, _kv("arrival_tm", f["file_tm"], True)).otherwise(_kv("file_tm", f["file_tm"], True)),
        F.when(c != 3, _kv("event_type", kind, True)),
        F.concat(F.lit('"symbol":'), sym),
        _kv("event_tm", f["event_tm"], True),
        _kv("event_seq_nb", seq, False),
        F.when(c != 9, _kv("exchange", f["exchange"], True)),
        F.when(c != 15, F.concat(F.lit('"'), p1_key, F.lit('":'), p1_val)),
        F.concat(F.lit('"'), s1_key, F.lit('":'), s1_val),
        F.when(~is_t, _kv("ask_pr", f["ask_pr"], False)),
        F.when(~is_t, _kv("ask_size", f["ask_size"], False)),
        F.when(c == 13, F.lit('"venue":"X","line":"zzz"')),
    ]
    body = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    line = (F.when(c == 0, F.expr("substring(__body, 1, length(__body) - 1)"))
            .when(c == 1, F.lit("[1,2]")).when(c == 2, F.lit(""))
            .when(c == 17, F.lit('"hello"')).otherwise(F.col("__body")))
    return _spread(b.select(body.alias("__body"), "event_id", "trade_dt")
                   .select(line.alias("value"), *_day(with_day)), partitions)


def timestamp_texts(events: DataFrame) -> DataFrame:
    """(event_id, value): the event's minute, written in one of twelve forms by
    ``event_id % 12``."""
    b = base_ticks(events)
    tm = F.col("event_tm")
    west = tm - F.expr("INTERVAL 4 HOURS")
    forms = [_fmt(tm, "yyyy-MM-dd'T'HH:mm:ss'Z'"), _fmt(tm, "yyyy-MM-dd HH:mm:ss'+00:00'"),
             _fmt(west, "yyyy-MM-dd'T'HH:mm:ss'-04:00'"), _fmt(tm, "yyyy-MM-dd hh:mm:ss a"),
             _fmt(tm, "yyyy-M-d H:mm"), _fmt(tm, "M/d/yyyy H:mm"), _fmt(tm, "MM/dd/yy HH:mm"),
             _fmt(tm, "d-MMM-yyyy H:mm"), _fmt(tm, "EEE MMM d HH:mm:ss yyyy"),
             _fmt(west, "yyyyMMdd'T'HHmmss'-0400'"), _fmt(tm, "M/d/yyyy h:mm a"),
             _fmt(tm, "yyyy-MM-dd HH:mm:ss.SSS")]
    return b.select("event_id", F.array(*forms)[(F.col("event_id") % 12).cast("int")].alias("value"))


def run_log(orders: DataFrame) -> DataFrame:
    """Job status rows: one per order. job id ``<job>_<day>`` with job
    ``ingestion`` or ``reports`` (by order priority), update time = order date
    plus the order key in seconds, status ``success`` unless the order is
    ``F`` (then ``failed``)."""
    job = F.when(F.col("o_orderpriority").startswith("1") | F.col("o_orderpriority").startswith("2"),
                 "ingestion").otherwise("reports")
    day = F.date_format(F.col("o_orderdate"), "yyyy-MM-dd")
    upd = F.col("o_orderdate").cast(T.TimestampNTZType()) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.col("o_orderkey").cast("decimal(18,6)"))
    return orders.select(F.concat(job, F.lit("_"), day).alias("job_id"),
                         upd.alias("update_time"),
                         F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success")
                         .alias("status"))
