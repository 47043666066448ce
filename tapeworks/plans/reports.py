"""The reports: end-of-day trades and quotes, and the quote analytics.

All take the staged common table (``partition`` = T / Q / B) and return a
DataFrame; writing is left to :mod:`tapeworks.sources.parquet`. The end-of-day reports and
the analytics also take the clustered ticks (:mod:`tapeworks.sources.layout`), from which they
read without an exchange of ticks.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, functions as F

from .. import schema as S
from ..operators.joins import join_small
from ..operators.latest import keep_latest
from ..functions.time import interval_micros
from ..operators.ordered import range_ordered
from ..operators.series import Slots, last_known, period_close, prior_period, trailing_mean
from ..sources.layout import GHOST, SLOT, Clustered

TIE = ("event_seq_nb", "arrival_tm")


def _day(day) -> _dt.date | None:
    if day is None or isinstance(day, _dt.date):
        return day
    try:
        return _dt.date.fromisoformat(str(day))
    except ValueError as e:
        raise ValueError(f"invalid processing date {day!r}") from e


def trades_of(staged: DataFrame, day=None) -> DataFrame:
    """Trade rows (F1 on the partition column -> partition pruning), P1."""
    t = staged.where(F.col("partition") == S.TRADE)
    if (d := _day(day)) is not None:
        t = t.where(F.col("trade_dt") == F.lit(d))
    return t.select(*S.TRADE_COLUMNS)


def quotes_of(staged: DataFrame, day=None) -> DataFrame:
    q = staged.where(F.col("partition") == S.QUOTE)
    if (d := _day(day)) is not None:
        q = q.where(F.col("trade_dt") == F.lit(d))
    return q.select(*S.QUOTE_COLUMNS)


def _clustered_of(ticks: Clustered, kind: str, columns, day=None) -> DataFrame:
    rows = ticks.kind(kind)
    if (d := _day(day)) is not None:
        rows = rows.where(F.col("trade_dt") == F.lit(d))
    return rows.select(*columns, SLOT)


def _eod(staged: DataFrame | Clustered, kind: str, columns, day, tie_break) -> DataFrame:
    if isinstance(staged, Clustered):
        # An event's slot follows from its time, so it changes no group; with it the groups lie
        # in one bucket each.
        rows = _clustered_of(staged, kind, columns, day)
        return keep_latest(rows, [*S.EVENT_KEY, SLOT], S.VERSION_COL, tie_break).drop(SLOT)
    rows = trades_of(staged, day) if kind == S.TRADE else quotes_of(staged, day)
    return keep_latest(rows, S.EVENT_KEY, S.VERSION_COL, tie_break)


def eod_trades(staged: DataFrame | Clustered, day=None, tie_break=None) -> DataFrame:
    """Latest-arriving version of every trade of ``day`` (all days if None)."""
    return _eod(staged, S.TRADE, S.TRADE_COLUMNS, day, tie_break)


def eod_quotes(staged: DataFrame | Clustered, day=None, tie_break=None) -> DataFrame:
    """Latest-arriving version of every quote of ``day`` (all days if None)."""
    return _eod(staged, S.QUOTE, S.QUOTE_COLUMNS, day, tie_break)


def daily_close(trades: DataFrame) -> DataFrame:
    """(symbol, exchange, trade_dt, close_trade_pr): price of the day's last
    trade by (event_tm, event_seq_nb, arrival_tm)."""
    return period_close(trades, S.SERIES_KEY, "trade_dt", "event_tm", "trade_pr",
                        tie=TIE, out="close_trade_pr")


def prior_close(trades: DataFrame) -> DataFrame:
    """(symbol, exchange, trade_dt, prior_close_trade_pr) for each traded day:
    the close of the previous day *with trades* (NULL for the first)."""
    return prior_period(daily_close(trades), S.SERIES_KEY, "trade_dt", "close_trade_pr",
                        out="prior_close_trade_pr")


def _prior_close_any_day(trades: DataFrame, quotes: DataFrame) -> DataFrame:
    """Prior close for every quoted day, traded or not: close of the last
    traded day strictly before it (as-of over days), NULL where that day's last
    trade has no price, as on traded days."""
    closes = daily_close(trades).withColumn(
        "__close_tm", F.to_timestamp_ntz(F.date_add("trade_dt", 1).cast("string"))).withColumn(
        "__close", F.struct("close_trade_pr"))  # a struct is never NULL, so no day is skipped
    days = quotes.select(*S.SERIES_KEY, "trade_dt").distinct().withColumn(
        "__day_tm", F.to_timestamp_ntz(F.col("trade_dt").cast("string")))
    found = last_known(days, closes, S.SERIES_KEY, "__close_tm",
                       {"__prior": "__close"}, tie=("trade_dt",), probe_time="__day_tm")
    return found.select(*S.SERIES_KEY, "trade_dt",
                        F.col("__prior.close_trade_pr").alias("prior_close_trade_pr"))


def _days_read(ticks: DataFrame, d, lookback_days) -> DataFrame:
    if d is None:
        return ticks
    ticks = ticks.where(F.col("trade_dt") <= F.lit(d))
    if lookback_days is not None:
        ticks = ticks.where(F.col("trade_dt") >= F.lit(d - _dt.timedelta(days=lookback_days)))
    return ticks


def _clustered_lookup(ticks: Clustered, d, window, latest_only: bool, lookback_days) -> tuple:
    """(quotes with what was known, trades, quotes) of the clustered ticks."""
    if interval_micros(window) > ticks.window:
        raise ValueError("the window is wider than the one whose trades were copied")
    rows = _days_read(ticks.kind(S.TRADE, GHOST), d, lookback_days).select(*S.TRADE_COLUMNS, "partition", SLOT)
    if latest_only:
        rows = keep_latest(rows, [*S.EVENT_KEY, SLOT, "partition"], S.VERSION_COL)
    quotes = _clustered_of(ticks, S.QUOTE, S.QUOTE_COLUMNS, d)
    found = last_known(quotes, rows, S.SERIES_KEY, "event_tm", {"prior_trade_pr": "trade_pr"}, tie=TIE,
                       distinct_probes=True, means={"prior_mov_avg_trade_pr": ("trade_pr", window)},
                       slots=Slots(SLOT, ticks.slot, ticks.buckets, "partition", GHOST))
    return found, rows.where(F.col("partition") == S.TRADE).drop("partition", SLOT), quotes


def quote_analytics(staged: DataFrame | Clustered, day=None, window="30 minutes",
                    latest_only: bool = False, keep_untraded: bool = False,
                    bucket="30 minutes", with_movement: bool = False, sort: bool = True,
                    lookback_days: int | None = None) -> DataFrame:
    """For each distinct quote: the last trade price at or before it, the
    trailing ``window`` mean price at that trade, and the previous traded day's
    close. Quotes on a day without trades are dropped unless ``keep_untraded``.

    * Trades count every delivered version (re-arrivals included) unless
      ``latest_only``; exact duplicate quotes appear once (union-distinct
      semantics of the source report).
    * The as-of runs across days: the first quotes of a day see the previous
      day's last trade.
    * ``bucket``: the time bucket that splits each series, so a hot symbol
      spreads over as many tasks as it has buckets. Trades and quotes are
      shuffled once, by (series, bucket), for the mean and the as-of together;
      what crosses buckets travels as a carry table of one row per series and
      bucket. A bucket narrower than ``window`` (for extreme symbols) computes
      the mean by prefix sums first; ``None`` windows whole series. The result
      is the same at every width, and the plan does not depend on the data.
    * ``lookback_days`` with ``day``: read trades of that many days before the
      day only. The source job reads the processing day and the one before (1).
      The result equals the all-days one where each quoted series traded within
      those days; ``None`` reads all earlier days. Trades after ``day`` are
      never read.
    * Clustered ticks: their slots take the place of ``bucket``, and neither trades nor
      quotes are exchanged.
    * ``with_movement`` adds bid/ask and their difference to the prior close.

    Building the plan runs no job.
    """
    d = _day(day)
    if not isinstance(staged, Clustered):
        staged = _days_read(staged, d, lookback_days)
        trades = trades_of(staged)
        if latest_only:
            trades = keep_latest(trades, S.EVENT_KEY, S.VERSION_COL)
        quotes = quotes_of(staged, d)

    if isinstance(staged, Clustered):
        found, trades, quotes = _clustered_lookup(staged, d, window, latest_only, lookback_days)
    elif bucket is None or interval_micros(bucket) >= interval_micros(window):
        found = last_known(quotes, trades, S.SERIES_KEY, "event_tm", {"prior_trade_pr": "trade_pr"},
                           tie=TIE, bucket=bucket, distinct_probes=True,
                           means={"prior_mov_avg_trade_pr": ("trade_pr", window)})
    else:
        with_avg = trailing_mean(trades, "trade_pr", "event_tm", S.SERIES_KEY, width=window,
                                 out="mov_avg_trade_pr", bucket=bucket)
        found = last_known(quotes, with_avg, S.SERIES_KEY, "event_tm",
                           {"prior_trade_pr": "trade_pr",
                            "prior_mov_avg_trade_pr": "mov_avg_trade_pr"},
                           tie=TIE, bucket=bucket, distinct_probes=True)

    keys = ["trade_dt", *S.SERIES_KEY]
    if keep_untraded:
        close = _prior_close_any_day(trades, quotes)
        out = join_small(found, close, keys, "left")
    else:
        close = prior_close(trades)
        if d is not None:
            close = close.where(F.col("trade_dt") == F.lit(d))
        out = join_small(found, close, keys, "inner")

    cols = [F.col("trade_dt"), F.col("symbol"), F.col("exchange"), F.col("event_tm"),
            F.col("prior_trade_pr"),
            F.col("prior_mov_avg_trade_pr").cast(S.PRICE).alias("prior_mov_avg_trade_pr"),
            F.col("prior_close_trade_pr")]
    if with_movement:
        cols += [F.col("bid_pr"), F.col("ask_pr"),
                 (F.col("bid_pr") - F.col("prior_close_trade_pr")).alias("bid_pr_move"),
                 (F.col("ask_pr") - F.col("prior_close_trade_pr")).alias("ask_pr_move")]
    out = out.select(*cols)
    if sort:
        out = _sorted(out, quotes)
    return out


#: The order of the report (O1).
REPORT_ORDER = ("symbol", "exchange", "event_tm")


def _sorted(report: DataFrame, quotes: DataFrame) -> DataFrame:
    """The report in its order over all files. The ranges come from a sketch of
    the quotes, so nothing of the report is evaluated for them; a hot series is cut by time."""
    return range_ordered(report, REPORT_ORDER, sketched=quotes, tell_apart=TIE)


def price_movement(staged: DataFrame, day=None, **kw) -> DataFrame:
    """X12: the analytics plus bid/ask movement against the prior close."""
    return quote_analytics(staged, day, with_movement=True, **kw)


def report_head(report: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows in a total order (O3): (symbol, exchange, event_tm),
    then every other column, so the head is the same on every run."""
    first = ["symbol", "exchange", "event_tm"]
    rest = [c for c in report.columns if c not in first]
    return report.orderBy(*first, *rest).limit(n)


def analytics_all_days(staged: DataFrame, **kw) -> DataFrame:
    """M6: the analytics over every day, without the ``trade_dt`` column."""
    rep = quote_analytics(staged, None, sort=False, **kw)
    return _sorted(rep.drop("trade_dt"), quotes_of(staged))
