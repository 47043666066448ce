"""tapeworks: quote and trade feeds on Spark.

Ingest CSV and JSON event lines into one typed schema with a quarantine, keep
the latest version of each event, and build end-of-day and quote analytics
reports (last trade, trailing mean, prior close). Every operator is a
DataFrame -> DataFrame function over column expressions, windows, aggregates
and joins.
"""

from .operators.ingest import parse_csv, parse_json, parse_lines
from .operators.latest import keep_latest
from .operators.series import last_known, period_close, prior_period, trailing_mean
from .operators.joins import join_small
from .plans.reports import (daily_close, eod_quotes, eod_trades, prior_close,
                            price_movement, quote_analytics, report_head)
from .schema import COMMON_SCHEMA

__all__ = [
    "parse_csv", "parse_json", "parse_lines", "keep_latest", "last_known", "period_close",
    "prior_period", "trailing_mean", "join_small", "daily_close", "eod_quotes", "eod_trades",
    "prior_close", "price_movement", "quote_analytics", "report_head", "COMMON_SCHEMA",
]
