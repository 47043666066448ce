"""Trading calendar: which days are sessions, and the session before a day.

A calendar is a table (day date, is_open boolean), with an exchange column if
exchanges close on different days. A job that processes a Monday or the day after a
holiday needs the last session, not the day before (E11): :func:`prior_session` asks the
calendar, :func:`prior_day_with_input` also asks the input folders.
"""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .lines import FORMATS, INPUT_LAYOUT, _exists, input_glob, processing_days

log = logging.getLogger(__name__)

#: Days that a search goes back: longer than any exchange's holidays.
BACK = 14


def weekdays(spark: SparkSession, first, last, closed: Sequence = ()) -> DataFrame:
    """The calendar of an exchange that is open on Monday to Friday but for ``closed``."""
    days = spark.sql(f"SELECT explode(sequence(DATE'{first}', DATE'{last}')) AS day")
    shut = F.col("day").cast("string").isin(*[str(d) for d in closed]) if closed else F.lit(False)
    return days.withColumn("is_open", (F.dayofweek("day").between(2, 6)) & ~shut)


def prior_sessions(calendar: DataFrame, keys: Sequence[str] = (), out: str = "prior_day") -> DataFrame:
    """(keys, day, prior_day): for each day of the calendar, open or not, the last open one
    strictly before it (NULL before the first). A day given several times is open
    if one of its rows says so; rows without a day are left out."""
    keys = list(keys)
    once = (calendar.where(F.col("day").isNotNull()).groupBy(*keys, "day")
            .agg(F.max(F.coalesce("is_open", F.lit(False))).alias("is_open")))
    # One row per exchange and day: a series of some 250 rows a year.
    before = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return once.select(*keys, "day", F.last(F.when(F.col("is_open"), F.col("day")), ignorenulls=True)
                       .over(before).alias(out))


def prior_session(calendar: DataFrame, day) -> _dt.date | None:
    """The last open day before ``day``, which the calendar need not hold."""
    d, _ = processing_days(day)
    return calendar.where(F.col("is_open") & (F.col("day") < F.lit(d))).agg(F.max("day")).first()[0]


def prior_day_with_input(spark: SparkSession, input_root: str, day, calendar: DataFrame | None = None,
                         layout: str = INPUT_LAYOUT, back: int = BACK,
                         formats: Sequence[str] = FORMATS) -> _dt.date:
    """The last day before ``day`` that has input in some format, looking back
    ``back`` days; with a calendar only its open days are looked at (a closed day's folder
    holds no session). Fails where there is none, and warns of open days without input."""
    d, _ = processing_days(day)
    days = [d - _dt.timedelta(days=n) for n in range(1, back + 1)]
    if calendar is not None:
        rows = calendar.where(F.col("is_open") & F.col("day").between(F.lit(days[-1]), F.lit(days[0])))
        open_days = {r["day"] for r in rows.select("day").distinct().collect()}  # ``back`` days at most
        days = [x for x in days if x in open_days]
    for x in days:
        if any(_exists(spark, input_glob(input_root, fmt, x, layout)) for fmt in formats):
            return x
        if calendar is not None:
            log.warning("no input for %s, an open day", x)
    raise FileNotFoundError(f"no input in the {back} days before {d} under {input_root}")
