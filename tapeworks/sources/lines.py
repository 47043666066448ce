"""Text line sources (S1-S5) and the input folder rule."""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

log = logging.getLogger(__name__)

# Input folder rule: <root>/<format>/<yyyy-mm-dd>/<any folder>/<any file>.
INPUT_LAYOUT = "{root}/{fmt}/{date}/*/*"
FORMATS = ("csv", "json")


def input_glob(root: str, fmt: str, day: _dt.date, layout: str = INPUT_LAYOUT) -> str:
    return layout.format(root=root.rstrip("/"), fmt=fmt, date=day.isoformat())


def processing_days(day, prior_day=None) -> list[_dt.date]:
    """The processing day and the day before it (or ``prior_day``)."""
    try:
        d = day if isinstance(day, _dt.date) else _dt.date.fromisoformat(str(day))
    except ValueError as e:
        raise ValueError(f"invalid processing date {day!r}") from e
    p = prior_day if prior_day is not None else d - _dt.timedelta(days=1)
    p = p if isinstance(p, _dt.date) else _dt.date.fromisoformat(str(p))
    return [d, p]


def _exists(spark: SparkSession, pattern: str) -> bool:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(path)
    return found is not None and len(found) > 0


def read_lines(spark: SparkSession, paths: str | Sequence[str],
               missing_ok: bool = False) -> DataFrame:
    """All lines of all files matching ``paths`` as ``DataFrame[value]``: one
    scan, split by Spark into file blocks (``maxPartitionBytes``).

    A pattern matching nothing fails, unless ``missing_ok`` (then it is
    skipped; no pattern left gives an empty result).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if missing_ok:
        kept = [p for p in paths if _exists(spark, p)]
        for p in set(paths) - set(kept):
            log.warning("no input matches %s", p)
        paths = kept
    if not paths:
        return spark.createDataFrame([], "value string")
    return spark.read.text(paths)


def read_whole_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per file: ``value`` = the file's text, ``path`` = its name (S5)."""
    return (spark.read.text(paths, wholetext=True)
            .select("value", F.input_file_name().alias("path")))


def split_by_format(paths: Iterable[str]) -> dict[str, list[str]]:
    """Group paths by extension, or by format folder where the extension says
    nothing (S3); unknown ones are skipped with a warning."""
    out: dict[str, list[str]] = {f: [] for f in FORMATS}
    for p in paths:
        low = p.lower()
        fmt = next((f for f in FORMATS if low.endswith("." + f)),
                   next((f for f in FORMATS if f"/{f}/" in low), None))
        if fmt is None:
            log.warning("skipping %s: unknown format", p)
            continue
        out[fmt].append(p)
    return out


def line_count(spark: SparkSession, paths) -> DataFrame:
    """S4 + A2: number of lines under ``paths`` as a one-row DataFrame."""
    return read_lines(spark, paths).agg(F.count(F.lit(1)).alias("n_lines"))
