"""Incremental ingest with Structured Streaming.

The batch ingest re-reads a day's folders on every run. As a stream, new feed
files are picked up as they land, parsed with exactly the same column
expressions (:mod:`tapeworks.operators.ingest`), and appended to the staged
table partitioned by ``partition``. All formats are one query with one
checkpoint: the file sink's log is numbered by the query's batches, so two
queries with checkpoints of their own that write to one folder would take each
other's batches for done. With one query, a restart neither loses nor repeats a
file; the Parquet file sink commits each micro-batch atomically.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import parse_lines


def stage_streams(spark: SparkSession, paths_by_format: Mapping[str, str], staged_path: str,
                  checkpoint: str, available_now: bool = True,
                  max_files_per_trigger: int | None = None,
                  strict_json_types: bool = True) -> StreamingQuery:
    """Start the query that stages every file of each format's path (glob
    allowed, e.g. ``{"csv": "<root>/csv/*/*", "json": "<root>/json/*/*"}``).

    ``available_now=True`` processes what is there in bounded micro-batches and
    stops (a scheduled job); ``False`` keeps running every 10 s. The
    ``checkpoint`` folder must be on shared storage; a staged path belongs to
    one checkpoint, and adding a format later needs a new one.
    """
    parts = []
    for fmt, path in paths_by_format.items():
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        kw = {"strict_json_types": strict_json_types} if fmt == "json" else {}
        parts.append(parse_lines(reader.load(path), fmt, **kw))
    staged = functools.reduce(lambda a, b: a.unionByName(b), parts)
    writer = (staged.writeStream.format("parquet").partitionBy("partition")
              .option("path", staged_path).option("checkpointLocation", checkpoint)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def stage_stream(spark: SparkSession, input_path: str, fmt: str, staged_path: str,
                 checkpoint: str, **kw) -> StreamingQuery:
    """:func:`stage_streams` of one format; no other query may write to ``staged_path``."""
    return stage_streams(spark, {fmt: input_path}, staged_path, checkpoint, **kw)
