"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapeworks.session import scratch_path

#: Rows of one Arrow batch. Texts have no length bound, so batches hold few.
BATCH_ROWS = 256

#: Rows (of one to three numbers) that a join broadcasts at most.
BROADCAST_ROWS = 4_000_000


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches of few rows, so that a worker's memory is bounded by a few
    hundred texts and not by ten thousand."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def keep_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back.

    Cuts the lineage: later jobs read files that survive a lost executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.scratch_path = path
    return kept


def drop_table(kept: DataFrame) -> None:
    """Free the files of a :func:`keep_table` that no later job reads."""
    sc = kept.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(kept.scratch_path)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def fold_of(id_col: str, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds`` (NULL id: as '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased, as UTF-8.

    ``bytes.lower`` touches A-Z only and ``bytes.split`` splits at exactly the
    six ASCII spaces.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class Memo(dict):
    """``make(key)`` remembered. Holds ``limit`` keys at most besides the ``limit``
    before them, so a worker's memory is bounded whatever the vocabulary and
    keys in use are not forgotten."""

    def __init__(self, make: Callable, limit: int = 150_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


def word_hashes() -> Memo:
    """64-bit hashes of words."""
    return Memo(xxhash.xxh3_64_intdigest)


def columns_of(batches: Iterator, *names: str) -> Iterator[list[list]]:
    """The named columns of each Arrow batch as Python lists."""
    for b in batches:
        yield [b.column(n).to_pylist() for n in names]


def small(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it has BROADCAST_ROWS at most; a larger one is
    joined as the planner sees fit."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def without_ids(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is not in ``gone`` (one column of a written table); NULL ids
    stay. Texts are not shuffled for up to BROADCAST_ROWS ids."""
    gone = small(gone.toDF("__gone_id").where(F.col("__gone_id").isNotNull()))
    return docs.join(gone, docs[id_col] == gone["__gone_id"], "left_anti")
