"""Tables published atomically: data in version folders, a numbered manifest that names
the folders in force (K1-K3).

    <root>/_data/version=<id>/<key>=<value>/.../part-*.parquet
    <root>/_manifest/<number>.json        {"parts": {"<key>=<value>/...": ["<id>", ...]}}

A write goes to a new version folder and takes effect when its manifest appears under
the next number: one rename of a complete small file onto a name that nobody has. Readers
take the highest number. So a job that fails or loses its driver midway leaves the
table as it was, a reader sees all of a write or nothing, and of two writers at once the
later one adds its parts to the manifest of the other. Nothing is deleted by a write;
:func:`clean` removes what no recent manifest names.

All access goes through Hadoop's file systems, as Spark's own does.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

DATA, MANIFEST = "_data", "_manifest"
#: Tries to add a manifest while other writers add theirs.
TRIES = 20


class _Files:
    """A folder in any of Hadoop's file systems."""

    def __init__(self, spark: SparkSession, root: str):
        sc = spark.sparkContext
        self.jvm, self.root = sc._jvm, root.rstrip("/")
        self.fs = self.path("").getFileSystem(sc._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        where = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(where)) if self.fs.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def add(self, name: str, text: str) -> bool:
        """A new file, complete from the moment it has its name; False if the name is taken."""
        spare = self.path(f"{name}.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(spare, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self.fs.exists(self.path(name)) or not self.fs.rename(spare, self.path(name)):
            self.fs.delete(spare, False)
            return False
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _numbers(files: _Files) -> list[int]:
    return [int(n[:-5]) for n in files.names(MANIFEST) if n.endswith(".json")]


def manifest(spark: SparkSession, root: str) -> dict[str, list[str]] | None:
    """Version ids in force for each part; None where nothing was published."""
    files = _Files(spark, root)
    numbers = _numbers(files)
    return json.loads(files.read(f"{MANIFEST}/{numbers[-1]:010d}.json"))["parts"] if numbers else None


def _parts(files: _Files, folder: str, keys: Sequence[str]) -> list[str]:
    """Paths of the partitions below a version folder: as deep as there are keys."""
    found = [""]
    for key in keys:
        found = [f"{f}/{n}".lstrip("/") for f in found for n in files.names(f"{folder}/{f}".rstrip("/"))
                 if n.startswith(f"{key}=")]
    return found


def publish(df: DataFrame, root: str, keys: Sequence[str], mode: str = "replace", only: str | None = None) -> list[str]:
    """Write ``df`` in folders by ``keys`` and put them in force together.

    ``mode``: "replace" puts the written parts in the place of the same parts before,
    other parts stay; "append" adds to them; "overwrite" leaves the written parts only.
    ``only``: the one part (``key=value/...``) that all rows belong to; it is written, and replaced,
    also when there are no rows. Returns the parts.
    """
    if mode not in ("replace", "append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    spark, version = df.sparkSession, uuid.uuid4().hex
    files = _Files(spark, root)
    folder = f"{DATA}/version={version}"
    if only is not None:
        df.write.parquet(f"{files.root}/{folder}/{only}")
        written = [only]
    else:
        df.write.partitionBy(*keys).parquet(f"{files.root}/{folder}")
        written = _parts(files, folder, keys)
    commit(spark, root, {p: [version] for p in written}, mode)
    return written


def commit(spark: SparkSession, root: str, written: dict[str, list[str]], mode: str = "replace") -> None:
    """Add the manifest that puts ``written`` in force."""
    files = _Files(spark, root)
    files.fs.mkdirs(files.path(MANIFEST))
    for _ in range(TRIES):
        number = max(_numbers(files), default=0)
        parts = json.loads(files.read(f"{MANIFEST}/{number:010d}.json"))["parts"] if number else {}
        if mode == "append":
            new = {**parts, **{p: parts.get(p, []) + v for p, v in written.items()}}
        else:
            new = dict(written) if mode == "overwrite" else {**parts, **written}
        if files.add(f"{MANIFEST}/{number + 1:010d}.json", json.dumps({"parts": new}, sort_keys=True)):
            return
    raise RuntimeError(f"other writers kept publishing to {root}")


def read_published(spark: SparkSession, root: str, parts: Iterable[str] | None = None) -> DataFrame | None:
    """The published rows, or those of some parts; None where nothing was published
    or none of the parts exists. The keys are columns."""
    known = manifest(spark, root)
    if known is None:
        return None
    data = f"{root.rstrip('/')}/{DATA}"
    wanted = known if parts is None else [p for p in parts if p in known]
    paths = [f"{data}/version={v}/{p}" for p in wanted for v in known[p]]
    if not paths:
        return None
    return spark.read.option("basePath", data).parquet(*paths).drop("version")


def clean(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete manifests but the last ``keep`` and the versions that none of these
    names. For times without a running writer; readers of kept manifests are safe.
    Returns the deleted versions."""
    files = _Files(spark, root)
    numbers = _numbers(files)
    named = {v for n in numbers[-keep:] for vs in json.loads(files.read(f"{MANIFEST}/{n:010d}.json"))["parts"].values()
             for v in vs}
    for n in numbers[:-keep]:
        files.delete(f"{MANIFEST}/{n:010d}.json")
    gone = [v for v in (n.removeprefix("version=") for n in files.names(DATA)) if v not in named]
    for v in gone:
        files.delete(f"{DATA}/version={v}")
    return gone
