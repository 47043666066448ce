"""Deterministic sharded WARC archives: writer and reader.

Records are range-sorted by page id and payload digest: the ranges come from a sketch of
these keys (:func:`tapeworks.operators.ordered.key_bounds`), as many as the payloads'
bytes fill, so sparse, repeated and missing ids make no shard of their own. A range is
written by one task as a row of ``.warc.gz`` files, a new one begun as soon as the
compressed size reaches ``roll_bytes``. Every record is its own gzip member with a fixed
time stamp, its headers and digests made from its content, so the same rows give the
same bytes whatever the cluster. Of records of equal payload the one with the smallest
page id is a response, the others are revisits that refer to it and carry no payload.
A record's id is made from page id, digest and the row's number among equal ones, so no two
records share one.

Commit: a task writes files under temporary names of its own and gives each its final
name, which holds the digest of its bytes, when it is complete; a repeated or speculative
task finds the name taken by the same bytes and drops its own. The manifest (file,
records, bytes, SHA-1) is a table written last; a reader opens only what the manifest
lists and checks size and digest; temporary files of lost tasks are deleted then. Files
go through ``pyarrow.fs``; a folder whose scheme it does not take fails before the job.

Payloads travel once: decisions, which hold no payload, meet their rows inside
the writing task, where both are sorted by page id and digest. Equal payloads are
found by partial aggregates over digests, so a payload that a third of all pages
share is counted where it is read.

Defined cases: NULL html is an empty payload; a NULL url is written as
``about:blank``; characters a header can't hold are percent-encoded; a NULL page
id sorts behind all others and never is the response of others; of rows with
equal page id and payload one is the response and the rest revisit it; rows with
equal page ids and different payloads are records each. An empty table gives no
file and an empty manifest. Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tapeworks.llm.common import columns_of, keep_table, small_batches
from tapeworks.operators.ordered import range_ordered

#: Payload bytes of one range (about), compressed bytes of one file, smallest payload revisited.
SHARD_BYTES, ROLL_BYTES, LEAST_BYTES = 64 << 20, 32 << 20, 0
#: Records have no capture time; all bear this one.
DATE = "1970-01-01T00:00:00Z"
#: Stands for a NULL page id.
NO_ID = (1 << 63) - 1

_MANIFEST = "file string, records long, bytes long, sha1 string"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int, digest: str, nth: int = 0) -> str:
    """A UUID whose low half is the page id; ``nth`` numbers rows of equal page and payload."""
    high = int.from_bytes(hashlib.sha1(f"{page_id}/{digest}/{nth}".encode()).digest()[:8], "big")
    return f"<urn:uuid:{uuid.UUID(int=high << 64 | page_id & (1 << 64) - 1)}>"


def page_of(warc_id: str) -> int | None:
    low = uuid.UUID(warc_id.removeprefix("<urn:uuid:").removesuffix(">")).int & (1 << 64) - 1
    low -= (low >> 63) << 64
    return None if low == NO_ID else low


def record(page_id: int, url: str | None, payload: bytes, refers_to: int | None, nth: int = 0) -> bytes:
    """One gzip member; a revisit if ``refers_to`` is a page id."""
    digest = base32_sha1(payload)
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else "about:blank"
    block = _HTTP + (payload if refers_to is None else b"")
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"),
               ("WARC-Record-ID", record_id(page_id, digest, nth)), ("WARC-Date", DATE),
               ("WARC-Target-URI", target),
               ("WARC-Payload-Digest", f"sha1:{digest}"),
               ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
               ("X-Payload-Length", str(len(payload)))]
    if refers_to is not None:
        headers += [("WARC-Refers-To", record_id(refers_to, digest)),
                    ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/"
                                     "identical-payload-digest")]
    headers += [("Content-Type", "application/http; msgtype=response"),
                ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", mtime=0, filename="", compresslevel=6) as z:
        z.write(text.encode() + block + b"\r\n\r\n")
    return out.getvalue()


#: Hadoop's names of schemes that pyarrow has under others.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _folder(root: str):
    """(file system, path) of a folder named as Hadoop does."""
    from pyarrow import fs

    scheme, found, rest = root.partition(":")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}" if found else root)


class _Shard:
    """The files of one range, written one after another."""

    def __init__(self, root: str, shard: int, roll_bytes: int):
        self.fs, self.root = _folder(root)
        self.shard, self.roll, self.n, self.done = shard, roll_bytes, 0, []
        self.out = None

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.temp = f"{self.root}/_temporary-{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(self.temp)
            self.sha, self.bytes, self.records = hashlib.sha1(), 0, 0
        self.out.write(member)
        self.sha.update(member)
        self.bytes += len(member)
        self.records += 1
        if self.bytes >= self.roll:
            self.commit()

    def commit(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.out = None
        name = f"pages-{self.shard:07d}-{self.n:05d}-{self.sha.hexdigest()[:16]}.warc.gz"
        if self.fs.get_file_info(f"{self.root}/{name}").is_file:
            self.fs.delete_file(self.temp)  # another attempt gave the same bytes this name
        else:
            self.fs.move(self.temp, f"{self.root}/{name}")
        self.done.append((name, self.records, self.bytes, self.sha.hexdigest()))
        self.n += 1


def payloads(pages: DataFrame) -> DataFrame:
    """(page, digest, size, n): the distinct payloads of each page and how many rows have them."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return (pages.select("page", F.sha1(payload).alias("digest"), F.length(payload).alias("size"))
            .groupBy("page", "digest", "size").agg(F.count(F.lit(1)).alias("n")))


def decide(rows: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page, digest, refers_to) of :func:`payloads` that several rows share."""
    rows = rows.where(F.col("size") >= least_bytes)
    first = (rows.groupBy("digest").agg(F.min("page").alias("first"), F.sum("n").alias("all"))
             .where((F.col("all") > 1)))
    return rows.join(first, "digest").select("page", "digest", F.col("first").alias("refers_to"))


def write(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES,
          least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write the archives to ``root`` (a folder all executors reach, with its
    scheme) and the manifest to ``root/manifest``; returns the manifest."""
    spark = pages.sparkSession
    small_batches(spark)
    _folder(root)  # fails here if pyarrow does not know the scheme
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    folder = jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(sc._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    rows = pages.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("page"),
                        F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    known = keep_table(payloads(rows), "payloads")
    size = known.agg(F.sum(F.col("size") * F.col("n"))).first()[0] or 0
    ranges = int(-(-size // shard_bytes)) or 1
    told = decide(known, least_bytes).select(
        "page", "digest", F.lit(0).alias("kind"), "refers_to",
        F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"))
    own = rows.select("page", F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary")).alias("digest"),
                      F.lit(1).alias("kind"), F.lit(None).cast("long").alias("refers_to"), "url", "html")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(root, TaskContext.get().partitionId(), roll_bytes)
        at, first, nth = None, None, 0
        for cols in columns_of(batches, "page", "digest", "kind", "refers_to", "url", "html"):
            for page, digest, kind, refers_to, url, html in zip(*cols):
                if (page, digest) != at:
                    at, first, nth = (page, digest), None, 0
                if kind == 0:
                    first = refers_to
                    continue
                response = first is None or (first == page and nth == 0)
                payload = (html or "").encode("utf-8", "surrogatepass")
                shard.add(record(page, url, payload, None if response else first, nth))
                nth += 1
        shard.commit()
        columns = list(zip(*shard.done)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
            ["file", "records", "bytes", "sha1"])

    dealt = range_ordered(told.unionByName(own), ["page", "digest"], sketched=known, partitions=ranges,
                          order=["page", "digest", "kind", "url"])
    dealt.mapInArrow(put, _MANIFEST).write.mode("overwrite").parquet(f"{root}/manifest")
    for left in files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/_temporary-*")) or []:
        files.delete(left.getPath(), False)
    return spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")


def records_of(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive file's bytes."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(content))
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode().partition(":")
            headers[k.strip()] = v.strip()
        block = stream.read(int(headers["Content-Length"]))
        if "sha1:" + base32_sha1(block) != headers["WARC-Block-Digest"]:
            raise ValueError(f"damaged block of {headers['WARC-Record-ID']}")
        yield headers, block


def read(manifest: DataFrame, root: str) -> DataFrame:
    """One row per record of the files in the manifest: page_id, payload_bytes,
    payload_digest, record_type, refers_to, url, payload (NULL for a revisit)."""
    spark = manifest.sparkSession
    small_batches(spark)
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long, url string, payload binary")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
        names = [f.split()[0] for f in schema.split(", ")]

        def out(rows):
            cols = list(zip(*rows)) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        for contents, sizes, shas in columns_of(batches, "content", "bytes", "sha1"):
            for content, size, sha in zip(contents, sizes, shas):
                if len(content) != size or hashlib.sha1(content).hexdigest() != sha:
                    raise ValueError("an archive file differs from its manifest")
                rows = []
                for h, block in records_of(content):
                    full = h["WARC-Type"] == "response"
                    payload = block.partition(b"\r\n\r\n")[2] if full else None
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    if full and (base32_sha1(payload) != digest
                                 or len(payload) != int(h["X-Payload-Length"])):
                        raise ValueError(f"damaged payload of {h['WARC-Record-ID']}")
                    first = h.get("WARC-Refers-To")
                    rows.append((page_of(h["WARC-Record-ID"]), int(h["X-Payload-Length"]), digest,
                                 h["WARC-Type"], page_of(first) if first else None,
                                 h["WARC-Target-URI"], payload))
                    if len(rows) == 256:
                        yield out(rows)
                        rows = []
                yield out(rows)

    # One archive a batch: a file is the most that a worker holds.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz")
             .schema("path string, modificationTime timestamp, length long, content binary").load(root)
             .select(F.substring_index("path", "/", -1).alias("file"), "content"))
    listed = files.join(manifest.select("file", "bytes", "sha1"), "file")
    return listed.mapInArrow(parse, schema)
