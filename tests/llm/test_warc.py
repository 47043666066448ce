import gzip
import io
from collections import defaultdict

from pyspark.sql import functions as F

from tapeworks.llm import warc as W
from tapeworks.session import scratch_path

SCHEMA = "page_id long, url string, html string"


def written(spark, rows, **kw):
    root = scratch_path(spark, "warc-test")
    root = root if "://" in root or root.startswith("file:") else "file://" + root
    df = spark.createDataFrame(rows, SCHEMA).withColumn("digest", F.lit("x")).withColumn("page", F.lit(1))
    manifest = W.write(df, root, **kw)
    return root, manifest, W.read(manifest, root).collect()


ROWS = [(1, "http://a/\r\nX: 1", "same"), (2, None, "same"), (3, "http://ü/", None), (4, "u", ""),
        (5, "u", "own é"), (6, "http://a/", "same"), (None, "u", "same"), (7, "u", "same\n"),
        (8, "u", "x" * 100_000)]


def test_round_trip_and_revisits(spark):
    _, _, got = written(spark, ROWS, shard_bytes=50)
    by = defaultdict(list)
    for i, u, h in ROWS:
        by[h or ""].append(i if i is not None else W.NO_ID)
    assert len(got) == len(ROWS)
    for r in got:
        html = next(h or "" for i, u, h in ROWS if i == r.page_id)
        first = min(by[html])
        me = r.page_id if r.page_id is not None else W.NO_ID
        assert r.payload_bytes == len(html.encode()) and r.payload_digest == W.base32_sha1(html.encode())
        assert (r.record_type, r.refers_to) == (("response", None) if me == first else ("revisit", first))
        assert (r.payload is None) == (me != first) and (me != first or bytes(r.payload) == html.encode())
        assert "\n" not in r.url and "\r" not in r.url


def test_same_bytes_however_the_rows_are_dealt(spark):
    a = written(spark, ROWS[:5], shard_bytes=50)[1]
    b = written(spark, ROWS[:5][::-1], shard_bytes=50)[1]
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_files_roll_by_compressed_size_and_only_listed_ones_are_read(spark):
    import os
    rows = [(i, "u", f"{i} {os.urandom(200).hex()}") for i in range(50)]
    root, manifest, got = written(spark, rows, roll_bytes=2000)
    files = manifest.collect()
    assert len(files) > 5 and all(f.bytes < 3000 for f in files) and sum(f.records for f in files) == 50
    folder = root.removeprefix("file:").replace("///", "/")
    assert not [f for f in os.listdir(folder) if f.startswith("_temporary")]
    with open(f"{folder}/pages-stray-00000.warc.gz", "wb") as f:
        f.write(b"left by a lost task")
    assert W.read(manifest, root).count() == 50
    for f in files:  # each record is a gzip member of its own
        with open(f"{folder}/{f.file}", "rb") as h:
            data = h.read()
        assert gzip.GzipFile(fileobj=io.BytesIO(data)).read().count(b"WARC/1.1\r\n") == f.records


def test_small_payloads_are_all_responses(spark):
    got = written(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], least_bytes=3)[2]
    assert sorted((r.page_id, r.record_type) for r in got) == [
        (1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def test_repeated_rows_and_empty_table(spark):
    got = written(spark, [(1, "u", "a"), (1, "u", "a"), (1, "u", "b"), (2, "u", "a")])[2]
    assert sorted((r.page_id, r.record_type, r.refers_to or 0) for r in got) == [
        (1, "response", 0), (1, "response", 0), (1, "revisit", 1), (2, "revisit", 1)]
    assert written(spark, [])[2] == []


def test_record_ids_are_unique_and_no_record_refers_to_itself(spark):
    rows = [(1, "u", "a")] * 4 + [(2, "u", "a")] * 2 + [(None, "u", "a"), (None, "u", "b"), (None, "u", "b")]
    root, manifest, _ = written(spark, rows)
    folder = root.removeprefix("file:").replace("///", "/")
    heads = []
    for f in manifest.collect():
        with open(f"{folder}/{f.file}", "rb") as h:
            heads += [h for h, _ in W.records_of(h.read())]
    ids = [h["WARC-Record-ID"] for h in heads]
    assert len(ids) == len(rows) == len(set(ids))
    responses = {h["WARC-Record-ID"] for h in heads if h["WARC-Type"] == "response"}
    refers = [h["WARC-Refers-To"] for h in heads if h["WARC-Type"] == "revisit"]
    assert len(responses) == 2 and set(refers) <= responses


def test_ranges_follow_bytes_and_not_ids(spark):
    import random
    rng = random.Random(1)
    sparse = [(rng.randrange(1 << 60), "u", "x" * 100 + str(i)) for i in range(200)]
    root, manifest, got = written(spark, sparse, shard_bytes=6000)
    files = sorted(manifest.collect())
    assert 3 <= len(files) <= 4 and sum(f.records for f in files) == 200
    missing = [(None, "u", f"page {i} " + "x" * 100) for i in range(200)]
    assert len(written(spark, missing, shard_bytes=6000)[1].collect()) >= 3
    # Files in the order of their names hold records in the order of their ids.
    folder, seen = root.removeprefix("file:").replace("///", "/"), []
    for f in files:
        with open(f"{folder}/{f.file}", "rb") as h:
            seen += [W.page_of(h["WARC-Record-ID"]) for h, _ in W.records_of(h.read())]
    assert seen == sorted(i for i, _, _ in sparse)


def test_schemes():
    import pytest
    with pytest.raises(Exception):
        W._folder("nosuchscheme://bucket/x")
    assert W._SCHEMES["s3a"] == "s3"
