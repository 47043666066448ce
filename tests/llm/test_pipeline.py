"""The pipeline over the smallest tables, stage by stage, against brute force."""

import hashlib

import __spark_entry__ as E
import corpus_pipeline
import pytest
from compare import run as compare
from helpers import brute_components

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    items = [r.text for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    rows = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, spark.createDataFrame(docs.collect(), docs.schema), DIR)
        if name == "best_fit_packing":
            assert {r.doc_id for r in out.collect()} == set(rows)
            break
        assert out.columns == columns
        kept = {r.doc_id: r.text for r in out.collect()}
        if name == "language_id":
            assert kept == rows
        elif name == "exact_dedup":
            last = {}
            for i in sorted(rows):
                last[hashlib.sha256(rows[i].encode()).digest()] = i
            assert set(kept) == set(last.values())
        elif name == "ngram_jaccard_join":
            assert set(kept) == {i for i, c in brute_components(rows).items() if i == c}
        else:
            assert set(kept) == {i for i, t in rows.items() if not any(x in t for x in items)}
        rows, docs = kept, spark.createDataFrame(out.collect(), out.schema)


@pytest.mark.parametrize("name", ["op3_exact_dedup", "op7_chat_format", "op8_warc"])
def test_sql(spark, name):
    assert compare(spark, DIR, [name], verbose=False)[name][0] is True


def test_every_operator_is_registered():
    names = [n.split("_")[0] for n in E.queries()]
    assert all(names.count(f"op{i}") == 1 for i in range(1, 11)) and "pipeline" in names
