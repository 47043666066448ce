import hashlib

import pytest
from helpers import docs

from tapeworks.llm import exact_dedup as D


def brute(rows):
    best, size = {}, {}
    for i, t in rows:
        h = hashlib.sha256((t or "").encode()).hexdigest()
        best[h] = max(best.get(h, (i,)), (i,), key=lambda x: (x[0] is not None, x[0]))
        size[h] = size.get(h, 0) + 1
    return best, size


@pytest.mark.parametrize("heavy", [1, 3, 10**6])
def test_equals_brute_force_whatever_counts_as_heavy(spark, monkeypatch, heavy):
    monkeypatch.setattr(D, "HEAVY_ROWS", heavy)
    rows = [(i, ["hot", None, "", "a b", f"own {i}", "A b"][i % 6 if i > 300 else 0]) for i in range(600)]
    best, size = brute(rows)
    got = D.decide(docs(spark, rows, extra=True)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.keep_id,) == best[r.text_sha256] and r.group_size == size[r.text_sha256]
        assert r.kept == (r.doc_id == r.keep_id)


def test_repeated_rows_keep_exactly_one(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (None, "a"), (3, "b"), (3, "c"), (None, "d")]
    got = D.decide(docs(spark, rows)).collect()
    assert sum(r.kept for r in got if r.group_size == 4) == 1
    kept = D.drop_copies(docs(spark, rows, extra=True)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, "d"), (2, "a"), (3, "b"), (3, "c")]


def test_null_and_empty_texts_of_one_id(spark):
    rows = [(1, None), (1, ""), (2, "x"), (2, "x"), (None, None)]
    kept = D.drop_copies(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == [(1, ""), (2, "x")]


def test_the_same_row_stays_whatever_the_order(spark):
    df = spark.createDataFrame([(1, "a", "z"), (1, "a", "b"), (1, "a", None)], "doc_id long, text string, lang string")
    assert {D.drop_copies(df.repartition(n)).first().lang for n in (1, 2, 3)} == {"z"} or \
        len({D.drop_copies(df.repartition(n)).first().lang for n in (1, 2, 3)}) == 1


def test_empty_table(spark):
    assert D.decide(docs(spark, [])).count() == 0
    assert D.drop_copies(docs(spark, [])).count() == 0


def test_heavy_digests_are_named(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}") for i in range(3000)]
    heavy = D.heavy_digests(D._digests(docs(spark, rows), "doc_id", "text")).collect()
    assert [(r.heavy_id, r.heavy_n) for r in heavy] == [(2997, 1000)]


def test_no_python_in_the_plan(spark):
    plan = D.decide(docs(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan
