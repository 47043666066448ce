"""Driver contract: entry smoke and every registered query against its
DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["trade_dt", "symbol", "exchange", "event_tm", "prior_trade_pr",
                          "prior_mov_avg_trade_pr", "prior_close_trade_pr"]


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, name):
    from compare import run
    res = run(spark, "/root/testdata/sf0.001", [name], verbose=False)[name]
    assert res[0] is True, res
