"""Every registered query against its DuckDB statement, plus the entry smoke check."""

from oracle_compare import compare

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "rebalancing_priority_score" in df.columns


def test_all_queries_match_oracle(spark):
    from dockstat.plans.catalog import QUERIES
    res = compare(spark, SF, sorted(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if not v.startswith("ok")}
    assert not bad, bad
