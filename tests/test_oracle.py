"""Every registered query against its DuckDB oracle on the smallest test tables."""

import pytest

from __spark_entry__ import oracle_sql, queries

QUERIES = queries()
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con(small_dir):
    from tools.check_oracle import duck
    return duck(small_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, small_dir, con, name):
    from tools.check_oracle import compare
    r = compare(spark, name, QUERIES[name], ORACLES.get(name), small_dir, con)
    assert r["status"] in ("ok", "no-oracle"), r


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "quality_win_loss_score" in df.columns
