"""Every query with an oracle matches DuckDB on the same Parquet tables
(columns, row count, order-insensitive value hash). The driver's check runs
at sf0.01 (``python tests/oracle_compare.py``); here the smallest scale keeps
the suite fast."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.oracle_compare import compare

ORACLE = oracle_sql()
QUERIES = queries()


def test_every_query_is_registered_with_a_callable():
    assert len(QUERIES) >= 45
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    info = compare(spark, duck, name, QUERIES[name], ORACLE[name], sf_dir)
    assert info["cols"], info
    assert info["rows"][0] == info["rows"][1], info
    assert info["hash"], info
    assert "types" not in info, info


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() >= 0
    assert "month_interval" in df.columns


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_query_runs(spark, sf_dir, name):
    """Queries without an SQL equivalent (models, seeded sample) run end to
    end and return rows."""
    assert QUERIES[name](spark, sf_dir).count() > 0
