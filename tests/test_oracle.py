"""Every registered query against its DuckDB oracle (row count, column names, value hash)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from lakelens.plans import queries, stored_queries, streaming_queries
from oracle_check import run

KEYS = sorted([*queries.QUERIES, *stored_queries.QUERIES, *streaming_queries.QUERIES])


@pytest.fixture(scope="module")
def results(spark):
    return run(SF_SMALL, KEYS, spark=spark, verbose=False)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(results, key):
    status = results[key][0]
    if key in entry.oracle_sql():
        assert status == "match", results[key]
    else:
        assert status == "rows_only", results[key]


def test_every_query_has_oracle_or_is_documented():
    rows_only = set(KEYS) - set(entry.oracle_sql())
    assert not rows_only


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["upload_date", "image_count", "total_size_mb"]
    assert df.count() > 0
