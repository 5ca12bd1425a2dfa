"""Every registered query against its SQL, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import TABLES, df_rows, rows_of  # noqa: E402

# The optional training-data queries have tests of their own.
QUERIES, ORACLES = entry.catalog.QUERIES, entry.catalog.ORACLES


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, db, name):
    got = QUERIES[name](spark, small).toPandas()
    assert len(got) > 0
    if name in ORACLES:
        wanted = db.sql(ORACLES[name])
        assert sorted(got.columns) == sorted(wanted.columns)
        assert rows_of(list(got.columns), df_rows(got)) == rows_of(wanted.columns, wanted.fetchall())


def test_entry(spark, small):
    assert entry.entry(spark).count() > 0


def test_entry_offers_all_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_queries_without_sql():
    assert set(QUERIES) - set(ORACLES) == {"text_search_dense", "stored_search_recall", "latent_recall"}
