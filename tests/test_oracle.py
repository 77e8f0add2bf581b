"""Every registered query with oracle SQL equals DuckDB on the smallest fixture."""

import duckdb
import pytest

import __spark_entry__ as E
from narrata.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tools.compare import canon, schema

SLOW = {"train_classifier", "model_family_compare", "cross_validate", "classifier_reload"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = canon(df.collect())
    rel = con.execute(E.oracle_sql()[name])
    assert schema((d[0], d[1]) for d in rel.description) == schema(df.dtypes)
    assert got == canon(rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql()) - SLOW))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() >= 0
