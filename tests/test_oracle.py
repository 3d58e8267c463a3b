"""Every registered query against its DuckDB SQL on the smallest tables
(row count, column names, order-insensitive value hash)."""

import duckdb
import pytest

import __spark_entry__ as E
from quire.plans.catalog import QUERIES
from tools.compare import TABLES, digest

from support import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    exp = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(exp)
    assert digest(df.columns, got)[0] == digest(rel.columns, exp)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["qid", "pred", "conv_id", "turn"]
    assert df.count() > 0
