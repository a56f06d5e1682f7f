"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as E
from ringfence.plans import registry
from tools.check_oracle import TABLES, canon

from paths import SF_SMALL

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("qid", sorted(SQL))
def test_query_matches_oracle(spark, con, qid):
    df = E.queries()[qid](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(SQL[qid])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert canon(cols, rows) == canon(ocols, orows)


def test_registry_consistency():
    qs = registry.queries()
    assert set(qs) <= set(E.queries())
    assert set(SQL) <= set(qs)
    missing = sorted(set(qs) - set(SQL))
    assert missing == [], missing


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "alert_type" in df.columns
