"""Every registered query against its DuckDB oracle on the smallest
fixture tables (the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import digest
from tests.conftest import SF_SMALL

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from marketlens.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(rows, df.columns)[0] == digest(drows, dcols)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.collect()) >= 0 and "category" in df.columns


def test_topics_rows_only(spark):
    t = QUERIES["topics"](spark, SF_SMALL)
    rows = t.collect()
    if rows:
        per = {}
        for r in rows:
            per.setdefault(r.topic_id, []).append(r.term)
        assert all(len(v) == 8 for v in per.values())
