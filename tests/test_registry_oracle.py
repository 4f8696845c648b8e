"""Every registered query that SQL can express against DuckDB on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from sitelens.plans.registry import all_reports

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.oracle_sql())
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_report_has_an_oracle():
    assert all(sql for _, sql in all_reports().values())
    assert set(all_reports()) <= set(E.queries()) & set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["state", "site_count", "avg_performance", "avg_accessibility"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_report_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    si = [df.columns.index(c) for c in cols]
    di = [rel.columns.index(c) for c in cols]
    got = sorted((tuple(_norm(r[i]) for i in si) for r in df.collect()), key=repr)
    want = sorted((tuple(_norm(r[i]) for i in di) for r in rel.fetchall()), key=repr)
    assert got == want


def _same(df, rel):
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    si = [df.columns.index(c) for c in cols]
    di = [rel.columns.index(c) for c in cols]
    got = sorted((tuple(_norm(r[i]) for i in si) for r in df.collect()), key=repr)
    want = sorted((tuple(_norm(r[i]) for i in di) for r in rel.fetchall()), key=repr)
    assert got == want


def test_distributed_numbering_on_driver_data(spark):
    """The range-partitioned numbering gives the
    same ranking and quarantine ids as the SQL oracle on the sf0.01 tables."""
    from sitelens.operators import quarantine as Q
    from sitelens.operators import ranking as R
    from sitelens.sources import proxy as P
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    _same(R.site_ranking(P.summaries(spark, sf)),
          con.sql(E.oracle_sql()["site_ranking"]))
    st = P.quarantine_steps(spark, sf)
    _same(Q.update_quarantine(P.audits(spark, sf), st["rows1"], st["t2"]),
          con.sql(E.oracle_sql()["quarantine_update"]))
