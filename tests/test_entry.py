"""Driver contract: entry() runs; every registered query equals its SQL check (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as E
from valuescope.plans import catalog

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
SF = "/root/testdata/sf0.001"


def _norm(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = []
    for r in rows:
        t = []
        for i in order:
            v = r[i]
            t.append((0, "") if v is None else (1, round(v, 9)) if isinstance(v, float) else (2, str(v)))
        out.append(tuple(t))
    return sorted(out)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "token", "count"]
    assert df.count() > 0


def test_every_query_has_sql_or_is_rows_only():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert set(catalog.QUERIES) <= set(q) and set(catalog.SQL) <= set(s)
    assert set(catalog.QUERIES) == set(catalog.SQL)  # every query of the library has its SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _reads_given_tables(df) -> bool:
    plan = df._jdf.queryExecution().executedPlan().toString()
    # a scan of the shared tables, or of tables Spark derived from them in the scratch folder
    return SF in plan or "valuescope-" in plan


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF)
    assert _reads_given_tables(df), name
    res = duck.execute(E.oracle_sql()[name])
    d_names = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(d_names)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), d_names)
