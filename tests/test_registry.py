"""Every registered query against its DuckDB oracle at sf0.001 (the driver uses sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from basketry.sources.starschema import TABLES

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return v.isoformat() if hasattr(v, "isoformat") else v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(str(_norm(r[i])) for i in order) for r in rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "favorite_category" in df.columns


def test_every_query_has_an_oracle():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 70


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(df.columns, df.collect()) == _bag(dcols, res.fetchall())
