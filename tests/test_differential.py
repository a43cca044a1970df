"""Every registered query against its SQL twin in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from recordlens.sources.testdata import TABLES
from tests.conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    """All record operators; of the training-data operators only what SQL can express."""
    from recordlens.registry import load_all
    assert set(load_all()) <= set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["inventor_id", "name", "country", "patent_count"]


SPARK_TO_DUCK = {"StringType": "VARCHAR", "LongType": "BIGINT", "IntegerType": "INTEGER",
                 "DoubleType": "DOUBLE", "BooleanType": "BOOLEAN", "DateType": "DATE"}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[key])
    types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    ours = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__)
            for f in df.schema.fields}
    assert ours == types                                  # same names and column types
    res = duck.execute(ORACLE[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _canon(df.columns, rows) == _canon(dcols, drows)
