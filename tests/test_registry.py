"""Driver contract: entry() runs, every query matches its DuckDB oracle (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from pricestream.plans import oracle, queries
from pricestream.sources.tables import TABLES

from conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["event_seq", "product_id", "demand", "new_price", "update_ts"]
    assert df.count() > 0


def _canon(pdf):
    cols = sorted(pdf.columns)
    def norm(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        if isinstance(v, float):
            return round(v, 9)
        if hasattr(v, "to_pydatetime"):
            return v.to_pydatetime()
        if hasattr(v, "item"):
            v = v.item()
            return round(v, 9) if isinstance(v, float) else v
        return v
    rows = sorted((tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)
    return cols, rows


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_key_has_oracle_or_is_listed():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert set(queries.registry()) == set(oracle.oracle_sql()) <= set(qs)


@pytest.mark.parametrize("key", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    sp = E.queries()[key](spark, SF001).toPandas()
    dk = duck.execute(E.oracle_sql()[key]).df()
    c1, r1 = _canon(sp)
    c2, r2 = _canon(dk)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2
