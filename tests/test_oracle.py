"""Every SQL-checked query equals its DuckDB oracle (sf0.001, whole tables)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from lacuna.plans import catalog
from lacuna.sources.tables import TABLES

# the training-data operators have their own oracle test beside their other tests
SQL = catalog.oracle_sql()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ("~",)
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return ("f", v)
    if isinstance(v, pd.Timestamp):
        return ("t", v.isoformat())
    return ("s", str(v))


def _rows(pdf):
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pd.notna(pdf[cols]), None)
    return cols, sorted((tuple(_norm(v) for v in r) for r in pdf.itertuples(index=False)),
                        key=lambda t: tuple((x[0], round(x[1], 4) if x[0] == "f" else x[1:])
                                            for x in t))


def _same(a, b):
    if a == b:
        return True
    if a[0] == "f" and b[0] == "f":
        return abs(a[1] - b[1]) <= 1e-6 * max(1.0, abs(a[1]), abs(b[1]))
    return False


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(name, spark, duck, sf_small):
    sp = E.queries()[name](spark, sf_small).toPandas()
    dk = duck.execute(SQL[name]).df()
    c1, r1 = _rows(sp)
    c2, r2 = _rows(dk)
    assert c1 == c2
    assert len(r1) == len(r2)
    for x, y in zip(r1, r2):
        assert all(_same(a, b) for a, b in zip(x, y)), (x, y)
