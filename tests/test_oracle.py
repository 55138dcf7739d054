"""Every batch query with an oracle: Spark result == DuckDB result on the
small driver tables (row count, column names, order-insensitive values)."""

import math

import duckdb
import pandas as pd
import pytest

from topicflow.plans import catalog
from topicflow.sources.driver import TABLES

from conftest import SMALL

NAMES = sorted(n for n in catalog.QUERIES if n in catalog.ORACLE_SQL)


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if hasattr(v, "isoformat"):
        t = pd.Timestamp(v)
        return (t.tz_localize(None) if t.tzinfo else t).isoformat()
    return str(v)


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted("|".join(_norm(r[c]) for c in cols) for r in df[cols].to_dict("records"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    got = catalog.QUERIES[name](spark, SMALL).toPandas()
    exp = duck.execute(catalog.ORACLE_SQL[name]).df()
    gc, gr = _rows(got)
    ec, er = _rows(exp)
    assert gc == ec
    assert len(gr) == len(er)
    assert gr == er
