"""Every query with SQL gives the SQL's rows, on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from strandwork.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return None
    return float(f"{value:.10g}") if isinstance(value, float) else value


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(map(plain, r)) for r in frame.itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", list(SQL))
def test_query_against_sql(spark, duck, name):
    got, wanted = QUERIES[name](spark, SF).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert rows(got) == rows(wanted)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_query_runs_twice_alike(spark, name):
    a, b = (rows(QUERIES[name](spark, SF).toPandas().map(lambda v: str(v) if hasattr(v, "__len__") else v)) for _ in range(2))
    assert a and a == b


def test_entry_module_imports():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
