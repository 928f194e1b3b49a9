"""The driver contract: entry() smoke run, and every registered query against its DuckDB oracle
on the smallest driver tables (the driver itself compares at sf0.01)."""

import datetime as dt
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as se

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item") and not hasattr(v, "to_pydatetime"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, dt.date) and not isinstance(v, dt.datetime):
        return dt.datetime(v.year, v.month, v.day)
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "has_enough_games" in df.columns and len(df.columns) == 42


def test_every_query_has_oracle_or_is_declared_non_sql():
    q, sql = se.queries(), se.oracle_sql()
    assert {k for k in set(q) - set(sql) if k.startswith("q_")} == set(se.NON_SQL)
    assert set(sql) <= set(q)


_DUCK_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(se.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF)
    sql = se.oracle_sql()[name]
    spark_types = {f.name: _DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert spark_types == duck_types
    sdf = df.toPandas()
    ddf = duck.execute(sql).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    assert _rows(sdf) == _rows(ddf)


def test_entry_without_the_training_data_subpackage(monkeypatch):
    """Where the subpackage is not installed, the other queries and their SQL are all there."""
    find = se.importlib.util.find_spec
    monkeypatch.setattr(se.importlib.util, "find_spec", lambda n, *a: None if n == "plyscope.llm" else find(n, *a))
    assert set(se.queries()) == set(se.catalog.QUERIES) == set(se.oracle_sql())
