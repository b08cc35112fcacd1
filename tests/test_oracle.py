"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

import datetime as dt
import math
import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Spark type -> DuckDB type of the same values
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return "\0"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rows)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["User_Count", "Medical_Codes", "Message_Count", "Avg_Msg_per_User"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    dtypes = {d[0]: str(d[1]).upper() for d in cur.description}
    for f in df.schema.fields:
        assert SAME_TYPE[f.dataType.simpleString()] == dtypes[f.name], (f.name, f.dataType, dtypes[f.name])
    assert _rows(df.columns, df.collect()) == _rows(dcols, cur.fetchall())


def test_every_query_has_a_name_and_runs(spark):
    for name, fn in E.queries().items():
        assert fn(spark, SF).schema is not None, name
