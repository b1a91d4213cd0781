"""Every registered query against its DuckDB oracle (order-insensitive), as the
driver does, on the smallest data set; plus the entry() smoke check."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from bizlens.plans.registry import QUERIES
from bizlens.sources.tables import DRIVER_TABLES

from conftest import SF001


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "as_tuple"):
        return round(float(v), 9)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1 and df.columns == ["category", "revenue", "order_count", "pct_of_total"]


def test_every_query_has_oracle_or_reason():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert missing == set(), missing


SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                 "DateType": "DATE", "BooleanType": "BOOLEAN", "TimestampNTZType": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    dcols, dtypes = rel.columns, [str(t) for t in rel.types]
    assert sorted(df.columns) == sorted(dcols)
    stypes = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__)
              for f in df.schema.fields}
    assert stypes == dict(zip(dcols, dtypes))
    assert _rows(df.columns, srows) == _rows(dcols, rel.fetchall())
