"""A2: parquet table scans with declared schemas.

Reads are lazy: Catalyst prunes columns and pushes filters into each scan.  Each table's columns are declared below.
A table whose footer lacks a declared column or has it in another type raises ``SchemaDrift`` when it is opened,
before any job runs; narrower numbers are widened to the declared type, further columns stay.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


# The declared columns of each table.
DECLARED = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


class SchemaDrift(ValueError):
    """A table's columns aren't the declared ones."""


def declared_schema(name: str) -> T.StructType:
    """The declared columns of a table."""
    return T.StructType.fromDDL(DECLARED[name])


def _widens(found: T.DataType, wanted: T.DataType) -> bool:
    """Whether every value of ``found`` is a value of ``wanted``."""
    whole = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    if found in whole and wanted in whole:
        return whole.index(found) < whole.index(wanted)
    return found == T.FloatType() and wanted == T.DoubleType()


def conform(df: DataFrame, schema: T.StructType, name: str = "table") -> DataFrame:
    """``df`` with the declared types; raises ``SchemaDrift`` with all faults at once."""
    found, faults, casts = {f.name: f.dataType for f in df.schema}, [], {}
    for f in schema:
        if f.name not in found:
            faults.append(f"{f.name} is missing")
        elif found[f.name] != f.dataType:
            if _widens(found[f.name], f.dataType):
                casts[f.name] = F.col(f"`{f.name}`").cast(f.dataType)
            else:
                faults.append(f"{f.name} is {found[f.name].simpleString()}, declared {f.dataType.simpleString()}")
    if faults:
        raise SchemaDrift(f"{name}: " + "; ".join(faults))
    return df.withColumns(casts) if casts else df


def read_table(spark: SparkSession, sf_dir: str, name: str, every_file: bool = False) -> DataFrame:
    """Lazy parquet scan of one driver table, checked against its declared schema.

    The check uses the footer that Spark reads in any case; with ``every_file`` the footers of all files are
    merged (a Spark job over the files), so that one differing file is found, too.
    """
    df = spark.read.option("mergeSchema", every_file).parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return conform(df, declared_schema(name), name) if name in DECLARED else df


class Tables(dict):
    """Lazy mapping name -> DataFrame; a table is only opened when used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark = spark
        self.sf_dir = sf_dir

    def __missing__(self, name: str) -> DataFrame:
        df = read_table(self.spark, self.sf_dir, name)
        self[name] = df
        return df


def load_tables(spark: SparkSession, sf_dir: str, register_views: bool = False) -> Tables:
    """A2: lazy mapping of every driver table (optionally registered as temp views)."""
    tables = Tables(spark, sf_dir)
    if register_views:
        for name in DRIVER_TABLES:
            tables[name].createOrReplaceTempView(name)
    return tables
