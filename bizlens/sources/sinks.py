"""Sinks.  Writes stay distributed (no ``coalesce(1)``): each task
writes its own part file."""

from __future__ import annotations

import json
import os
import uuid
from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A5: header, ISO dates, no index column."""
    (df.write.mode(mode).option("header", True).option("dateFormat", "yyyy-MM-dd")
       .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def write_partitioned(df: DataFrame, path: str, by: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """One output directory per value of ``by`` (e.g. one per region).

    Rows are clustered by the partition column with a rebalance hint: AQE cuts a
    large value into several tasks of about the advisory size, so one region
    with most of the rows is written by many tasks, and packs small values together.
    """
    (df.hint("rebalance", by).write.mode(mode).partitionBy(by).format(fmt)
       .option("header", True).save(path))


def rewrite_partitions(df: DataFrame, path: str, by: str, fmt: str = "parquet") -> None:
    """A6 again: only the values of ``by`` that stand in ``df`` are replaced; the directories of all other
    values stay as they are.  The new files are moved in when all are written, so a run that dies leaves the old
    ones; a second run gives the same result."""
    (df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by)
       .format(fmt).option("header", True).save(path))


def write_report(tables: Mapping[str, DataFrame], path: str, fmt: str = "parquet", mode: str = "overwrite") -> dict:
    """A bundle of named result tables, one sub-directory each; returns the paths."""
    out = {}
    for name, df in tables.items():
        target = os.path.join(path, name)
        w = df.write.mode(mode).format(fmt)
        if fmt == "csv":
            w = w.option("header", True).option("dateFormat", "yyyy-MM-dd")
        w.save(target)
        out[name] = target
    return out


MANIFEST = T.StructType([T.StructField("version", T.LongType()), T.StructField("table", T.StringType()), T.StructField("folder", T.StringType()),
                         T.StructField("rows", T.LongType()), T.StructField("checksum", T.StringType()), T.StructField("schema", T.StringType())])


def row_digest(df: DataFrame) -> Column:
    """A row's 64-bit hash over all its columns; maps count by their sorted entries."""
    plain = [F.array_sort(F.map_entries(F.col(f"`{f.name}`"))) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    return F.xxhash64(*plain)


def checksum(df: DataFrame) -> list[Column]:
    """Aggregates ``rows`` and ``checksum`` of a table: the same for every order of its rows."""
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_digest(df).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum")]


def publish_bundle(tables: Mapping[str, DataFrame], path: str) -> int:
    """A7, all or nothing: the tables go to a fresh folder, are read back and counted, and only then a
    manifest names them (rows, checksum, schema), as one new row group of the bundle.

    A write that dies half-way has no manifest entry: readers go on with the last version that has all
    its tables.  Returns the version.  One writer at a time.
    """
    spark = next(iter(tables.values())).sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    entries = None
    for name, df in tables.items():
        target = f"{path}/{folder}/{name}"
        df.write.parquet(target)
        written = spark.read.schema(df.schema).parquet(target)  # what stands on disk, not what was meant
        entry = written.agg(*checksum(written)).select(F.lit(name).alias("table"), F.lit(f"{folder}/{name}").alias("folder"), "rows", "checksum",
                                                       F.lit(df.schema.json()).alias("schema"))
        entries = entry if entries is None else entries.unionByName(entry)
    version = latest_version(spark, path) + 1
    # all entries in one file: it appears whole or not at all
    entries.withColumn("version", F.lit(version).cast("long")).select(*MANIFEST.names).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return version


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The bundle's entries of all versions, one row per version and table; empty where there is no bundle."""
    spark.createDataFrame([], MANIFEST).write.mode("append").parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def latest_version(spark: SparkSession, path: str) -> int:
    """The last version of a bundle; 0 where there is none."""
    return manifest(spark, path).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def read_bundle(spark: SparkSession, path: str, version: int | None = None, verify: bool = False) -> dict[str, DataFrame]:
    """The tables of a version (the last one), by name, with the schemas they were written with.

    ``verify`` counts and adds up every table again and raises if one isn't what the manifest says.
    """
    version = latest_version(spark, path) if version is None else version
    found = {}
    for e in sorted(manifest(spark, path).where(F.col("version") == version).collect()):  # a row a table
        df = spark.read.schema(T.StructType.fromJson(json.loads(e.schema))).parquet(f"{path}/{e.folder}")
        if verify:
            now = df.agg(*checksum(df)).first()
            if (now.rows, now.checksum) != (e.rows, e.checksum):
                raise ValueError(f"table {e.table} of version {version} is not what was written")
        found[e.table] = df
    return found
