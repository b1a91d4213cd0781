"""Helpers shared by the operators: table scans, tables in the shared scratch folder, ASCII words."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.sources.scratch import materialize, materialize_apart, scratch_space, ship_package
from bizlens.sources.scratch import shared_path as scratch_path

__all__ = ["SPACES", "id_type", "let", "materialize", "materialize_apart", "materialize_by", "running", "running_sums", "scratch_path",
           "scratch_space", "ship_package", "table", "text_or_empty"]

#: Separators of words, as in ``[^\x20\x09-\x0D]+``; ``bytes.split()`` splits on the same six bytes.
SPACES = "\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize_by(df: DataFrame, what: str, key: str, buckets: int) -> DataFrame:
    """As ``materialize``, with the rows' places laid down by ``key``: joins and groupings on it that use
    ``buckets`` partitions don't move the rows again.  The catalog's entry is gone at once; the files stay."""
    spark = df.sparkSession
    path = scratch_path(spark, what)
    name = f"bizlens_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    out = spark.table(name).select("*")
    spark.sql(f"DROP TABLE {name}")
    return out


def text_or_empty(col: str = "text") -> Column:
    """Null text counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def id_type(df: DataFrame, col: str = "doc_id") -> str:
    """SQL type of an id column, for the schemas of Arrow maps."""
    return df.schema[col].dataType.simpleString()


def let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, join, first: Column) -> Column:
    """Running results of ``join`` over an array of numbers (from ``first``), in two levels of blocks of
    about the root of its length: lists that grow by appending stay short."""
    empty = F.array().cast("array<bigint>")

    def one(block: Column, start: Column) -> Column:
        return F.aggregate(block, F.struct(start.alias("at"), empty.alias("all")),
                           lambda d, x: let(join(d["at"], x), lambda y: F.struct(y.alias("at"), F.concat(d["all"], F.array(y)).alias("all"))), lambda d: d["all"])

    def run(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), (F.size(v) - 1).cast("int"), width), lambda i: one(F.slice(v, i + 1, width), first))
        # what stands before each block
        return let(blocks, lambda bs: let(F.concat(F.array(first), one(F.transform(bs, lambda x: F.element_at(x, -1)), first)),
                                            lambda before: F.flatten(F.transform(bs, lambda x, i: F.transform(x, lambda y: join(F.get(before, i), y))))))

    return let(values, lambda v: F.when(F.size(v) == 0, empty).otherwise(run(v)))


def running_sums(values: Column) -> Column:
    """Running sums of an array of longs."""
    return running(values, lambda a, b: a + b, F.lit(0).cast("long"))
