"""Profiles.

* ``folder_profile`` / ``folder_column_profile``: every table file in the data
  folder (rows, columns, numeric columns, min / max / average, TOTAL line).
* ``document_profile`` / ``document_column_profile`` / ``document_preview``: the
  CSV profiler over the lines of every stored document (a document is a file).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import folder as FO


def table_paths(spark: SparkSession, folder: str) -> list[str]:
    """The parquet tables of a folder by name (one entry per table, whatever its part files)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(st.getPath().toString() for st in fs.listStatus(path) if st.getPath().getName().endswith(".parquet"))


def folder_profile(t) -> DataFrame:
    """Rows, columns and numeric columns per table file, plus a TOTAL line."""
    files, _ = FO.profile_parquet_files(t.spark, table_paths(t.spark, t.sf_dir))
    files = files.withColumn("status", F.lit("OK"))
    total = files.agg(F.lit("TOTAL").alias("file_name"), F.sum("data_rows").alias("data_rows"))
    return files.unionByName(total, allowMissingColumns=True)


def folder_column_profile(t) -> DataFrame:
    """Min / max / average of every numeric column of every table file."""
    _, cols = FO.profile_parquet_files(t.spark, table_paths(t.spark, t.sf_dir))
    return cols.withColumn("avg", F.round("avg", 4))


def document_files(t) -> DataFrame:
    """Documents as a file list."""
    d = t["documents"]
    name = F.col("doc_id").cast("string")
    return d.select(F.col("doc_id").alias("file_idx"), name.alias("file_name"), name.alias("file_path"),
                    F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size_bytes"))


def document_lines(t) -> DataFrame:
    """Lines of every whole document; a line feed at the end starts no line."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), "\n$", "")
    lines = F.when(F.coalesce("text", F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n", -1))
    return t["documents"].select(F.col("doc_id").cast("string").alias("file_path"), F.posexplode(lines).alias("line_no", "line")) \
                         .select("file_path", F.col("line_no").cast("long").alias("line_no"), "line")


def document_profile(t) -> DataFrame:
    """L24 per document: size and its text, rows, columns, numeric columns, status; TOTAL line."""
    files, _ = FO.profile_lines(document_files(t), document_lines(t))
    return FO.with_total(files.drop("file_path"))


def document_column_profile(t) -> DataFrame:
    """L24 / D22 per document and column: cells, numeric cells and their min, max and average, numeric test."""
    _, cols = FO.profile_lines(document_files(t), document_lines(t))
    return cols.withColumn("avg", F.round("avg", 4))


def document_preview(t) -> DataFrame:
    """F5 per document: the first five data lines, cells joined by ``|``."""
    p = FO.preview_lines(document_files(t), document_lines(t))
    return p.select("file_name", "row_no", F.array_join("cells", "|").alias("cells"))
