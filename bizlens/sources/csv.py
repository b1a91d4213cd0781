"""A1: CSV source for messy business exports.

Every column is read as a string (never inferred: inference is a full extra
pass and guesses differently per file), then every missing-value marker is
turned into NULL in one projection.  ``nullValue`` accepts a single marker,
so the marker list is applied as a column expression instead.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.text import NA_MARKERS, na_to_null
from pyspark.sql import functions as F


def read_sales_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                   markers: Sequence[str] = NA_MARKERS) -> DataFrame:
    """Header CSV -> all-string DataFrame with NA markers as NULL.

    ``columns`` fixes the expected header (recommended on a cluster: no
    header sniffing job); without it the header of the files is used.
    """
    reader = (spark.read.option("header", True).option("mode", "PERMISSIVE")
                   .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
                   .option("nullValue", "\u0000never\u0000").option("emptyValue", ""))
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    df = reader.csv(path)
    df = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    return df.select(*[na_to_null(F.col(f"`{c}`"), markers).alias(c) for c in df.columns])
