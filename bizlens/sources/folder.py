"""Profile every CSV file of a folder.

* The file list (name, path, size) is Spark's own listing, sizes from a
  ``binaryFile`` scan that reads no content.  Empty files are in it (a scan
  alone would silently drop them).
* One text scan reads all files at once; each line gets its number in its
  split in the same pass, so the header line, the sample and the preview need no
  second numbering.
* Per-column numbers: cells are exploded with their column position and
  reduced per (file, column) by one partial aggregation, which also counts
  the numeric cells of the sample (a column is numeric if >= 70 % of the first
  <= 10 data rows are numbers).

Files of a folder are read by records (``quoted_csv``), so line breaks inside quotes are text of their
cells; the lines of stored documents and of the folder stream are cut one by one at commas
outside double quotes.  A file that can't be read is a row with status ``ERROR`` and the error's text, and
takes nothing from the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import human_size, safe_name
from ..operators.profile import is_number_text, numeric_profile
from ..operators.windows import global_row_window
from .quoted_csv import read_records
from .scratch import materialize, ship_package

CSV_GLOB = "*.{[cC][sS][vV],[cC][sS][vV].[gG][zZ]}"
GZIP_GLOB = "*.[cC][sS][vV].[gG][zZ]"
SAMPLE_ROWS = 10
PREVIEW_ROWS = 5
NUMERIC_SHARE = 0.7
CELL_END = "\u0001"


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file_idx, file_name, file_path, size_bytes) for the CSV files, by name.

    Sizes come from a scan that reads no content; that scan skips empty files, so
    the names are those that Spark's own listing of the folder already holds.
    """
    scan = spark.read.format("binaryFile").option("pathGlobFilter", CSV_GLOB).load(folder)
    key = lambda path: F.regexp_replace(path, "^file:/+", "file:/")  # noqa: E731  local paths are written in two ways
    listed = spark.createDataFrame([(f,) for f in scan.inputFiles()], "_listed string").withColumn("_key", key(F.col("_listed")))
    sized = scan.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("_name"), F.col("_metadata.file_size").alias("_size"))
    found = listed.join(sized.withColumn("_key", key(F.col("file_path"))), "_key", "left").select(
        F.coalesce("_name", F.element_at(F.split("_listed", "/"), -1)).alias("file_name"), F.coalesce("file_path", "_listed").alias("file_path"),
        F.coalesce("_size", F.lit(0)).cast("long").alias("size_bytes"))
    return global_row_window(found, [("file_name", True), ("file_path", True)], rn_col="file_idx")


def scan_folder(spark: SparkSession, folder: str) -> DataFrame:
    """A3: every ``.csv`` file of a folder (case-insensitive suffix) with name, path and size."""
    return list_files(spark, folder)


def _number_lines(parts):
    """Number of each line in its split (a task reads a split's lines in order)."""
    import numpy as np
    import pyarrow as pa

    at, count = None, 0
    for part in parts:
        keys = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist()))
        numbers = np.empty(len(keys), np.int64)
        for i, key in enumerate(keys):
            at, count = (at, count + 1) if key == at else (key, 0)
            numbers[i] = count
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(numbers)], ["file_path", "block", "line", "line_no"])


def number_lines(raw: DataFrame) -> DataFrame:
    """(file_path, line_no, line): line_no is 0 for a file's first line and counts on in its
    first split; lines of later splits have none."""
    ship_package(raw.sparkSession)
    numbered = raw.select("file_path", "block", "line").mapInArrow(_number_lines, "file_path string, block long, line string, line_no long")
    return numbered.select("file_path", F.when(F.col("block") == 0, F.col("line_no")).alias("line_no"), "line")


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(file_path, line_no, cells) of every record of every CSV file; line_no as ``number_lines`` gives it."""
    records = read_records(spark, folder, CSV_GLOB)
    return records.select("file_path", F.when(F.col("block") == 0, F.col("at")).alias("line_no"),
                          F.transform("cells", lambda c: F.trim(F.coalesce(c, F.lit("")))).alias("cells"))


def _gzip_errors(batches):
    """(file_path, error) of the files that don't unpack, a stretch at a time."""
    import zlib

    import pyarrow as pa

    for batch in batches:
        found = []
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            data, error = memoryview(content.as_buffer()), None
            try:
                at = 0
                while at < len(data):
                    unpack = zlib.decompressobj(31)  # one member; a file may have several
                    while not unpack.eof:
                        if at >= len(data):
                            raise EOFError("the file ends inside its compressed data")
                        stretch = data[at:at + (1 << 20)]
                        rest = unpack.decompress(stretch, 1 << 24)
                        while unpack.unconsumed_tail:
                            rest = unpack.decompress(unpack.unconsumed_tail, 1 << 24)
                        del rest
                        at += len(stretch) - len(unpack.unused_data)
            except (zlib.error, EOFError) as e:
                error = str(e)
            found.append((path, error))
        bad = [x for x in found if x[1]]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in bad], pa.string()), pa.array([e for _, e in bad], pa.string())], ["file_path", "error"])


def scan_errors(spark: SparkSession, folder: str) -> DataFrame:
    """(file_path, error) of the CSV files that can't be read whole: broken compression, bytes that are no UTF-8, no readable line."""
    ship_package(spark)
    packed = spark.read.format("binaryFile").option("pathGlobFilter", GZIP_GLOB).load(folder).select(F.col("_metadata.file_path").alias("file_path"), "content")
    broken = packed.mapInArrow(_gzip_errors, "file_path string, error string")
    lines = (spark.read.option("pathGlobFilter", CSV_GLOB).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).option("lineSep", "\n").text(folder)
             .select(F.col("_metadata.file_path").alias("file_path"), (~F.is_valid_utf8("value")).alias("bad")))
    seen = lines.groupBy("file_path").agg(F.count_if("bad").alias("bad"))
    coded = seen.where("bad > 0").select("file_path", F.concat(F.col("bad").cast("string"), F.lit(" lines are not UTF-8")).alias("error"))
    sized = spark.read.format("binaryFile").option("pathGlobFilter", CSV_GLOB).load(folder).select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("size"))
    silent = sized.where("size > 0").join(seen.select("file_path"), "file_path", "left_anti").select("file_path", F.lit("no line could be read").alias("error"))
    return broken.unionByName(coded).unionByName(silent).groupBy("file_path").agg(F.array_join(F.array_sort(F.collect_set("error")), "; ").alias("error"))


def cells(line: Column) -> Column:
    """CSV cells of a line: commas inside double quotes kept, quotes stripped, cells trimmed."""
    pieces = F.split(line, '"')  # every second piece is inside quotes
    last = F.size(pieces) - 1

    def piece(s: Column, i: Column) -> Column:
        between = (i > 0) & (i < last) & (s == "")  # between two quoted pieces: a doubled quote
        return F.when(i % 2 == 1, s).when(between, F.lit('"')).otherwise(F.replace(s, F.lit(","), F.lit(CELL_END)))

    return F.transform(F.split(F.array_join(F.transform(pieces, piece), ""), CELL_END), lambda c: F.trim(c))


def profile_folder(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Returns (files, columns).

    files: file_idx, file_name, file_path, size_bytes, size_text, sheet_name,
    row_count (header included), data_row_count, column_count,
    numeric_column_count, status, error.
    columns: file_name, col_no, col_name, min, max, avg (numeric columns).
    """
    errors = materialize(scan_errors(spark, folder), "file-errors")  # a row a broken file
    lines = read_lines(spark, folder).join(errors.select("file_path"), "file_path", "left_anti")
    files, cols = profile_lines(list_files(spark, folder), lines)
    broken = F.col("error").isNotNull()
    files = files.join(errors, "file_path", "left").withColumn("status", F.when(broken, "ERROR").otherwise(F.col("status")))
    return files, cols.where("is_numeric").drop("is_numeric", "numeric_cells", "cells")


def _cells_of(lines: DataFrame) -> Column:
    """Cells of lines that are cut already, or of text lines."""
    return F.col("cells") if "cells" in lines.columns else cells(F.col("line"))


def profile_lines(files: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Profile from a file list (file_idx, file_name, file_path, size_bytes) and
    its lines (file_path, line_no, line): the batch folder scan, each
    micro-batch of the folder stream and the stored documents share this.

    columns has every column here, with its ``cells``, ``numeric_cells`` and
    ``is_numeric``.
    """
    is_header = F.coalesce(F.col("line_no") == 0, F.lit(False))
    own = _cells_of(lines)
    header = lines.where(is_header).select("file_path", own.alias("headers"))
    long = lines.where(~is_header).select("file_path", "line_no", F.posexplode(own).alias("pos", "cell"))
    sampled = F.coalesce(F.col("line_no") <= SAMPLE_ROWS, F.lit(False))
    stats = numeric_profile(long, ["file_path", "pos"], "cell", F.count(F.lit(1)).alias("_rows"), F.count_if(sampled).alias("_sample"),
                            F.count_if(sampled & is_number_text(F.col("cell"))).alias("_numbers"))
    stats = stats.join(header, "file_path").withColumn(
        "is_numeric", (F.col("_sample") > 0) & (F.col("_numbers") >= NUMERIC_SHARE * F.col("_sample")) & (F.col("pos") < F.size("headers")))
    per_file = stats.groupBy("file_path").agg(F.max(F.when(F.col("pos") == 0, F.col("_rows"))).alias("_data"),
                                              F.count_if("is_numeric").alias("numeric_column_count"))
    zero = F.lit(0)
    out_files = (files.join(header, "file_path", "left").join(per_file, "file_path", "left")
                      .select("file_idx", "file_name", "file_path", "size_bytes",
                              human_size(F.col("size_bytes")).alias("size_text"),
                              safe_name(F.col("file_name"), F.col("file_idx")).alias("sheet_name"),
                              F.when(F.col("headers").isNull(), zero).otherwise(F.coalesce("_data", zero) + 1).cast("long").alias("row_count"),
                              F.coalesce("_data", zero).cast("long").alias("data_row_count"),
                              F.coalesce(F.size("headers"), zero).cast("long").alias("column_count"),
                              F.coalesce("numeric_column_count", zero).cast("long").alias("numeric_column_count"),
                              F.when(F.col("size_bytes") == 0, "Empty").otherwise("OK").alias("status")))
    out_cols = (stats.join(files.select("file_path", "file_name"), "file_path")
                     .select("file_name", (F.col("pos") + 1).cast("long").alias("col_no"),
                             F.get("headers", F.col("pos")).alias("col_name"), "min", "max", "avg", F.col("_rows").alias("cells"), "numeric_cells", "is_numeric"))
    return out_files, out_cols


def preview_lines(files: DataFrame, lines: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """first ``rows`` data lines of each file as (file_name, row_no, cells)."""
    head = lines.where((F.col("line_no") >= 1) & (F.col("line_no") <= rows))
    return head.join(files.select("file_path", "file_name"), "file_path").select(
        "file_name", F.col("line_no").alias("row_no"), _cells_of(lines).alias("cells"))


def preview(spark: SparkSession, folder: str, rows: int = PREVIEW_ROWS) -> DataFrame:
    """F5 over a folder."""
    return preview_lines(list_files(spark, folder), read_lines(spark, folder), rows)


def with_total(files: DataFrame) -> DataFrame:
    """TOTAL line summing row counts (and sizes) over the file list."""
    total = files.agg(F.lit(None).cast("long").alias("file_idx"), F.lit("TOTAL").alias("file_name"),
                      F.sum("size_bytes").alias("size_bytes"), F.sum("row_count").alias("row_count"))
    return files.unionByName(total, allowMissingColumns=True)


# Parquet folders: one scan for each distinct schema, whatever the number of tables.
NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def profile_parquet_files(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """(files, columns) profile of parquet tables (a file, or a folder of part files, each).

    Tables with the same schema are read by one scan and told apart by the path of each row's file, so
    the plan grows with the number of schemas.  Tables without rows have a row with zeros.
    """
    by_schema: dict[str, tuple[T.StructType, list[str]]] = {}
    for path in paths:
        schema = spark.read.parquet(path).schema
        by_schema.setdefault(schema.json(), (schema, []))[1].append(path)
    files = cols = None
    for schema, own in by_schema.values():
        numeric = [(i, f.name) for i, f in enumerate(schema.fields) if isinstance(f.dataType, NUMERIC_TYPES)]
        aggs = [F.count(F.lit(1)).alias("data_rows")]
        for i, c in numeric:
            x = F.col(f"`{c}`").cast("double")
            aggs += [F.min(x).alias(f"min_{i}"), F.max(x).alias(f"max_{i}"), F.avg(x).alias(f"avg_{i}")]
        scan = spark.read.schema(schema).parquet(*own)
        # the leftmost part of a path that ends like a table is the table
        wide = scan.groupBy(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+\.parquet)(?:/|$)", 1).alias("file_name")).agg(*aggs)
        names = spark.createDataFrame([(p.rstrip("/").split("/")[-1],) for p in own], "file_name string")
        wide = names.join(wide, "file_name", "left")
        rows = wide.select("file_name", F.coalesce("data_rows", F.lit(0)).cast("long").alias("data_rows"), F.lit(len(schema.fields)).cast("long").alias("column_count"),
                           F.lit(len(numeric)).cast("long").alias("numeric_column_count"))
        files = rows if files is None else files.unionByName(rows)
        if numeric:
            stack = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("col_no"), F.lit(c).alias("col_name"), F.col(f"min_{i}").alias("min"), F.col(f"max_{i}").alias("max"),
                                                 F.col(f"avg_{i}").alias("avg")) for i, c in numeric]))
            own_cols = wide.select("file_name", stack.alias("_s")).select("file_name", "_s.*")
            cols = own_cols if cols is None else cols.unionByName(own_cols)
    return files, cols
