"""CSV with line breaks inside quoted fields, read by splits of a file.

A line that a split begins with may lie inside a quoted field; what stands before decides.  So reading
takes two passes, and no task reads more than its splits:

1. every split says how it ends if it begins outside a quoted field, and how if it begins inside one.
   A split then either keeps the state, turns it round, or sets it; a prefix over the splits of a file
   (narrow rows, one a split) gives the state that each split truly begins with.
2. every split cuts its records.  A record that runs over the end of a split leaves a
   fragment there, its end leaves one at the head of a later split; fragments of one
   record are numbered by another prefix and put together.  Only fragments are shuffled.

Fields follow Python's ``csv`` module: a quote opens a quoted field only at the field's start, a doubled
quote inside is a quote, text after the closing quote belongs to the field, an open
quote at the end of the file ends there, a line end is ``\\n`` or ``\\r\\n``, empty lines are no records.  An unquoted empty
field is NULL, a quoted one is the empty string.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .scratch import materialize, ship_package

RECORD = "file_path string, block long, at long, cells array<string>"


def ends_inside(line: str, inside: bool) -> bool:
    """If a line ends inside a quoted field, for a line that begins inside one or not."""
    if '"' not in line:
        return inside
    at, n = 0, len(line)
    while True:
        if not inside:
            if at >= n:
                return False
            if line[at] != '"':  # to the next field
                at = line.find(",", at) + 1
                if not at:
                    return False
                continue
            at += 1
        close = line.find('"', at)
        while close >= 0 and line[close + 1:close + 2] == '"':
            close = line.find('"', close + 2)
        if close < 0:
            return True
        at, inside = line.find(",", close + 1) + 1, False
        if not at:
            return False


def parse(record: str) -> list[str | None] | None:
    """The cells of one record; None for an empty line."""
    import csv
    import sys

    csv.field_size_limit(sys.maxsize)
    # a record keeps its line feeds: as one item, they are text of the quoted field
    rows = list(csv.reader([record], quoting=csv.QUOTE_NOTNULL))
    return rows[0] if rows and rows[0] else None


def _state_maps(batches):
    """(file_path, block, from_outside, from_inside): how each split ends."""
    import pyarrow as pa

    now, ends = None, [0, 1]
    rows = []
    for batch in batches:
        for path, block, line in zip(*(c.to_pylist() for c in batch.columns)):
            if (path, block) != now:
                if now:
                    rows.append((*now, *ends))
                now, ends = (path, block), [0, 1]
            if '"' in line:
                ends = [int(ends_inside(line, bool(e))) for e in ends]
    if now:
        rows.append((*now, *ends))
    columns = list(zip(*rows)) or [()] * 4
    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])],
                                     ["file_path", "block", "from_outside", "from_inside"])


def split_states(maps: DataFrame) -> DataFrame:
    """(file_path, block, inside): the state that each split begins with."""
    by_block = Window.partitionBy("file_path").orderBy("block")
    fixed = F.col("from_outside") == F.col("from_inside")
    turned = (F.col("from_outside") == 1) & (F.col("from_inside") == 0)
    runs = maps.withColumn("run", F.sum(fixed.cast("long")).over(by_block))  # a split that sets the state begins a run
    in_run = Window.partitionBy("file_path", "run").orderBy("block")
    start = F.first(F.when(fixed, F.col("from_outside")).otherwise(0)).over(in_run)
    after = runs.withColumn("after", F.pmod(start + F.sum(turned.cast("long")).over(in_run), F.lit(2)))
    return after.select("file_path", "block", (F.lag("after", 1, 0).over(by_block) == 1).alias("inside"))


def _cut(batches):
    """Records of each split, and its fragments: kind 0 a whole record, 1 an end without its start, 2 a start
    without its end, 3 a stretch without either."""
    import pyarrow as pa

    schema = pa.schema([("file_path", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("kind", pa.int32()), ("cells", pa.list_(pa.string())), ("text", pa.string())])
    rows, size = [], 0

    def out():
        nonlocal size
        done = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * 6, schema)], schema.names)
        rows.clear()
        size = 0
        return done

    now, at, lines, inside, begun = None, 0, [], False, False

    def put(kind):
        nonlocal at, size
        text = "\n".join(lines)
        cells = parse(text) if kind == 0 else None
        if kind or cells:
            rows.append((*now, at, kind, cells, None if kind == 0 else text))
            size += len(text)
            at += 1
        lines.clear()

    for batch in batches:
        for path, block, starts_inside, line in zip(*(c.to_pylist() for c in batch.columns)):
            if (path, block) != now:
                if lines:
                    put(2 if begun else 3)
                now, at, inside, begun = (path, block), 0, starts_inside, not starts_inside
            lines.append(line)
            inside = ends_inside(line, inside)
            if not inside:
                put(0 if begun else 1)
                begun = True
                if size > 1 << 22:
                    yield out()
    if lines:
        put(2 if begun else 3)
    yield out()


def _parse_joined(batches):
    import pyarrow as pa

    for batch in batches:
        cells = [parse(t) for t in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(cells, pa.list_(pa.string()))], ["file_path", "block", "at", "cells"])


@contextlib.contextmanager
def _splits_of(spark: SparkSession, split_bytes: int | None):
    """Files read inside are cut into splits of this size."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        if split_bytes:
            spark.conf.set(keys[0], str(split_bytes))
            spark.conf.set(keys[1], "0")
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def read_records(spark: SparkSession, path: str, glob: str | None = None, split_bytes: int | None = None) -> DataFrame:
    """(file_path, block, at, cells) of every record of the files under ``path``: block is the start
    of the split in which it begins, at its place there, so they order a file's records.

    The records are written to the shared folder, so both passes see the same splits.  A task takes many splits
    of ``split_bytes``: there are as many tasks as Spark's own settings give the files, however small the splits.  Files without
    a record give no rows.  Of a file whose compression is broken the records before the break are read, and
    bytes that are no UTF-8 are replaced; ``folder.scan_errors`` names such files.
    """
    ship_package(spark)
    reader = spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", True)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    tasks = max(1, reader.text(path).rdd.getNumPartitions()) if split_bytes else None
    with _splits_of(spark, split_bytes):
        raw = reader.text(path).select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"),
                                       F.make_valid_utf8("value").alias("value"))
        raw = raw.coalesce(tasks) if tasks else raw  # a split stays whole and in one task
        maps = materialize(raw.mapInArrow(_state_maps, "file_path string, block long, from_outside long, from_inside long"), "csv-states")
        states = materialize(split_states(maps), "csv-starts")
        # a row a split, so its size is bounded by the number of splits
        lines = raw.join(F.broadcast(states), ["file_path", "block"]).select("file_path", "block", "inside", "value")
        cut = materialize(lines.mapInArrow(_cut, RECORD.replace("cells", "kind int, cells") + ", text string"), "csv-records")
    whole = cut.where("kind = 0").select("file_path", "block", "at", "cells")
    # a record in several splits: its start opens a number, all fragments up to its end have that number
    order = Window.partitionBy("file_path").orderBy("block", "at")
    fragments = cut.where("kind > 0")
    numbered = fragments.select("file_path", "block", "at", F.sum((F.col("kind") == 2).cast("long")).over(order).alias("number"))
    pieces = fragments.select("file_path", "block", "at", "text").join(numbered, ["file_path", "block", "at"])
    joined = pieces.groupBy("file_path", "number").agg(F.min(F.struct("block", "at")).alias("first"), F.array_sort(F.collect_list(F.struct("block", "at", "text"))).alias("all"))
    joined = joined.select("file_path", "first.block", "first.at", F.array_join(F.transform("all", lambda x: x["text"]), "\n").alias("text"))
    return whole.unionByName(joined.mapInArrow(_parse_joined, RECORD).where("cells IS NOT NULL"))


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType, split_bytes: int | None = None) -> DataFrame:
    """Files without header lines as a table of ``schema``: cells by place, cast to their types (a cell that
    isn't of its type is NULL, as are missing cells)."""
    records = read_records(spark, path, split_bytes=split_bytes)
    return records.select(*(F.get("cells", F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)))


def quoted(c: Column) -> Column:
    """A CSV cell: text in quotes, quotes doubled; NULL is empty and unquoted."""
    return F.coalesce(F.concat(F.lit('"'), F.replace(c.cast("string"), F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))


def write_quoted_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A5 for texts with line breaks: every value quoted, no header line, one file a task.  A row of a single
    NULL column would be an empty line, which is no record; such rows get a closing comma."""
    line = F.concat_ws(",", *(quoted(F.col(f"`{c}`")) for c in df.columns))
    line = line if len(df.columns) > 1 else F.when(line == "", ",").otherwise(line)
    df.select(line.alias("value")).write.mode(mode).option("lineSep", "\n").text(path)
