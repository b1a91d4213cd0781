"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

Writing.  A page's payload is its html in UTF-8.  Payloads are hashed; of records with equal
payloads of at least ``MIN_REVISIT`` bytes the one with the smallest id is the response, the
others are revisits that name it.  Archives are plain text files of Spark's writer, whose line
separator is the blank lines that end a record.

Reading.  The reader splits files at the magic that opens a record, so a task sees candidates:
true records, and pieces of payloads in which the magic occurs.  Each candidate's offset is
the sum of what lies before it in its file, and its header gives the offset of its successor.
A task follows the pointers inside its split and emits for each candidate the first offset
beyond the split, too.  Pointer jumping from the start of each file goes over these longer
pointers (they double each round, so rounds grow with the logarithm of a file's splits) and gives
each split the one offset at which the chain enters it; the candidates on the way from there
are retained.  All others are payload, and go back into the record before them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bizlens.llm.common import id_type, materialize, scratch_path, ship_package, table

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"  # closes the header, and closes a record
MIN_REVISIT = 100
MAX_ROUNDS = 48
URN = "urn:page:"
DATE = "2024-01-01T00:00:00Z"  # records carry a fixed date, so that archives can be made again byte for byte


def mark_revisits(pages: DataFrame, id_col: str, payload: Column, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """(id, sha256, refers_to) of the rows that are revisits: rows of equal payloads but not of the smallest id."""
    keyed = pages.select(F.col(id_col).alias("id"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("n"))
    keyed = keyed.where((F.col("n") >= min_bytes) & F.col("id").isNotNull()).select("id", "digest")
    first = keyed.groupBy("digest").agg(F.min("id").alias("refers_to"), F.max("id").alias("last")).where("refers_to < last").select("digest", "refers_to")
    first = materialize(first, "first")
    return keyed.join(first, "digest").where("id <> refers_to").select("id", F.col("digest").alias("sha256"), "refers_to").distinct()


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_bytes: int = MIN_REVISIT) -> None:
    """Write one record per input row to files under ``path``.

    Null html is an empty payload, null urls are empty targets; null ids are written as empty and
    are never revisits nor referred to; repeated rows are records of their own (all rows of the
    smallest id are responses); line breaks in urls are percent-encoded; other columns are
    ignored; an empty table gives an archive without records.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    # written first: usually few rows, so that the planner can send them to the pages instead of the pages to them
    revisits = materialize(mark_revisits(pages, id_col, payload.cast("binary"), min_bytes), "revisits")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha2(payload.cast("binary"), 256).alias("sha256"))
    rows = rows.join(revisits, ["id", "sha256"], "left")
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit(URN), F.coalesce(F.col("id").cast("string"), F.lit("")))), line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("sha256"))),
        line("WARC-Payload-Length", F.octet_length("payload").cast("string")),
        F.when(revisit, line("WARC-Refers-To", F.concat(F.lit(URN), F.col("refers_to").cast("string")))).otherwise(F.lit("")),
        F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit(END), body)
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


FIELDS = {"WARC-Type": "type", "WARC-Record-ID": "record_id", "WARC-Target-URI": "url", "WARC-Payload-Digest": "digest",
          "WARC-Payload-Length": "payload_bytes", "WARC-Refers-To": "refers_to"}
_PIECE = ("file string, split long, place long, n long, size long, leaves long, length long, whole boolean, sha256 string, raw binary, "
          + ", ".join(f"{v} string" for v in FIELDS.values()))


def parse_record(raw: bytes) -> tuple[dict[str, str], int, int] | None:
    """Header fields, start of the body, and its length; None if this is no well-formed header."""
    cut = raw.find(END.encode())
    if cut < 0:
        return None
    lines = raw[:cut].split(b"\r\n")
    if not all(b": " in x or x.endswith(b":") for x in lines):
        return None
    fields = {k.decode("latin-1"): v.decode("utf-8", "replace") for k, _, v in (x.partition(b": ") for x in lines)}
    length = fields.get("Content-Length", "")
    if "WARC-Type" not in fields or not (length.isascii() and length.isdigit()):
        return None
    return fields, cut + len(END), int(length)


def leaving(places: list[int], sizes: list[int | None], end: int) -> list[int | None]:
    """For each piece of a split the place beyond the split to which its pointers lead; null where
    they end at a place that no piece has.  ``end`` is where the next split's first piece begins."""
    at, out = {p: i for i, p in enumerate(places)}, [None] * len(places)
    for i in range(len(places) - 1, -1, -1):
        if sizes[i] is not None:
            to = places[i] + sizes[i] + len(MAGIC)
            out[i] = to if to >= end else out[at[to]] if to in at else None
    return out


def _scan(keep_raw: bool):
    """Pieces in order: place is where a piece begins in its split, size the bytes up to its
    successor's magic (null without a header), leaves the place beyond the split that it leads to,
    length of the payload, whole if the piece ends where the header says."""
    def run(parts):
        import hashlib

        import pyarrow as pa

        schema = pa.schema([("file", pa.string()), ("split", pa.int64()), ("place", pa.int64()), ("n", pa.int64()), ("size", pa.int64()), ("leaves", pa.int64()),
                            ("length", pa.int64()), ("whole", pa.bool_()), ("sha256", pa.string()), ("raw", pa.binary()), *((v, pa.string()) for v in FIELDS.values())])
        at, place, rows = None, 0, []  # the rows of one split, without payloads unless they are asked for

        def out():
            if not keep_raw:
                for row, to in zip(rows, leaving([r["place"] for r in rows], [r.get("size") for r in rows], place)):
                    row["leaves"] = to
            return pa.RecordBatch.from_pylist(rows, schema)

        for part in parts:
            for file, split, raw in zip(*(part.column(i).to_pylist() for i in range(3))):
                if at != (file, split):
                    if rows:
                        yield out()
                    at, place, rows = (file, split), 0, []
                record = {"file": file, "split": split, "place": place, "n": len(raw)}
                if found := parse_record(raw):
                    fields, body, length = found
                    whole = len(raw) == body + length + len(END)
                    record |= {v: fields.get(k) for k, v in FIELDS.items()}
                    record |= {"size": body + length + len(END), "length": length, "whole": whole,
                               "sha256": hashlib.sha256(raw[body:body + length]).hexdigest() if whole else None}
                if keep_raw:
                    record["raw"] = raw
                rows.append(record)
                place += len(raw) + len(MAGIC)
            if keep_raw and rows:
                yield out()
                rows = []
        if rows:
            yield out()

    return run


def _scanned(spark: SparkSession, path: str, keep_raw: bool) -> DataFrame:
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("raw")).mapInArrow(_scan(keep_raw), _PIECE)


def _bases(scanned: DataFrame) -> DataFrame:
    """(file, split, base): bytes of the file before the first piece of a split."""
    ends = scanned.groupBy("file", "split").agg(F.max(F.col("place") + F.col("n") + len(MAGIC)).alias("bytes"))
    before = F.sum("bytes").over(W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1))
    return ends.select("file", "split", F.coalesce(before, F.lit(0)).alias("base"))


def _located(scanned: DataFrame, bases: DataFrame) -> DataFrame:
    """Pieces with at (byte offset of their magic in the file) and next (offset at which the header
    puts the successor).  The text before a file's first magic is no candidate."""
    start = F.col("base") + F.col("place")
    return (scanned.join(bases, ["file", "split"]).withColumn("at", start - len(MAGIC)).withColumn("next", start + F.col("size"))
            .withColumn("leaves", F.col("base") + F.col("leaves") - len(MAGIC)).where("at >= 0").drop("base", "place"))


def entries(nodes: DataFrame) -> DataFrame:
    """(file, split, at): where the chain from offset 0 of each file enters each split, by pointer
    jumping over the offsets to which splits lead.  ``nodes``: file, split, at, leaves."""
    targets = nodes.where("leaves IS NOT NULL").select("file", F.col("leaves").alias("at")).distinct()
    starts = nodes.where("at = 0").select("file", "split", "at", "leaves")
    doors = materialize(starts.unionByName(nodes.where("at > 0").select("file", "split", "at", "leaves").join(targets, ["file", "at"], "left_semi")), "doors")
    jump = doors.where("leaves IS NOT NULL").select("file", "at", F.col("leaves").alias("to"))
    jump = materialize(jump.join(doors.select("file", F.col("at").alias("to")), ["file", "to"], "left_semi"), "jump")
    reached = doors.where("at = 0").select("file", "at")
    n = reached.count()
    for _ in range(MAX_ROUNDS):
        ahead = reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = materialize(reached.unionByName(ahead).distinct(), "reached")
        before, n = n, reached.count()
        if n == before:
            return doors.join(reached, ["file", "at"], "left_semi").select("file", "split", "at")
        further = jump.select("file", F.col("at").alias("to"), F.col("to").alias("further"))
        jump = materialize(jump.join(further, ["file", "to"]).select("file", "at", F.col("further").alias("to")), "jump")
    raise RuntimeError("a file has more splits than rounds of doubling allow")


def _walk(key, rows):
    """The offsets of one split on the chain from its entry."""
    import pandas as pd

    follow, at, out = dict(zip(rows["at"], rows["next"])), rows["entry"].iloc[0], []
    while at in follow:
        out.append(int(at))
        at = follow[at]
    return pd.DataFrame({"file": key[0], "at": out})


def reachable(nodes: DataFrame) -> DataFrame:
    """(file, at) of the records on the chain from offset 0 of each file; a split's candidates,
    without payloads, are walked through by one task."""
    enter = entries(nodes).select("file", "split", F.col("at").alias("entry"))
    own = nodes.where("next IS NOT NULL").select("file", "split", "at", "next").join(enter, ["file", "split"])
    return own.groupBy("file", "split").applyInPandas(_walk, "file string, at long")


def _assemble(key, rows):
    """One record from the pieces that its quoted magic made of it."""
    import hashlib

    import pandas as pd

    raw = MAGIC.encode().join(bytes(x) for x in rows.sort_values("at")["raw"])
    _, body, length = parse_record(raw)
    payload = raw[body:body + length]
    return pd.DataFrame({"file": [key[0]], "at": [key[1]], "payload": [payload], "sha256": [hashlib.sha256(payload).hexdigest()]})


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``: file, at, the header's fields, the
    payload's sha256 and length as read, and, if asked, the payload.

    Magic inside payloads makes no records, even where a whole record is quoted.  Where a chain
    ends early (a damaged record), the rest of its file is not returned.  An archive without
    records gives no rows.  Payloads may be any bytes.
    """
    ship_package(spark)
    scanned = materialize(_scanned(spark, path, False).drop("raw"), "pieces")
    bases = _bases(scanned)
    found = materialize(_located(scanned, bases), "candidates")
    marked = found.join(reachable(found).withColumn("real", F.lit(True)), ["file", "at"], "left")
    marked = materialize(marked.withColumn("real", F.coalesce("real", F.lit(False))), "marked")
    fields = ["file", "at", "type", "record_id", "url", "digest", F.expr("try_cast(payload_bytes AS bigint)").alias("payload_bytes"), "refers_to"]
    whole, broken = marked.where("real AND whole"), marked.where("real AND NOT whole")
    quoted = not broken.isEmpty()
    if not payloads and not quoted:
        return whole.select(*fields, "sha256", "length")
    raw = _located(_scanned(spark, path, True), bases)
    out = whole.select(*fields, "sha256", "length")
    if payloads:
        body = F.expr(f"substring(raw, int(octet_length(raw) - {len(END)} - length + 1), int(length))")
        own = raw.select("file", "at", body.alias("payload"))
        out = out.join(own, ["file", "at"])
    if quoted:
        # the pieces from each broken record up to the next record; those of whole records aren't moved
        last = F.last(F.when(F.col("real"), F.col("at")), ignorenulls=True).over(W.partitionBy("file").orderBy("at"))
        owners = marked.where("NOT (real AND whole)").select("file", "at", last.alias("owner")).where("owner IS NOT NULL")
        put = (raw.select("file", "at", "raw").join(owners, ["file", "at"]).groupBy("file", "owner")
               .applyInPandas(_assemble, "file string, at long, payload binary, sha256 string"))
        rest = broken.select(*fields).join(put, ["file", "at"]).withColumn("length", F.octet_length("payload").cast("long"))
        out = out.unionByName(rest.select(out.columns))
    return out


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    write_warc(pages, path)
    number = lambda c: F.expr(f"try_cast(substring({c}, {len(URN) + 1}) AS {id_type(pages, 'page_id')})")
    records = read_warc(spark, path, payloads=False)
    revisit = F.col("type") == "revisit"
    return records.select(
        number("record_id").alias("page_id"), F.when(revisit, F.col("payload_bytes")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(revisit, F.substring_index("digest", ":", -1)).otherwise(F.col("sha256")).alias("payload_digest"),
        F.col("type").alias("record_type"), number("refers_to").alias("refers_to"))


ORACLE_OP6 = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS first_id FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM payloads LEFT JOIN firsts USING (payload_digest)
"""
