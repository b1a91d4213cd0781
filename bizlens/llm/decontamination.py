"""Benchmark decontamination by size-partitioned MinHash containment search.

An item's shingles are ordered by hash; its sketch is the bottom k of that order.  Items are
partitioned by size (shingle counts up to 1, 2, 4, 8, ...), and k of a partition with largest
size u is ``floor((1 - threshold) * u) + 1``: a document that holds at least ``threshold`` of an
item's shingles lacks fewer than k of them, so it holds one of the sketch.  The search misses
no pair, however long the document.  Pairs found are verified by counting the item's shingles
in the document, shingle text against shingle text.

Tasks test document shingles against bitmaps of the items' shingle hashes, of at most
``MAX_BITMAP_BITS`` whatever the size of the benchmark; only shingles that pass are shuffled.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.llm.common import id_type, materialize, ship_package, table, text_or_empty

SHINGLE_WORDS = 5
THRESHOLD = 0.8
MIN_BITMAP_BITS, MAX_BITMAP_BITS = 16, 27  # powers of two; 2**27 bits are 16 MB
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased."""
    return text.encode().lower().split()


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """64-bit hash of each shingle of ``width`` words."""
    n = len(words) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    each = np.fromiter(map(zlib.crc32, seen), np.uint64, len(seen))[ids]
    h = np.zeros(n, np.uint64)
    for i in range(width):
        h = (h ^ each[i:i + n]) * _MULTIPLIER
        h ^= h >> np.uint64(31)
    return h * _MULTIPLIER


def sketch_size(n: int, threshold: float) -> int:
    """k of the size partition that holds items of ``n`` shingles."""
    upper = 1 << (n - 1).bit_length()
    return min(n, math.floor((1 - threshold) * upper + 1e-9) + 1)


def _sketch(width: int, threshold: float, id_col: str):
    def run(parts):
        import pyarrow as pa

        for part in parts:
            rows = []
            for item, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = words_of(text)
                w = min(width, len(words))
                hashes = shingle_hashes(words, w) if w else []
                own = {b" ".join(words[i:i + w]).decode(): int(h) for i, h in enumerate(hashes)}
                k = sketch_size(len(own), threshold) if own else 0
                for place, (shingle, h) in enumerate(sorted(own.items(), key=lambda x: (x[1], x[0]))):
                    rows.append((item, w, len(own), shingle, h - (1 << 64) if h >> 63 else h, place < k))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [part.column(0).type, pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             [id_col, "width", "n_shingles", "shingle", "hash", "sketch"])

    return run


def _bitmap(items: DataFrame, bits: int) -> np.ndarray:
    """Bit map of the top ``bits`` of the hashes: the driver gets 2**bits / 64 rows at most."""
    place = F.shiftrightunsigned("hash", 64 - bits)
    got = items.select(place.alias("b")).select(F.shiftright("b", 6).alias("w"), F.expr("shiftleft(1L, cast(pmod(b, 64L) AS int))").alias("v"))
    got = got.groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()
    words = np.zeros(max(1, (1 << bits) // 64), np.int64)
    words[got["w"].to_numpy()] = got["v"].to_numpy()
    return np.unpackbits(words.view(np.uint8), bitorder="little").astype(bool)


def _probe(widths: list[int], sketch: np.ndarray, every: np.ndarray, bits: int, id_col: str):
    packed = np.packbits(sketch), np.packbits(every)  # sent packed

    def run(parts):
        import pyarrow as pa

        sketches, shingles = (np.unpackbits(x).view(bool) for x in packed)
        shift = np.uint64(64 - bits)
        for part in parts:
            ids, texts = [], []
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = words_of(text)
                for w in widths:
                    place = (shingle_hashes(words, w) >> shift).astype(np.int64)
                    if sketches[place].any():
                        found = {b" ".join(words[i:i + w]) for i in np.flatnonzero(shingles[place]).tolist()}
                        ids += [doc] * len(found)
                        texts += [x.decode() for x in found]
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, part.column(0).type), pa.array(texts, pa.string())], [id_col, "shingle"])

    return run


def contained_items(docs: DataFrame, benchmark: DataFrame, width: int = SHINGLE_WORDS, threshold: float = THRESHOLD,
                    id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per pair of a document and a benchmark item that it contains: ids, n_shared,
    n_shingles, containment (at least ``threshold``).

    Items of fewer than ``width`` words are one shingle of their own length; items without words
    match nothing, nor do null and empty texts.  Rows that repeat a document id count as one
    document, and so do rows that repeat an item id; rows with a null id make one document with a
    null id.  Other columns are ignored; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    items = materialize(
        benchmark.select(F.col(item_col), text_or_empty(text_col).alias("_text")).mapInArrow(
            _sketch(width, threshold, item_col),
            f"`{item_col}` {id_type(benchmark, item_col)}, width int, n_shingles long, shingle string, hash long, sketch boolean"), "items")
    n = items.count()
    bits = min(MAX_BITMAP_BITS, max(MIN_BITMAP_BITS, (64 * n).bit_length()))
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # width values at most
    probe = _probe(widths, _bitmap(items.where("sketch"), bits), _bitmap(items, bits), bits, id_col)
    found = (docs.select(F.col(id_col).alias("doc"), text_or_empty(text_col).alias("_text"))
             .mapInArrow(probe, f"doc {id_type(docs, id_col)}, shingle string"))
    found = materialize(found.distinct(), "shingles")
    items = items.withColumnRenamed(item_col, "item")
    # search: documents and items that share a sketch shingle
    pairs = materialize(found.join(items.where("sketch").select("shingle", "item"), "shingle").select("doc", "item").distinct(), "candidates")
    # verification: the candidates' shingles, each document's against its own candidates only
    same = F.col("a.doc").eqNullSafe(F.col("b.doc"))
    asked = pairs.alias("a").join(found.alias("b"), same).select("a.doc", "a.item", "b.shingle")
    shared = asked.alias("a").join(items.distinct().alias("b"), F.col("a.item").eqNullSafe(F.col("b.item")) & (F.col("a.shingle") == F.col("b.shingle")))
    counted = shared.groupBy("a.doc", "a.item").agg(F.countDistinct("a.shingle").alias("n_shared"), F.max("n_shingles").alias("n_shingles"))
    return (counted.where(F.col("n_shared") >= F.col("n_shingles") * F.lit(threshold) - 1e-9)
            .select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "n_shared", "n_shingles", (F.col("n_shared") / F.col("n_shingles")).alias("containment")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = SHINGLE_WORDS, threshold: float = THRESHOLD,
                      id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that contain no benchmark item.

    Rows with a null id stay, since nothing names them; of rows that share an id all go if any contains an
    item.  Null texts contain nothing; empty tables on either side take nothing away; other columns stay as
    they are, whatever their names.
    """
    hits = contained_items(docs, benchmark, width, threshold, id_col, item_col, text_col)
    hits = materialize(hits.where(F.col(id_col).isNotNull()).select(id_col).distinct(), "hits")
    return docs.join(hits, id_col, "left_anti").select(*docs.columns)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain benchmark items, with the items."""
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_OP7 = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM benchmark
), item_shingles AS (
  SELECT item_id, least(5, len(w)) AS width,
         unnest(list_distinct([array_to_string(w[i:i + least(5, len(w)) - 1], ' ') FOR i IN range(1, len(w) - least(5, len(w)) + 2)])) AS shingle
  FROM item_words WHERE len(w) > 0
), doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), doc_shingles AS (
  SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i + width - 1], ' ') FOR i IN range(1, len(w) - width + 2)]) AS shingle
  FROM doc_words, (SELECT DISTINCT width FROM item_shingles)
), sizes AS (
  SELECT item_id, count(*) AS n_shingles FROM item_shingles GROUP BY item_id
)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_shingles) AS n_shingles, count(*) / any_value(n_shingles) AS containment
FROM doc_shingles JOIN item_shingles USING (shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING 10 * count(*) >= 8 * any_value(n_shingles)
"""
