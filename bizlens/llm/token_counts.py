"""Token counts through a digest cache.

A document's key is the SHA-256 of its normalised content (null counts as empty; nothing else
is changed, since any other change could change the count) and the digest of the tokenizer's
file and library version.  Keys are joined to the counts stored in a Parquet table; only
distinct misses are encoded, and their counts are appended to the table.
"""

from __future__ import annotations

import hashlib
from importlib.metadata import version

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.llm.common import scratch_path, ship_package, table, text_or_empty
from bizlens.llm.tokens import batches, encoder, tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
CACHE_SCHEMA = "content_digest binary, n_tokens long, tokenizer_digest string"


def tokenizer_digest(name: str) -> str:
    """SHA-256 of the tokenizer's file and of its library's name and version."""
    path = tokenizer_path(name)
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + f"\n{library} {version(library)}".encode()).hexdigest()


def _encode(tokenizer: str):
    def run(parts):
        import pyarrow as pa

        enc = encoder(tokenizer)
        for part in parts:
            digests, texts = part.column(0), part.column(1).to_pylist()
            counts = [len(ids) // 4 for s in batches(texts) for ids in enc.encode(texts[s])]
            yield pa.RecordBatch.from_arrays([digests, pa.array(counts, pa.int64())], ["content_digest", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, cache_path: str, tokenizer: str = TOKENIZER, limit: int = LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit, content_digest.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows each get a row; null ids stay;
    other columns are ignored whatever their names; an empty table gives an empty result.  Texts
    are encoded whole, whatever their length.  The cache at ``cache_path`` is created when it
    isn't there; doubled entries (two runs appending at once) do no harm.
    """
    spark = docs.sparkSession
    ship_package(spark)
    digest = tokenizer_digest(tokenizer)
    text = text_or_empty(text_col)
    keyed = docs.select(F.col(id_col), text.alias("_text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("content_digest"),
                        F.lit(digest).alias("tokenizer_digest"))
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").partitionBy("tokenizer_digest").parquet(cache_path)

    def stored() -> DataFrame:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer_digest") == digest)
        return rows.groupBy("content_digest", "tokenizer_digest").agg(F.max("n_tokens").alias("n_tokens"))

    # copies meet first inside each task (partial aggregate), so a hot text is sent once by each
    distinct = keyed.groupBy("content_digest", "tokenizer_digest").agg(F.first("_text").alias("_text"))
    misses = distinct.join(stored(), ["content_digest", "tokenizer_digest"], "left_anti").select("content_digest", "_text")
    (misses.mapInArrow(_encode(tokenizer), "content_digest binary, n_tokens long")
     .withColumn("tokenizer_digest", F.lit(digest)).write.mode("append").partitionBy("tokenizer_digest").parquet(cache_path))
    rows = keyed.select(id_col, F.octet_length("_text").cast("long").alias("n_bytes"), "content_digest", "tokenizer_digest")
    return (rows.join(stored(), ["content_digest", "tokenizer_digest"])
            .select(id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), F.hex("content_digest").alias("content_digest")))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document; the cache starts empty and lies in the shared folder."""
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), scratch_path(spark, "token-cache"))
