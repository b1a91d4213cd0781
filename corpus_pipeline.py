"""From raw documents to packed training sequences: five stages, each one operator of bizlens.llm.

Each stage is a function (spark, docs, sf_dir) -> DataFrame.  Its result is written as Parquet
in the shared folder and read again as the next stage's docs, so a lost executor costs no more
than the stage at work.  All stages but the last return the columns of docs.

Nulls, empty texts, repeated rows, empty tables and further columns: as each operator states.
Rows with a null id pass the stages that judge documents by their id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bizlens.llm.common import materialize, table
from bizlens.llm.decontamination import drop_contaminated
from bizlens.llm.packing import pack_documents
from bizlens.llm.quality_classifier import keep_quality
from bizlens.llm.secret_scans import redact_live
from bizlens.llm.simhash import keep_representatives


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-copies the document with the least id stays."""
    return keep_representatives(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Owner-specific, live-looking credentials are replaced in the texts; no document goes."""
    return redact_live(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("packing", packing),
]

#: Fingerprints, the fitted classifier and token ids are not expressible in SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, on the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
