"""L18 cleaning pipeline and L19 before/after quality report.

``clean_sales`` cleans a sales export (all strings, as ``read_sales_csv``
gives it) in the reference's order: missing-value markers -> drop exact
duplicates -> trim/collapse whitespace -> dates -> categories -> product names
-> regions -> price -> quantity.  The registered queries run the steps that
apply to running text (markers, duplicates, whitespace, mapping with fallback,
title case) over the given ``documents`` and ``conversations``, whole tables.

Duplicates: turns and sales are equal if all their columns are; documents if text,
language and source are, whatever their ids, and the first id stays.  A digest stands
for the text in the comparison.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as X
from ..operators import lookups as L
from ..operators import profile as P

# Known category spellings and their canonical names.
CATEGORY_MAP = {
    "electronics": "Electronics", "electornics": "Electronics", "elecronics": "Electronics",
    "clothing": "Clothing", "clothng": "Clothing",
    "home & garden": "Home & Garden", "home and garden": "Home & Garden", "home&garden": "Home & Garden",
    "sports": "Sports", "sprots": "Sports",
    "books": "Books", "boks": "Books",
    "toys": "Toys", "tys": "Toys",
}
# Region abbreviations and names.
REGION_MAP = {
    "n": "North", "north": "North", "s": "South", "south": "South",
    "e": "East", "east": "East", "w": "West", "west": "West",
}
SALES_COLUMNS = ["order_id", "date", "category", "product_name", "quantity", "unit_price", "region", "salesperson"]


def mark_missing(raw: DataFrame) -> DataFrame:
    """A1 semantics on an all-string frame: every NA marker becomes NULL."""
    return raw.select(*[X.na_to_null(F.col(c)).alias(c) for c in raw.columns])


def clean_rows(df: DataFrame) -> DataFrame:
    """The cleaning projections (steps 3-9) over de-duplicated string columns; further columns stay.

    Each step's columns are used several times by the next one, so Spark keeps the steps apart: every cell is
    squeezed once and every number parsed once, and no step's generated code is too long to be compiled.
    """
    more = [c for c in df.columns if c not in SALES_COLUMNS]
    squeezed = df.select(*[X.squeeze(F.col(c)).alias(c) for c in SALES_COLUMNS], *more)
    parsed = squeezed.withColumns({"date": D.parse_date_multi(F.col("date")), "quantity": X.plain_number(F.col("quantity")), "unit_price": X.price_number(F.col("unit_price"))})
    return parsed.select(
        F.col("order_id").try_cast("long").alias("order_id"), "date",
        L.map_with_fallback(F.col("category"), CATEGORY_MAP).alias("category"),
        X.proper(F.col("product_name")).alias("product_name"),
        X.valid_quantity(F.col("quantity")).alias("quantity"),
        X.valid_price(F.col("unit_price")).alias("unit_price"),
        L.map_with_fallback(F.col("region"), REGION_MAP).alias("region"),
        "salesperson", *more)


def clean_sales(raw: DataFrame) -> DataFrame:
    """``raw`` is all strings (as read by ``read_sales_csv``)."""
    return clean_rows(mark_missing(raw).dropDuplicates())


# Language codes and names.
LANGUAGE_MAP = {"en": "English", "de": "German", "fr": "French", "es": "Spanish"}


def _marked(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns with missing-value markers as NULL; other columns as they are."""
    return df.select(*[X.na_to_null(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])


def _row_key(df: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """The columns that make rows equal, with a digest for the text."""
    return df.select(*[F.sha2(F.col(c), 256).alias(c) if c == text else F.col(c) for c in columns])


def first_of_equals(df: DataFrame, columns: list[str], ids: list[str]) -> DataFrame:
    """G1: of rows equal in ``columns`` (NULLs equal) the one with the least ids stays, NULL ids last.

    One grouping on the columns, a digest for the text; tasks reduce their own copies first, so a
    row that a third of the table repeats is one row a task in the shuffle.
    """
    key = [F.sha2(F.col(c), 256).alias(f"_{c}") if c == "text" else F.col(c).alias(f"_{c}") for c in columns]
    order = F.struct(*[x for c in ids for x in (F.col(c).isNull(), F.col(c))])
    row = F.struct(*df.columns)
    kept = df.select(*key, order.alias("_ids"), row.alias("_row")).groupBy(*[f"_{c}" for c in columns]).agg(F.min_by("_row", "_ids").alias("_row"))
    return kept.select("_row.*")


def marked_documents(t) -> DataFrame:
    """documents with markers as NULL."""
    return _marked(t["documents"].select("doc_id", "text", "lang", "source"), ["text", "lang", "source"])


def marked_conversations(t) -> DataFrame:
    """conversations with markers as NULL."""
    return _marked(t["conversations"].select("conv_id", "turn", "role", "text"), ["role", "text"])


def cleaned_documents(t) -> DataFrame:
    """L18 over documents: first of equal rows, whitespace squeezed, language names
    with fallback, sources in title case."""
    d = first_of_equals(marked_documents(t), ["text", "lang", "source"], ["doc_id"])
    return d.select("doc_id", X.squeeze(F.col("text")).alias("text"), L.map_with_fallback(F.col("lang"), LANGUAGE_MAP).alias("lang"),
                    X.proper(X.squeeze(F.col("source"))).alias("source"))


def cleaned_conversations(t) -> DataFrame:
    """L18 over conversations: rows equal in all columns once, whitespace squeezed, roles in title case."""
    d = first_of_equals(marked_conversations(t), ["conv_id", "turn", "role", "text"], ["conv_id", "turn"])
    return d.select("conv_id", "turn", X.proper(X.squeeze(F.col("role"))).alias("role"), X.squeeze(F.col("text")).alias("text"))


# table, columns that are cleaned, columns that make rows equal, marked frame, cleaned frame
_TEXT_TABLES = [("documents", ["text", "lang", "source"], ["text", "lang", "source"], marked_documents, cleaned_documents),
                ("conversations", ["role", "text"], ["conv_id", "turn", "role", "text"], marked_conversations, cleaned_conversations)]


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def cleaning_null_report(t) -> DataFrame:
    """NULL count per column before and after cleaning."""
    def one(table, columns, equal, before, after):
        b = P.null_counts(before(t).select(*columns)).withColumnRenamed("nulls", "nulls_before")
        a = P.null_counts(after(t).select(*columns)).withColumnRenamed("nulls", "nulls_after")
        return b.join(a, "column").withColumn("table", F.lit(table))

    return _stack([one(*x) for x in _TEXT_TABLES])


def cleaning_summary(t) -> DataFrame:
    """L19 per table: rows before, duplicate rows (D21), rows after, total NULLs before and after."""
    def one(table, columns, equal, before, after):
        b, a = before(t), after(t)
        total = lambda df: P.null_counts(df.select(*columns)).select(F.sum("nulls")).scalar()
        rows = lambda df: df.select(F.count(F.lit(1))).scalar()
        return t.spark.range(1).select(
            F.lit(table).alias("table"), rows(b).alias("rows_before"), P.duplicate_count(_row_key(b, equal)).alias("duplicates_removed"),
            rows(a).alias("rows_after"), total(b).alias("nulls_before"), total(a).alias("nulls_after"))

    return _stack([one(*x) for x in _TEXT_TABLES])


def cleaning_value_counts(t) -> DataFrame:
    """Value counts of the cleaned language, source and role columns, NULL kept."""
    docs = P.value_counts(cleaned_documents(t), ["lang", "source"]).withColumn("table", F.lit("documents"))
    return docs.unionByName(P.value_counts(cleaned_conversations(t), ["role"]).withColumn("table", F.lit("conversations")))
