"""Page extraction and summary over the stored ``pages`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import pages as P


def page_records(t) -> DataFrame:
    """One record per stored page (host, language, title, links, paragraphs, words)."""
    return P.page_records(t["pages"])


def page_summary(t) -> DataFrame:
    """Pages, titled pages, distinct hosts and languages, words and links, plus
    the product-record summary (D24) of any product listings among them."""
    r = P.page_records(t["pages"])
    s = r.agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("title") != "N/A").alias("titled_pages"),
              F.count_distinct("host").alias("hosts"), F.count_distinct("lang").alias("languages"),
              F.sum("words").alias("total_words"), F.sum("nav_links").alias("total_nav_links"))
    recs = P.records_summary(P.extract_records(t["pages"]))
    # one scalar subquery for the whole summary row (one extraction pass)
    rs = recs.select(F.struct(*recs.columns)).scalar()
    out = s.select("*", *[rs[c].alias(f"product_{c}") for c in recs.columns])
    return out
