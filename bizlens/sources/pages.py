"""A4: records from stored HTML pages, with JVM regular expressions only.

Pages arrive as a table ``(page_id, url, html)`` (fetching is out of scope).
Comments, scripts and styles are removed first, so markup inside them (a
``"</p>"`` in a script, a commented-out product) cannot leak into fields.
Fragments are cut with ``regexp_extract_all`` and exploded, so a page with
many products yields many rows and every page is handled by its own task.

The patterns stay inside the common subset of Java and RE2 regular
expressions so the DuckDB oracle can use the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import rating_value

# Comments, scripts and styles in one leftmost-match pass: a "<!--" inside a
# script is script text, as an HTML parser reads it.  One that is never closed
# runs to the end of the page.
NOISE = r"(?is)<!--.*?(?:-->|\z)|<script[^>]*>.*?(?:</script>|\z)|<style[^>]*>.*?(?:</style>|\z)"
# HTML entities decoded in extracted text (``&amp;`` last).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def strip_noise(html: Column) -> Column:
    """Remove comments, scripts and styles from a page."""
    return F.regexp_replace(html, NOISE, "")


def decode_entities(text: Column) -> Column:
    """The common named / numeric entities of the fixed list, ``&amp;`` last."""
    for ent, ch in ENTITIES:
        text = F.replace(text, F.lit(ent), F.lit(ch))
    return text


def tag_text(fragment: Column) -> Column:
    """Visible text of a fragment: tags removed, entities decoded, whitespace
    collapsed and stripped (like ``get_text(strip=True)`` on a leaf)."""
    t = decode_entities(F.regexp_replace(fragment, r"<[^>]*>", " "))
    return F.regexp_replace(F.regexp_replace(t, r"\s+", " "), r"^ | $", "")


def section(html: Column, tag: str) -> Column:
    """Inner HTML of the first ``<tag>`` (to its end tag, or to the end of the page
    when the tag is never closed)."""
    return F.regexp_extract(html, rf"(?s)<{tag}[^>]*>(.*?)(</{tag}>|\z)", 1)


def count_tags(fragment: Column, tag: str) -> Column:
    """Number of ``<tag>`` openings in a fragment."""
    return F.size(F.regexp_extract_all(fragment, F.lit(rf"<{tag}[\s>/]"), 0))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words (0 for empty text)."""
    return F.when(text == "", F.lit(0)).otherwise(F.size(F.split(text, r"\s+")))


def host_of(url: Column) -> Column:
    """Host part of a URL."""
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)", 1)


def cleaned(pages: DataFrame) -> DataFrame:
    """(page_id, url, _h): pages without noise, for several extractions from one pass."""
    return pages.select("page_id", "url", strip_noise(F.col("html")).alias("_h"))


def page_records(pages: DataFrame) -> DataFrame:
    """One record per stored page: host, language, title (first ``h1``, else
    ``N/A``), navigation links, paragraphs and words of the article."""
    clean = cleaned(pages)
    art = section(F.col("_h"), "article")
    title = tag_text(section(F.col("_h"), "h1"))
    text = tag_text(art)
    return clean.select(
        "page_id", host_of(F.col("url")).alias("host"),
        F.regexp_extract("_h", r'<html[^>]*\slang="([^"]*)"', 1).alias("lang"),
        F.when(title == "", F.lit("N/A")).otherwise(title).alias("title"),
        count_tags(section(F.col("_h"), "nav"), "a").alias("nav_links"),
        count_tags(art, "p").alias("paragraphs"),
        word_count(text).alias("words"))


# ----------------------------------------------------------------------------- product listings
POD = r'(?s)<article[^>]*class="[^"]*product_pod[^"]*"[^>]*>(.*?)</article>'


def _attr_after(fragment: Column, prefix: str, attr: str) -> Column:
    return F.regexp_extract(fragment, rf'(?s){prefix}.*?<a\s[^>]*{attr}="([^"]*)"', 1)


def detail_key(href_or_url: Column) -> Column:
    """Join key of a product detail page: ``<slug>/index.html``."""
    return F.regexp_extract(href_or_url, r"([^/]+/index\.html)$", 1)


def pod_fields(pod: Column) -> list[Column]:
    """Title, price, rating, availability and detail key of a product's fragment."""
    title = decode_entities(_attr_after(pod, r"<h3[^>]*>", "title"))  # attribute values are entity-decoded
    href = _attr_after(pod, r"<h3[^>]*>", "href")
    price_txt = F.regexp_extract(pod, r'class="[^"]*price_color[^"]*"[^>]*>([^<]*)<', 1)
    price = F.replace(F.replace(F.trim(price_txt), F.lit("£"), F.lit("")), F.lit("Â"), F.lit("")).try_cast("double")
    word = F.regexp_extract(pod, r'<p[^>]*class="star-rating\s+([A-Za-z]+)', 1)
    avail_frag = F.regexp_extract(pod, r'(?s)class="[^"]*availability[^"]*"[^>]*>(.*?)</p>', 1)
    has_avail = pod.rlike(r'class="[^"]*availability')
    return [F.when(title == "", F.lit("N/A")).otherwise(title).alias("title"), price.alias("price"), rating_value(word).cast("int").alias("rating"),
            F.when(has_avail, tag_text(avail_frag)).otherwise(F.lit("Unknown")).alias("availability"), detail_key(href).alias("_key")]


# An article tag, opening or closing; quoted attribute values may hold ``>``.
ARTICLE = r"""(?i)</?article(?:\s(?:"[^"]*"|'[^']*'|[^'">])*+)?>"""


def nested_records(pages: DataFrame) -> DataFrame:
    """A4 / L25 with nesting: (page_id, pod_no, title, price, rating, availability) of every ``article.product_pod``,
    also of those inside another one.

    A page's article tags are a stream; a running sum of openings less closings is the depth.  The text after
    a tag belongs to the last article opened at the depth that holds there, so an
    article's own text is what stands in it and in no article inside it.  ``pod_no`` counts a page's products
    by their opening tags, from 0.  An article that is never closed runs to the end of its page.
    """
    clean = cleaned(pages)
    tags = F.arrays_zip(F.regexp_extract_all("_h", F.lit(ARTICLE), F.lit(0)).alias("tag"), F.slice(F.split("_h", ARTICLE, -1), 2, 1 << 30).alias("after"))
    numbered = clean.withColumn("_page", F.monotonically_increasing_id())  # ids of pages may repeat
    stream = numbered.select("page_id", "_page", F.posexplode(tags).alias("_i", "_t"))
    closing = F.col("_t.tag").startswith("</")
    in_page = Window.partitionBy("_page").orderBy("_i")
    stream = stream.withColumn("_depth", F.sum(F.when(closing, -1).otherwise(1)).over(in_page))
    at_depth = Window.partitionBy("_page", "_depth").orderBy("_i")
    owned = stream.withColumn("_owner", F.max(F.when(~closing, F.col("_i"))).over(at_depth)).where(F.col("_depth") > 0)
    pods = owned.groupBy("page_id", "_page", "_owner").agg(F.min(F.struct("_i", F.col("_t.tag").alias("tag"))).alias("open"),
                                                           F.array_sort(F.collect_list(F.struct("_i", F.col("_t.after").alias("after")))).alias("all"))
    pods = pods.where(F.col("open.tag").rlike(r'\sclass="[^"]*product_pod'))
    pods = pods.select("page_id", (F.row_number().over(Window.partitionBy("_page").orderBy("_owner")) - 1).alias("pod_no"),
                       F.array_join(F.transform("all", lambda x: x["after"]), " ").alias("_pod"))
    return pods.select("page_id", "pod_no", *pod_fields(F.col("_pod"))).drop("_key")


def extract_records(pages: DataFrame, with_category: bool = True) -> DataFrame:
    """Every ``article.product_pod`` → (title, price, rating,
    availability, category).

    Missing title -> ``N/A``; missing availability -> ``Unknown``; rating word
    unknown or missing -> 0; missing price -> NULL.  The category is the third
    breadcrumb link of the product's stored detail page (matched by its
    ``<slug>/index.html`` path), else ``Unknown``.
    """
    clean = cleaned(pages)
    pods = clean.select("page_id", "url", F.posexplode(F.regexp_extract_all("_h", F.lit(POD), 1))
                        .alias("pod_no", "_pod"))
    recs = pods.select("page_id", "pod_no", *pod_fields(F.col("_pod")))
    if not with_category:
        return recs.withColumn("category", F.lit("Unknown")).drop("_key")
    trail = F.regexp_extract("_h", r'(?s)<ul[^>]*class="[^"]*breadcrumb[^"]*"[^>]*>(.*?)</ul>', 1)
    crumbs = F.regexp_extract_all(trail, F.lit(r"(?s)<a[^>]*>(.*?)</a>"), 1)
    details = (clean.select(detail_key(F.col("url")).alias("_key"),
                            F.when(F.size(crumbs) >= 3, tag_text(F.element_at(crumbs, 3))).alias("_cat"))
                    .where(F.col("_key") != "")
                    .groupBy("_key").agg(F.first("_cat", ignorenulls=True).alias("_cat")))
    return (recs.join(details, "_key", "left")
                .withColumn("category", F.coalesce(F.col("_cat"), F.lit("Unknown")))
                .drop("_key", "_cat"))


def records_summary(records: DataFrame) -> DataFrame:
    """Number of records, average price, average rating, distinct categories."""
    return records.agg(F.count(F.lit(1)).alias("records"), F.round(F.avg("price"), 2).alias("avg_price"),
                       F.round(F.avg("rating"), 1).alias("avg_rating"),
                       F.count_distinct("category").alias("categories"))
