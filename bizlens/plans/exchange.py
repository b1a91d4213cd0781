"""Reports over files that the library itself writes and reads back: quoted CSV, one output per region, report
bundles, the sales export, quarantined rows, product listings.  Every one starts from the given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_valid_email
from ..operators import quarantine as QU
from ..operators import quality as Q
from ..sources import csv as C
from ..sources import pages as PG
from ..sources import quoted_csv as QC
from ..sources import sinks as S
from ..sources.scratch import materialize, shared_path
from . import cleaning
from . import views as V

SPLIT_BYTES = 64 << 10


# --------------------------------------------------------------------------- A3 / G3 / L24: quoted line breaks
def documents_csv(t, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """documents through quoted CSV files, whose texts keep their line breaks, and back by small splits."""
    d = t["documents"].select("doc_id", "text", "lang", "source", "n_chars")
    path = shared_path(t.spark, "documents-csv")
    QC.write_quoted_csv(d, path)
    return QC.read_quoted_csv(t.spark, path, d.schema, split_bytes)


# --------------------------------------------------------------------------- A6
# Fixed value: the region whose orders are revised.
REVISED = "ASIA"


def _rows_and_sums(df: DataFrame) -> DataFrame:
    return df.groupBy("region").agg(F.count(F.lit(1)).alias("rows"), F.sum("total_amount").alias("amount"), F.count_if("revised").alias("revised_rows"),
                                    F.sum(F.col("order_id").cast("decimal(38,0)")).cast("double").alias("id_sum"))


def region_rewrite(t) -> DataFrame:
    """Orders by region, one output each; then one region's is replaced by its revised rows (delivered orders
    only, amounts with two more percent) and all are read back: rows, amount, revised rows, sum of ids."""
    geo = V.customer_geo(t).select("customer_id", "region")
    orders = V.orders(t).select("order_id", "customer_id", "status", "total_amount").join(geo, "customer_id")
    rows = orders.select("order_id", "status", "total_amount", F.lit(False).alias("revised"), "region")
    path = shared_path(t.spark, "regions")
    S.write_partitioned(rows, path, "region")
    own = t.spark.read.schema(rows.schema).parquet(path).where((F.col("region") == REVISED) & (F.col("status") == "delivered"))
    kind = rows.schema["total_amount"].dataType
    revised = materialize(own.withColumn("total_amount", F.round(F.col("total_amount") * F.lit("1.02").cast("decimal(3,2)"), 2).cast(kind)).withColumn("revised", F.lit(True)), "revised")
    S.rewrite_partitions(revised.select(*rows.columns), path, "region")
    return _rows_and_sums(t.spark.read.schema(rows.schema).parquet(path))


# --------------------------------------------------------------------------- A7
def report_bundle(t) -> DataFrame:
    """Three result tables published together as a bundle, a second version of it, and a third that dies after its first table;
    what a reader then finds: table, version, rows and a sum."""
    orders, items, products = V.orders(t).select("order_id", "status", "total_amount"), V.order_items(t).select("order_id", "product_id", "line_total"), V.products(t).select("product_id", "price")
    path = shared_path(t.spark, "bundle")
    S.publish_bundle({"orders": orders.where("status = 'delivered'"), "items": items.limit(0), "products": products.limit(0)}, path)
    version = S.publish_bundle({"orders": orders, "items": items, "products": products}, path)
    orders.limit(0).write.parquet(f"{path}/data/unfinished/orders")  # a write that died: no entry names it
    found = S.read_bundle(t.spark, path, verify=True)
    measures = {"orders": "total_amount", "items": "line_total", "products": "price"}
    one = lambda name: found[name].agg(F.count(F.lit(1)).alias("rows"), F.sum(measures[name]).alias("total")).select(
        F.lit(name).alias("table"), F.lit(version).cast("long").alias("version"), "rows", "total")
    return one("orders").unionByName(one("items")).unionByName(one("products"))


# --------------------------------------------------------------------------- K1-K6: the rows
def quarantined_rows(t) -> DataFrame:
    """Orders, customers and reviews that break stricter rules than the schema's, as (table, key, broken): order amounts
    under 1,000, order customers that have a review, mixed-case statuses, e-mails of one region, unique city names, ratings given once."""
    c = F.col
    cust, orders, rev = V.customers(t), V.orders(t), V.reviews(t)
    geo = V.customer_geo(t).select("customer_id", "region")
    parts = [
        ("orders", "order_id", QU.broken_rules(
            orders.select("order_id", "customer_id", "status", "total_amount"),
            {"total_amount >= 1000": c("total_amount") >= 1000, "status in list": c("status").isin("delivered", "processing", "pending"), **Q.not_null_rules(["customer_id"])},
            [["order_id"]], [("customer_id", rev, "customer_id")])),
        ("customers", "customer_id", QU.broken_rules(
            cust.select("customer_id", "email", "first_name").join(geo, "customer_id"),
            {"email_format": is_valid_email(c("email")), "region isn't EUROPE": c("region") != "EUROPE"}, [["customer_id"], ["email"]], [("customer_id", orders, "customer_id")])),
    ]
    out = None
    for name, key, marked in parts:
        rows = marked.where(F.size("broken") > 0).select(F.lit(name).alias("table"), c(key).cast("long").alias("key"), F.array_join("broken", "; ").alias("broken"))
        out = rows if out is None else out.unionByName(rows)
    return out


# --------------------------------------------------------------------------- A1, A5, B13, H16, H23, H24, L18: the sales export
def sales_export(t) -> DataFrame:
    """Line items as a spreadsheet export would spell them, all text: dates in four layouts and impossible ones, prices with
    signs, thousands and markers, quantities with fractions, suffixes and markers; every ninth line of an order comes twice."""
    o = t["orders"].select(F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("day"))
    lines = t["lineitem"].select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), "l_quantity", F.col("l_extendedprice").cast("decimal(12,2)").alias("price"), "l_returnflag", F.concat(F.lower("l_linestatus"), F.lit("-line o'part")).alias("item"))
    kind = (F.col("k") * 7 + F.col("n")) % 12
    text = lambda fmt: F.date_format("day", fmt)
    date = (F.when(kind < 4, text("yyyy-MM-dd")).when(kind < 6, text("MM/dd/yyyy")).when(kind < 8, text("dd.MM.yyyy")).when(kind < 10, text("dd-MMM-yyyy"))
             .when(kind == 10, "2020-02-31").otherwise("N/A"))
    plain = F.col("price").cast("string")
    # thousands by a comma, from the digits: no locale takes part
    whole, cents = F.floor("price").cast("long"), F.lpad(((F.col("price") * 100) % 100).cast("long").cast("string"), 2, "0")
    comma = F.when(whole >= 1000, F.concat((F.floor(whole / 1000)).cast("string"), F.lit(","), F.lpad((whole % 1000).cast("string"), 3, "0"))).otherwise(whole.cast("string"))
    price = (F.when(kind < 5, plain).when(kind < 8, F.concat(F.lit("$"), comma, F.lit("."), cents)).when(kind == 8, F.concat(F.lit("-"), plain))
              .when(kind == 9, F.concat(plain, F.lit("d"))).when(kind == 10, "nan").otherwise(F.concat(F.lit(" "), plain, F.lit(" "))))
    qty = F.col("l_quantity").cast("int")
    quantity = (F.when(kind < 6, qty.cast("string")).when(kind < 8, F.concat(qty.cast("string"), F.lit(".5"))).when(kind == 8, "0x1p3").when(kind == 9, F.concat(qty.cast("string"), F.lit("000")))
                 .when(kind == 10, "-").otherwise(F.concat(qty.cast("string"), F.lit("f"))))
    category = F.when(kind % 3 == 0, " electornics").when(kind % 3 == 1, "Home  &\tgarden ").otherwise(F.col("item"))
    region = F.when(F.col("l_returnflag") == "A", "n").when(F.col("l_returnflag") == "N", "SOUTH").otherwise(" mid  west")
    rows = lines.join(o, "k").select(
        (F.col("k") * 10 + F.col("n")).cast("string").alias("order_id"), date.alias("date"), category.alias("category"), F.col("item").alias("product_name"),
        quantity.alias("quantity"), price.alias("unit_price"), region.alias("region"), F.concat(F.lit("clerk "), (F.col("k") % 10).cast("string")).alias("salesperson"),
        F.when(F.col("n") % 9 == 1, F.lit(2)).otherwise(1).alias("copies"))
    return rows.withColumn("copies", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies")


# the column, and its text before cleaning
CHECKED = ["date", "quantity", "unit_price"]


def cleaned_sales(t) -> DataFrame:
    """L18 on a sales export: written as CSV (A5), read as text with its markers (A1), cleaned; ``rejected`` names
    the cells that held text but no valid value (H16, H23, H24, B13)."""
    path = shared_path(t.spark, "sales-export")
    S.write_csv(sales_export(t), path)
    raw = C.read_sales_csv(t.spark, path, cleaning.SALES_COLUMNS).dropDuplicates()
    cleaned = cleaning.clean_rows(raw.select("*", *[F.col(c).alias(f"_{c}") for c in CHECKED]))
    rejected = F.concat_ws(" ", *(F.when(F.col(f"_{c}").isNotNull() & F.col(c).isNull(), F.lit(c)) for c in CHECKED))
    return cleaned.withColumn("rejected", rejected).drop(*[f"_{c}" for c in CHECKED])


# --------------------------------------------------------------------------- A4 / L25, H29: product listings
def listing_pages(t) -> DataFrame:
    """Pages of the given table with a shop's listing put before their article: two products each, the second one's article inside the
    first one's description, with ``>`` in attributes; prices, rating words, availability from the page's id."""
    p = t["pages"]
    n = F.col("page_id")
    words = F.element_at(F.array(*map(F.lit, ("One", "Two", "Three", "Four", "Five", "Many"))), (F.pmod(n, F.lit(6)) + 1).cast("int"))
    price = lambda k: F.concat((F.pmod(n * k, F.lit(90)) + 10).cast("string"), F.lit("."), F.lpad(F.pmod(n * 7, F.lit(100)).cast("string"), 2, "0"))

    def pod(title: Column, cost: Column, rating: Column, inner: Column) -> Column:
        return F.concat(F.lit('<article class="product_pod" data-rule="a>b"><p class="star-rating '), rating, F.lit('"></p><h3><a href="x/'), n.cast("string"),
                        F.lit('/index.html" title="'), title, F.lit('">short</a></h3><p class="price_color">£'), cost, F.lit('</p>'), inner, F.lit("</article>"))

    inner = pod(F.concat(F.lit("part &amp; "), n.cast("string")), price(3), F.lit("Two"), F.lit('<p class="instock availability"> In  stock </p>'))
    outer = pod(F.concat(F.lit("set > "), n.cast("string")), price(1), words, F.concat(F.lit("<div>"), inner, F.lit("</div>")))
    return p.select("page_id", "url", F.concat(F.lit("<section>"), outer, F.lit("</section>"), F.coalesce("html", F.lit(""))).alias("html"))


def product_records(t) -> DataFrame:
    """The product records of listing pages with nested articles."""
    return PG.nested_records(listing_pages(t))
