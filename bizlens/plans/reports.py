"""Dashboard and case-study reports over the flat ``sales`` lines:

L14 fulfilment time, L20 monthly KPI report (KPIs by year, shares, region
detail with TOTAL rows), L21 sales dashboard (region table, dense trend),
L22 criteria cells, L32 monthly trends with new customers, L33 executive
breakdowns, L34 top products per country.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import criteria as C
from ..operators import lookups as L
from ..operators import windows as W
from . import views as V
from ..functions import dates as D
from ..functions import text as X
from ..operators.selection import group_percentiles
from .common import money_div, round_ratio


# --------------------------------------------------------------------------- L14
def fulfilment_times(t, approx: bool = False) -> DataFrame:
    """Per order month: delivered orders, average hours to ship, average and
    median days to deliver (epoch differences; averages rounded exactly).

    The exact median comes by distributed selection, whatever the number of distinct values
    of a month; ``approx=True`` uses a bounded sketch instead.
    """
    s = V.shipments(t).where((F.col("status") == "delivered") & F.col("shipped_date").isNotNull()
                             & F.col("delivered_date").isNotNull())
    ship_s = F.timestamp_diff("SECOND", F.col("order_date"), F.col("shipped_date"))
    deliver_s = F.timestamp_diff("SECOND", F.col("order_date"), F.col("delivered_date"))
    days = D.days_between_exact(F.col("order_date"), F.col("delivered_date"))
    g = s.groupBy(D.month_start(F.col("order_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("delivered_orders"), F.sum(ship_s).alias("_ship"), F.sum(deliver_s).alias("_del"),
        *([F.percentile_approx(days, 0.5, 10000).alias("_median")] if approx else []))
    if not approx:
        medians = group_percentiles(s.select(D.month_start(F.col("order_date")).alias("month"), days.alias("days")), ["month"], "days", [0.5])
        g = g.join(medians.withColumnRenamed("p0", "_median"), "month")
    n = F.col("delivered_orders")
    out = g.select("month", "delivered_orders",
                   round_ratio(F.col("_ship"), n * 3600, 1).alias("avg_hours_to_ship"),
                   round_ratio(F.col("_del"), n * 86400, 1).alias("avg_days_to_deliver"),
                   F.round("_median", 1).alias("median_days_to_deliver"))
    return out


# --------------------------------------------------------------------------- L20
def kpis_by_year(t) -> DataFrame:
    """L20 KPI cards per year: revenue, units, H1/H2 growth (0 when H1 is 0), top
    product and top region, average revenue per month (fixed divisor 12), and
    the texts that the cards show (H31).

    Each part is reduced to its join key before the dimension is attached:
    lines -> (product, month) -> name; lines -> order -> (customer, year) -> region.
    """
    per_order = V.order_lines(t).withColumn("year", F.year("date"))
    base = A.half_year_growth(per_order, ["year"], "date", "revenue", F.sum("revenue").alias("total_revenue"),
                              F.sum("units").alias("total_units"))
    by_prod = (V.product_month_lines(t).groupBy(F.year("month").alias("year"), "product_id").agg(F.sum("revenue").alias("rev"))
               .join(V.products(t).select("product_id", F.col("name").alias("product")), "product_id", "left")
               .groupBy("year", "product").agg(F.sum("rev").alias("rev")))
    by_cust = per_order.groupBy("year", "customer_id").agg(F.sum("revenue").alias("rev"))
    by_reg = (by_cust.join(V.customer_geo(t).select("customer_id", "region"), "customer_id", "left")
                     .groupBy("year", "region").agg(F.sum("rev").alias("rev")))
    out = (base.join(A.top_by(by_prod, ["year"], "product", "rev", "top_product"), "year")
               .join(A.top_by(by_reg, ["year"], "region", "rev", "top_region"), "year"))
    per_month = money_div(F.col("total_revenue"), F.lit(12), 2)
    return out.select("year", "total_revenue", "total_units", F.col("h1").alias("h1_revenue"), F.col("h2").alias("h2_revenue"),
                      "growth", "top_product", "top_region", per_month.alias("avg_revenue_per_month"),
                      X.money_text(F.col("total_revenue")).alias("revenue_text"), X.percent_text(F.col("growth"), 1).alias("growth_text"))


def geo_totals(t, key: str) -> DataFrame:
    """(key, revenue, orders = lines, units) for a customer attribute, reduced per
    order and per customer before the customer dimension is joined."""
    per_cust = (V.order_lines(t).groupBy("customer_id")
                 .agg(F.sum("revenue").alias("revenue"), F.sum("lines").alias("orders"),
                      F.sum("units").alias("units")))
    return (per_cust.join(V.customer_geo(t).select("customer_id", key), "customer_id", "left")
                    .groupBy(key).agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"),
                                      F.sum("units").alias("units")))


def product_totals(t) -> DataFrame:
    """Per product over lines that have an order: revenue, lines, units."""
    i = V.order_items(t).select("order_id", "product_id", "line_total", "quantity")
    kept = i.join(V.orders(t).select("order_id"), "order_id", "left_semi")
    return (kept.groupBy("product_id")
             .agg(F.sum("line_total").alias("revenue"), F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units")))


def order_geo(t, *columns: str) -> DataFrame:
    """(order_id, month, columns): a customer's attributes on the order header, a frame of
    a fraction of the lines, so that lines meet one dimension less."""
    o = V.orders(t).select("order_id", "customer_id", D.month_start(F.col("order_date")).alias("month"))
    return o.join(V.customer_geo(t).select("customer_id", *columns), "customer_id", "left").drop("customer_id")


def category_totals(t) -> DataFrame:
    """(category, revenue, orders = lines), reduced per product before the product join."""
    per = product_totals(t).join(V.products(t).select("product_id", "category"), "product_id", "left")
    return per.groupBy("category").agg(F.sum("revenue").alias("revenue"), F.sum("lines").alias("orders"))


def breakdown(g: DataFrame) -> DataFrame:
    """L20/L33/L34 share table from (key, revenue, orders) totals: average, fraction of total (4 dp)."""
    g = g.select(*[c for c in g.columns if c != "units"])
    g = g.withColumn("avg_order_value", money_div(F.col("revenue"), F.col("orders"), 2))
    return W.share_of_total(g, "revenue", "share", scale=4, as_fraction=True)


def region_detail(t) -> DataFrame:
    """L20 per-region sheets: (month, product) lines plus a TOTAL line per region, from
    one GROUPING SETS aggregation.

    The region comes with the order header; lines are reduced to (region, product,
    month) before the product's name is attached.
    """
    i = V.order_items(t).select("order_id", "product_id", "quantity", "line_total")
    per_region = (i.join(order_geo(t, "region"), "order_id").groupBy("region", "product_id", "month")
                   .agg(F.sum("quantity").alias("units"), F.sum("line_total").alias("revenue")))
    named = per_region.join(V.products(t).select("product_id", F.col("name").alias("product")), "product_id", "left")
    return A.with_totals(named.select("region", "month", "product", "units", "revenue"), ["region", "month", "product"],
                         ["units", "revenue"], total_of="month", label_col="product")


# --------------------------------------------------------------------------- L21
def dashboard_regions(t) -> DataFrame:
    """L21 region table: SUMIFS / COUNTIFS per region and share in percent."""
    return W.share_of_total(geo_totals(t, "region"), "revenue", "share_pct")


def dashboard_trend(t) -> DataFrame:
    """L21 trend: every category × every month in the data range, zeros where empty."""
    pm = V.product_month_lines(t)
    facts = (pm.join(V.products(t).select("product_id", "category"), "product_id", "left")
               .groupBy("category", "month").agg(F.sum("revenue").alias("revenue"),
                                                  F.sum("lines").alias("orders")))
    # the range reads every column of the frame: the same plan, so its shuffles are done once
    bounds = facts.select(F.struct(F.min("month").alias("lo"), F.max("month").alias("hi"), F.count("category").alias("c"),
                                   F.sum("revenue").alias("r"), F.sum("orders").alias("o"))).scalar()
    grid = L.month_scaffold(V.products(t), ["category"], bounds["lo"], bounds["hi"])
    return L.fill_scaffold(grid, facts, ["category", "month"], ["revenue", "orders"])


def dashboard_kpis(t) -> DataFrame:
    """L21 / D11 KPI row: total, average per line, line count (COUNTA), units."""
    k = C.kpis(V.order_lines(t), "revenue", "order_id", "lines", 2, F.sum("units").alias("total_units"))
    return k.select(F.col("total").alias("total_revenue"), F.col("average").alias("avg_revenue"),
                    F.col("counta").alias("transactions"), "total_units")


# --------------------------------------------------------------------------- L22
CRITERIA_CELLS = {
    "revenue_europe": ("sum", "revenue", {"region": "EUROPE"}),
    "revenue_europe_promo": ("sum", "revenue", {"region": "=EUROPE", "category": "PROMO"}),
    "lines_germany": ("sum", "lines", {"country": "GERMANY"}),
    "lines_asia_qty25": ("sum", "lines", {"region": "ASIA", "quantity": ">=25"}),
    "lines_not_asia": ("sum", "lines", {"region": "<>ASIA"}),
    "avg_revenue_america": ("avg", "revenue", {"region": "AMERICA"}, "lines", 2),
    "avg_qty_small_africa": ("avg", "units", {"category": "SMALL", "region": "AFRICA"}, "lines", 4),
    "revenue_jan_1996": ("sum", "revenue", {"date": (dt.date(1996, 1, 1), dt.date(1996, 1, 31))}),
}


def criteria_report(t) -> DataFrame:
    """Criteria cells in one aggregation pass, each task sending one row of partial cells.

    Region and country come with the order header.
    """
    i = V.order_items(t).select("order_id", "product_id", "quantity", F.col("line_total").alias("revenue"))
    lines = (i.join(order_geo(t, "country", "region"), "order_id")
              .join(V.products(t).select("product_id", "category"), "product_id", "left"))
    lines = lines.select("region", "country", "category", "quantity", "revenue", F.col("month").alias("date"),
                         F.lit(1).alias("lines"), F.col("quantity").alias("units"))
    return C.criteria_cells(lines, CRITERIA_CELLS)


# --------------------------------------------------------------------------- L32-L34
def monthly_trends(t) -> DataFrame:
    """Lines, revenue, average and *new* customers per month.

    Works on per-order totals (lines reduced before the join with orders).
    New customers come from one grouping per customer (first month), counted
    per month and joined to the month table: no per-month distinct scan.
    """
    s = V.order_lines(t)
    m = s.groupBy("month").agg(F.sum("lines").alias("orders"), F.sum("revenue").alias("revenue"))
    first = s.groupBy("customer_id").agg(F.min("month").alias("month"))
    new = first.groupBy("month").agg(F.count(F.lit(1)).alias("new_customers"))
    return m.join(new, "month", "left").select(
        "month", "orders", F.round("revenue", 2).alias("revenue"),
        money_div(F.col("revenue"), F.col("orders"), 2).alias("avg_order_value"),
        F.coalesce("new_customers", F.lit(0)).alias("new_customers"))


def executive_kpis(t, approx: bool = False) -> DataFrame:
    """L33 headline: revenue, lines, average, distinct customers, top country and product.

    Orders are reduced to one row per customer and then to one per country; the
    headline, the number of customers and the top country are one aggregate of
    that frame.  ``approx=True`` counts distinct customers with a HyperLogLog
    sketch (D2 option).
    """
    per_cust = (V.order_lines(t).groupBy("customer_id")
                 .agg(F.sum("revenue").alias("revenue"), F.sum("lines").alias("lines")))
    by_c = (per_cust.join(V.customer_geo(t).select("customer_id", "country"), "customer_id", "left")
                    .groupBy("country").agg(F.sum("revenue").alias("rev"), F.sum("lines").alias("lines"),
                                            F.count("customer_id").alias("customers")))
    by_p = (product_totals(t).join(V.products(t).select("product_id", F.col("name").alias("product")),
                                   "product_id", "left")
                             .groupBy("product").agg(F.sum("revenue").alias("rev")))
    top_p = A.top_by(by_p, [], "product", "rev").scalar()
    best = F.min_by("country", F.struct(-F.col("rev"), F.col("country")))  # ties: first by name
    out = by_c.agg(F.sum("rev").alias("total_revenue"), F.sum("lines").alias("total_orders"),
                   F.sum("customers").alias("unique_customers"), best.alias("top_country"))
    if approx:
        sketch = V.order_lines(t).select(F.approx_count_distinct("customer_id")).scalar()
        out = out.withColumn("unique_customers", sketch)
    return out.select("*", top_p.alias("top_product"),
                      money_div(F.col("total_revenue"), F.col("total_orders"), 2).alias("avg_order_value"))


def country_top_products(t, n: int = 3) -> DataFrame:
    """Per country the n best product names by revenue, with their share of
    the country's revenue (4 dp).

    The country comes with the order header; lines are reduced to (country,
    product) before the product's name is attached.
    """
    i = V.order_items(t).select("order_id", "product_id", "line_total")
    per_id = (i.join(order_geo(t, "country").drop("month"), "order_id").groupBy("country", "product_id")
               .agg(F.sum("line_total").alias("revenue")))
    per = (per_id.join(V.products(t).select("product_id", F.col("name").alias("product")), "product_id", "left")
           .groupBy("country", "product").agg(F.sum("revenue").alias("revenue")))
    per = W.share_of_total(per, "revenue", "share_of_country", partition_cols=["country"], scale=4,
                           as_fraction=True)
    top = W.top_n_per_group(per, ["country"], [("revenue", False), ("product", True)], n, rank_col="rank")
    return top.select("country", "rank", "product", "revenue", "share_of_country")


def order_numbers(t) -> DataFrame:
    """sequence labels ORD-00001 ... of all orders by date (tie-break: order id)."""
    o = V.orders(t).select("order_id", F.to_date("order_date").alias("order_day"))
    return W.renumber(o, [("order_day", True), ("order_id", True)], "order_no")
