"""Business views over the driver tables.

The reference works on an e-commerce schema (customers, orders, order_items,
products, categories, inventory, reviews).  The test data is TPC-H shaped, so
each business table is a projection of driver tables.  Every view is a lazy
DataFrame: columns a report does not use are pruned before the scan.

The DuckDB twins of these definitions live in ``bizlens.plans.oracle`` and
must stay in step with this file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import money

# Statuses that do not count as revenue (reference filter on every revenue query).
EXCLUDED_STATUSES = ("cancelled", "refunded")


def customers(t) -> DataFrame:
    """customer ⋈ nation ⋈ region.  nation and region are tiny dimensions; the
    planner broadcasts them from their measured size (no hint needed)."""
    c, n, r = t["customer"], t["nation"], t["region"]
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    return (c.join(geo, c.c_nationkey == geo.n_nationkey, "left")
             .select(c.c_custkey.alias("customer_id"),
                     c.c_name.alias("first_name"),
                     c.c_mktsegment.alias("last_name"),
                     F.concat(F.lit("cust"), c.c_custkey.cast("string"), F.lit("@example.com")).alias("email"),
                     geo.n_name.alias("city"),
                     geo.r_name.alias("country"),
                     c.c_nationkey.alias("nation_id"),
                     c.c_acctbal.alias("acctbal")))


def order_status(code: Column, key: Column) -> Column:
    """Status names from the order status code; P orders with key % 10 = 0 count as cancelled."""
    return (F.when(code == "F", "delivered")
             .when(code == "O", "processing")
             .when((code == "P") & (key % 10 == 0), "cancelled")
             .when(code == "P", "pending"))


def orders(t) -> DataFrame:
    """orders view: order_id, customer_id, status, total_amount, order_date, priority."""
    o = t["orders"]
    return o.select(o.o_orderkey.alias("order_id"),
                    o.o_custkey.alias("customer_id"),
                    order_status(o.o_orderstatus, o.o_orderkey).alias("status"),
                    money(o.o_totalprice).alias("total_amount"),
                    o.o_orderdate.alias("order_date"),
                    o.o_orderpriority.alias("priority"))


def valid_orders(t) -> DataFrame:
    """B2: orders whose status counts as revenue."""
    o = orders(t)
    return o.where(~o.status.isin(*EXCLUDED_STATUSES))


def line_total(extended_price: Column, discount: Column) -> Column:
    """Extended price × (1 − discount fraction), in decimal, rounded to cents."""
    gross = extended_price.cast("decimal(12,2)")
    net = gross * (F.lit(1) - discount.cast("decimal(4,2)"))
    return F.round(net, 2).cast("decimal(12,2)")


def line_total_percent(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """B10, percent form: quantity × unit price × (1 − percent / 100), in decimal, rounded to cents."""
    net = quantity.cast("decimal(10,0)") * unit_price.cast("decimal(10,2)") * (F.lit(100) - discount_pct.cast("decimal(5,2)")) / F.lit(100)
    return F.round(net, 2).cast("decimal(12,2)")


def order_items(t) -> DataFrame:
    """order_items view: one row per line item with the decimal line total."""
    li = t["lineitem"]
    return li.select(li.l_orderkey.alias("order_id"),
                     li.l_partkey.alias("product_id"),
                     li.l_suppkey.alias("supplier_id"),
                     li.l_linenumber.alias("line_no"),
                     li.l_quantity.cast("int").alias("quantity"),
                     li.l_discount.cast("decimal(4,2)").alias("discount"),
                     money(li.l_extendedprice).alias("gross"),
                     line_total(li.l_extendedprice, li.l_discount).alias("line_total"),
                     li.l_tax.alias("tax"),
                     li.l_shipdate.alias("ship_date"))


def products(t) -> DataFrame:
    """products view over part (category = part type)."""
    p = t["part"]
    return p.select(p.p_partkey.alias("product_id"),
                    p.p_name.alias("name"),
                    p.p_type.alias("category"),
                    p.p_brand.alias("brand"),
                    money(p.p_retailprice, 10).alias("price"),
                    F.concat(F.lit("SKU-"), p.p_partkey.cast("string")).alias("sku"),
                    (p.p_partkey % 20 != 0).alias("is_active"),
                    p.p_size.alias("size"))


def inventory(t) -> DataFrame:
    """inventory view over part: stock, reorder level and reorder quantity."""
    p = t["part"]
    return p.select(p.p_partkey.alias("product_id"),
                    (p.p_size - 1).alias("quantity"),
                    (F.lit(10) + p.p_partkey % 20).cast("int").alias("reorder_level"),
                    F.lit(50).alias("reorder_quantity"))


def product_stock(t) -> DataFrame:
    """Products with their inventory: both views are projections of ``part``, so one scan gives both."""
    p = t["part"]
    return p.select(p.p_partkey.alias("product_id"), F.concat(F.lit("SKU-"), p.p_partkey.cast("string")).alias("sku"), p.p_name.alias("name"),
                    (p.p_size - 1).alias("quantity"), (F.lit(10) + p.p_partkey % 20).cast("int").alias("reorder_level"), F.lit(50).alias("reorder_quantity"))


def reviews(t) -> DataFrame:
    """events → reviews; product id spreads events over all parts."""
    e = t["events"]
    n_parts = t["part"].select(F.count(F.lit(1))).scalar()
    return e.select(e.event_id.alias("review_id"),
                    ((e.event_id * 7) % n_parts).alias("product_id"),
                    e.user_id.alias("customer_id"),
                    (F.lit(1) + e.event_id % 5).cast("int").alias("rating"),
                    e.ts.alias("created_at"))


def shipments(t) -> DataFrame:
    """Per order: shipped = first ship date, delivered = last ship date (not before the order)."""
    o = orders(t)
    li = t["lineitem"].select("l_orderkey", "l_shipdate")
    j = li.join(o.select("order_id", "order_date"), li.l_orderkey == o.order_id)
    per_order = (j.where(j.l_shipdate >= j.order_date)
                  .groupBy("l_orderkey")
                  .agg(F.min("l_shipdate").alias("shipped_date"), F.max("l_shipdate").alias("delivered_date")))
    return o.join(per_order, o.order_id == per_order.l_orderkey, "left").drop("l_orderkey")


def sales(t, *, with_product: bool = True, with_customer: bool = True) -> DataFrame:
    """Flat transaction lines for the case-study reports (all statuses).

    One row per line item that has an order: order, date, month, customer
    (name, country = nation, region), product (name, category = part type),
    quantity, discount (fraction) and revenue = quantity × price × (1 −
    discount).  Product and customer attributes are optional (left joins), so
    reports may aggregate to a key first and attach the attribute afterwards.
    Prefer the reduced forms below for single-dimension reports.
    """
    i = order_items(t).select("order_id", "product_id", "quantity", "discount", "line_total")
    o = orders(t).select("order_id", "customer_id", F.to_date("order_date").alias("date"))
    f = i.join(o, "order_id").withColumn("month", F.trunc("date", "MM")).withColumnRenamed("line_total", "revenue")
    if with_product:
        p = products(t).select("product_id", F.col("name").alias("product"), "category")
        f = f.join(p, "product_id", "left")
    if with_customer:
        f = f.join(customer_geo(t), "customer_id", "left")
    return f


def customer_geo(t) -> DataFrame:
    """customer_id -> customer_name, country (nation), region."""
    return customers(t).select("customer_id", F.col("first_name").alias("customer_name"),
                               F.col("city").alias("country"), F.col("country").alias("region"))


def order_lines(t) -> DataFrame:
    """Per order with its header (all statuses): revenue, line count, units.

    The line items are reduced per order by a partial aggregation before the
    shuffle on ``order_id``; the join with ``orders`` reuses that partitioning.
    A line without an order is dropped, as in ``sales``.
    """
    lines = (order_items(t).groupBy("order_id")
             .agg(F.sum("line_total").alias("revenue"), F.count(F.lit(1)).alias("lines"),
                  F.sum("quantity").alias("units")))
    o = orders(t).select("order_id", "customer_id", F.to_date("order_date").alias("date"))
    return lines.join(o, "order_id").withColumn("month", F.trunc("date", "MM"))


def product_month_lines(t) -> DataFrame:
    """Per (product, month) over lines that have an order: revenue, lines, units."""
    i = order_items(t).select("order_id", "product_id", "line_total", "quantity")
    o = orders(t).select("order_id", F.trunc(F.to_date("order_date"), "MM").alias("month"))
    return (i.join(o, "order_id").groupBy("product_id", "month")
             .agg(F.sum("line_total").alias("revenue"), F.count(F.lit(1)).alias("lines"),
                  F.sum("quantity").alias("units")))
