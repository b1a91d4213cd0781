"""Revenue reports: L1 daily, L2 monthly + running total, L3 by category,
L8 moving average, L9 year over year, L11 average order value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import windows as W
from . import views as V
from .common import money_div


def order_revenue(t) -> DataFrame:
    """Line totals summed per order.

    The partial (map-side) aggregation collapses the line items of an order
    before the shuffle on ``order_id``, and the following join with orders
    reuses that hash partitioning.
    """
    return (V.order_items(t).groupBy("order_id")
            .agg(F.sum("line_total").alias("revenue"),
                 F.count(F.lit(1)).alias("n_items"),
                 F.sum("quantity").alias("units")))


def valid_order_revenue(t) -> DataFrame:
    """(order_id, customer_id, order_date, revenue, n_items, units) for revenue-counting orders."""
    o = V.valid_orders(t).select("order_id", "customer_id", "order_date")
    return order_revenue(t).join(o, "order_id")


def monthly_revenue(t) -> DataFrame:
    """Revenue and order count per calendar month (the shared ``monthly`` CTE)."""
    r = valid_order_revenue(t)
    return (r.groupBy(D.month_start(F.col("order_date")).alias("month"))
             .agg(F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("order_count")))


def daily_revenue(t) -> DataFrame:
    """L1."""
    r = valid_order_revenue(t)
    out = (r.groupBy(D.to_day(F.col("order_date")).alias("order_day"))
            .agg(F.count(F.lit(1)).alias("total_orders"), F.sum("revenue").alias("daily_revenue")))
    return out


def monthly_running_total(t) -> DataFrame:
    """L2: a calendar aggregate, so a plain ordered window is right."""
    m = monthly_revenue(t).select("month", F.col("revenue").alias("monthly_revenue"))
    return W.running_total(m, "month", "monthly_revenue", "cumulative_revenue")


# Fixed value: rows of a shuffled table for one task, about.
ROWS_A_TASK = 1 << 18


def _tasks(df: DataFrame) -> int:
    """Tasks for a shuffle of a table's rows: they grow with the table, so that a task's memory doesn't."""
    return max(1, -(-df.count() // ROWS_A_TASK))


def category_revenue(t) -> DataFrame:
    """L3: revenue, distinct orders and share per product category.

    The status filter is a semi join that leaves the lines dealt by order; with
    the category attached they are reduced to (order, category), so that the
    distinct order count is a plain count.  (A reduction to (order, product)
    first would reduce nothing: an order has a product once.)  Where Spark copies
    neither orders nor products to all tasks, the joins take the partitions of their right sides,
    whose number follows the lines.
    """
    n = _tasks(t["lineitem"])
    items = V.order_items(t).select("order_id", "product_id", "line_total")
    orders = V.valid_orders(t).select("order_id").repartition(n, "order_id")
    products = V.products(t).select("product_id", "category").repartition(n, "product_id")
    lines = items.join(orders, "order_id", "left_semi").join(products, "product_id")
    # no shuffle where the lines still lie by order
    per_order = lines.repartition(n, "order_id").groupBy("order_id", "category").agg(F.sum("line_total").alias("revenue"))
    cat = per_order.groupBy("category").agg(F.sum("revenue").alias("revenue"),
                                            F.count(F.lit(1)).alias("order_count"))
    return W.share_of_total(cat, "revenue", "pct_of_total")


def moving_average_3m(t) -> DataFrame:
    """L8."""
    return W.moving_average(monthly_revenue(t).select("month", "revenue"), "month", "revenue", "moving_avg_3m", 3, digits=2)


def yoy_growth(t, strict: bool = False) -> DataFrame:
    """LAG 12 rows (reference); ``strict=True`` compares the same calendar month."""
    m = monthly_revenue(t).select("month", F.col("revenue").alias("current_revenue"))
    if strict:
        out = W.lag_calendar(m, "month", "current_revenue", "prior_year_revenue", 12)
    else:
        out = W.lag_rows(m, "month", "current_revenue", "prior_year_revenue", 12)
    growth = money_div((F.col("current_revenue") - F.col("prior_year_revenue")) * 100,
                       F.col("prior_year_revenue"), 2)
    out = out.withColumn("yoy_growth_pct", F.when(F.col("prior_year_revenue").isNotNull(), growth))
    return out


def average_order_value(t) -> DataFrame:
    """L11."""
    m = monthly_revenue(t)
    out = m.select("month", F.col("order_count"),
                   money_div(F.col("revenue"), F.col("order_count"), 2).alias("avg_order_value"))
    return out
