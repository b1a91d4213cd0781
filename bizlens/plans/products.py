"""Product reports: L5 performance, L6 inventory alerts, L12 top 3 per
category, L15 review sentiment, L16 co-purchased pairs, L17 Pareto,
L30 product table with top/bottom flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import zero_guard
from ..operators import aggregates as A
from ..operators import baskets
from ..operators import windows as W
from . import views as V
from .common import money_div, round_ratio


def product_sales(t) -> DataFrame:
    """Units and revenue per product over revenue orders (semi join on status)."""
    items = V.order_items(t).select("order_id", "product_id", "quantity", "line_total")
    kept = items.join(V.valid_orders(t).select("order_id"), "order_id", "left_semi")
    return kept.groupBy("product_id").agg(F.sum("quantity").alias("units_sold"),
                                          F.sum("line_total").alias("total_revenue"))


def review_stats(t) -> DataFrame:
    """Per product: review count, rating sum, positive (>= 4) and negative (<= 2) reviews."""
    r = V.reviews(t)
    return r.groupBy("product_id").agg(F.count("review_id").alias("review_count"),
                                       F.sum("rating").alias("_rating_sum"),
                                       F.count_if(F.col("rating") >= 4).alias("positive_reviews"),
                                       F.count_if(F.col("rating") <= 2).alias("negative_reviews"))


def product_performance(t) -> DataFrame:
    """Active products ⟕ sales ⟕ reviews, both sides aggregated before the join (no fan-out)."""
    p = V.products(t).where(F.col("is_active")).select("product_id", "name", "price")
    s = product_sales(t)
    r = review_stats(t)
    j = p.join(s, "product_id", "left").join(r, "product_id", "left")
    out = j.select("product_id", "name", "price",
                   F.coalesce("units_sold", F.lit(0)).alias("units_sold"),
                   F.coalesce("total_revenue", F.lit(0)).alias("total_revenue"),
                   F.coalesce(round_ratio(F.col("_rating_sum"), F.col("review_count"), 2), F.lit(0.0))
                    .alias("avg_rating"),
                   F.coalesce("review_count", F.lit(0)).alias("review_count"))
    return out


def inventory_alerts(t) -> DataFrame:
    """Stock at or below 1.5 × reorder level, with a status ladder.

    Inventory and products are both projections of ``part`` here, so one scan
    serves both (a self join on the key would only add a shuffle).
    """
    j = V.product_stock(t)
    q, lvl = F.col("quantity"), F.col("reorder_level")
    status = (F.when(q == 0, "OUT OF STOCK").when(q <= lvl, "REORDER NOW")
               .when(q <= lvl * 1.5, "LOW STOCK").otherwise("OK"))
    out = j.where(q <= lvl * 1.5).select("sku", "name", q.alias("current_stock"), "reorder_level",
                                         F.col("reorder_quantity").alias("suggested_reorder"),
                                         status.alias("stock_status"))
    return out


def top_products_per_category(t, n: int = 3) -> DataFrame:
    """ROW_NUMBER per category by revenue (tie-break product id), first n.

    Planned with a partial WindowGroupLimit: each map task keeps n rows per
    category before the shuffle, so category size does not matter.
    """
    s = product_sales(t)
    p = V.products(t).select("product_id", F.col("name").alias("product_name"), "category")
    j = s.join(p, "product_id")
    top = W.top_n_per_group(j, ["category"], [("total_revenue", False), ("product_id", True)], n,
                            rank_col="rank_in_category")
    out = top.select("category", "product_name", "units_sold", F.col("total_revenue").alias("revenue"),
                     "rank_in_category")
    return out


def review_sentiment(t) -> DataFrame:
    """Per reviewed product: counts, average rating, positive/negative, sales."""
    r = review_stats(t)
    p = V.products(t).select("product_id", F.col("name").alias("product"))
    s = product_sales(t)
    j = r.where(F.col("review_count") > 0).join(p, "product_id").join(s, "product_id", "left")
    out = j.select("product", F.col("review_count").alias("total_reviews"),
                   round_ratio(F.col("_rating_sum"), F.col("review_count"), 2).alias("avg_rating"),
                   "positive_reviews", "negative_reviews",
                   F.coalesce("units_sold", F.lit(0)).alias("units_sold"),
                   F.coalesce("total_revenue", F.lit(0)).alias("revenue"))
    return out


def co_purchased_pairs(t, min_count: int = 2) -> DataFrame:
    """Product-name pairs bought in the same order (all statuses, as the reference)."""
    items = V.order_items(t).select("order_id", "product_id")
    names = V.products(t).select("product_id", "name")
    out = baskets.name_pair_counts(items, names, min_count=min_count)
    return out


def pareto(t) -> DataFrame:
    """Cumulative revenue share by product, 80/20 split.

    The cumulative sum uses the RANGE frame (equal revenues share a value);
    product rank breaks ties by product id.  The ranked rows are written once;
    rank, count, total and peer sums come from them.
    """
    s = product_sales(t).where(F.col("total_revenue").isNotNull())
    p = V.products(t).select("product_id", "name")
    pr = s.join(p, "product_id").select("product_id", "name", F.col("total_revenue").alias("revenue"))
    ranked = W.global_running(pr, [("revenue", False), ("product_id", True)], rn_col="product_rank",
                              total_col="total_products", totals={"_total": "revenue"})
    ranked = W.global_peer_cumsum(ranked, "revenue", False, "revenue", "cumulative_revenue")
    cum, total = F.col("cumulative_revenue"), F.col("_total")
    return ranked.select("product_rank", "name", "revenue",
                         money_div(cum * 100, total, 2).alias("cumulative_pct"),
                         round_ratio(F.col("product_rank") * 100, F.col("total_products"), 2)
                          .alias("pct_of_products"),
                         F.when(cum <= total * F.lit(0.8).cast("decimal(2,1)"), "Top 80% revenue").otherwise("Long tail")
                          .alias("pareto_group"))


def sales_rank(t) -> DataFrame:
    """Products by units sold, RANK and DENSE_RANK over all products; products
    without sales are ranked too (NULL units, last)."""
    p = V.products(t).select("product_id", "name")
    units = p.join(product_sales(t).select("product_id", "units_sold"), "product_id", "left")
    ranked = W.global_rank(units, "units_sold", False, "units_rank")
    return W.global_rank(ranked, "units_sold", False, "units_dense_rank", dense=True)


def product_table(totals: DataFrame, k: int = 5) -> DataFrame:
    """Per product revenue (fraction discount), line count, guarded average,
    and flags for the k best and k worst by revenue.

    ``totals`` is one row per product: product_id, product, category, revenue, lines.
    """
    n, rev = F.col("lines"), F.col("revenue")
    out = totals.select("product_id", "product", "category", rev.alias("total_revenue"), n.alias("total_orders"),
                        zero_guard(n, money_div(rev, n, 2)).alias("avg_order_value"))
    return A.top_k_flags(out, "product_id", "total_revenue", k)
