"""Statistics of two monthly series.

The reference studies two monthly macro series.  Here the two series are
derived from the orders: x = monthly revenue in thousands, y = average
discount in percent, both exact decimals with two places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as A
from . import views as V
from .common import money_div, round_ratio


def monthly_series(t) -> DataFrame:
    """(month, year, x decimal, y decimal): one row per calendar month."""
    i = V.order_items(t).select("order_id", "line_total", "discount")
    o = V.orders(t).select("order_id", F.trunc("order_date", "MM").alias("month"))
    g = (i.join(o, "order_id").groupBy("month")
          .agg(F.sum("line_total").alias("_rev"), F.sum("discount").alias("_disc"), F.count(F.lit(1)).alias("_n")))
    x = money_div(F.col("_rev"), F.lit(1000), 2).cast("decimal(18,2)")
    y = round_ratio((F.col("_disc") * 100).cast("long"), F.col("_n"), 2).cast("decimal(18,2)")
    return g.select("month", F.year("month").alias("year"), x.alias("x"), y.alias("y"))


def _avg2(c: str) -> Column:
    return round_ratio((F.sum(c) * 100).cast("long"), F.count(F.lit(1)) * 100, 2)


# Fixed value: an average of the first series above this is flagged.
HIGH_AVERAGE = 50


def yearly_stats(t, threshold=HIGH_AVERAGE) -> DataFrame:
    """Per year: n, average / min / max of both series, guarded correlation, a flag for
    years whose average x is above ``threshold``, and one for years above the
    whole-period average."""
    s = monthly_series(t)
    # the totals read every column of the frame: the same plan, so its shuffles are done once
    tot = s.select(F.struct((F.sum("x") * 100).cast("long").alias("sx"), F.count(F.lit(1)).alias("n"), F.count("month").alias("m"),
                            F.sum("year").alias("y"), F.sum("y").alias("sy"))).scalar()
    n, cents = F.count(F.lit(1)), (F.sum("x") * 100).cast("long")
    return A.corr_by(
        s, ["year"], "x", "y", 3, _avg2("x").alias("avg_x"), F.min("x").alias("min_x"), F.max("x").alias("max_x"),
        _avg2("y").alias("avg_y"), F.min("y").alias("min_y"), F.max("y").alias("max_y"),
        # exact comparisons of averages by cross-multiplying integer cents
        (cents > n * int(threshold * 100)).alias("high_x"), (cents * tot["n"] > tot["sx"] * n).alias("above_average_x"))


def _month_of_min(expr: Column) -> Column:
    """Month at which ``expr`` is smallest (earliest month on ties)."""
    return F.min(F.struct(expr.alias("v"), F.col("month").alias("m")))["m"]


def overall_stats(t) -> DataFrame:
    """Whole period: n, averages, extremes with the month they occurred in (ties:
    earliest month), correlation, and the latest observation."""
    s = monthly_series(t)
    n = F.count(F.lit(1))
    x, y = F.col("x"), F.col("y")
    g = s.agg(n.alias("n"),
              _avg2("x").alias("avg_x"), F.min("x").alias("min_x"), _month_of_min(x).alias("min_x_month"),
              F.max("x").alias("max_x"), _month_of_min(-x).alias("max_x_month"),
              _avg2("y").alias("avg_y"), F.min("y").alias("min_y"), _month_of_min(y).alias("min_y_month"),
              F.max("y").alias("max_y"), _month_of_min(-y).alias("max_y_month"),
              A.corr_guarded("x", "y").alias("corr"),
              F.max("month").alias("latest_month"),
              F.max_by("x", "month").alias("latest_x"), F.max_by("y", "month").alias("latest_y"))
    return g
