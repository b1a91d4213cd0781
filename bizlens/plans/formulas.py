"""The spreadsheet lookup, text and date functions applied to the data.

* ``order_calendar``: per order with a delivery, quarter and month labels,
  month ends, business days to delivery (NETWORKDAYS), the 10th business day
  after the order (WORKDAY), complete months and days (DATEDIF).
* ``customer_text``: user part of the e-mail (LEFT + FIND), PROPER of the
  segment, RIGHT / MID of the name, SUBSTITUTE, TRIM and ``&`` concatenation.
* ``order_lookups``: per order, the customer's name by exact match (VLOOKUP
  FALSE), the customer's nation with a default (XLOOKUP), and the order's
  price tier from a bracket table (VLOOKUP TRUE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as X
from ..operators import lookups as L
from . import views as V

# Order value tiers (lower bound of each tier, tier name).
PRICE_TIERS = [(0, "Small"), (50000, "Medium"), (150000, "Large"), (300000, "Key account")]


def order_calendar(t) -> DataFrame:
    """L23 date functions per delivered order."""
    s = V.shipments(t).where(F.col("delivered_date").isNotNull())
    od, dd = F.to_date("order_date"), F.to_date("delivered_date")
    out = s.select("order_id", od.alias("order_day"),
                   D.quarter_label(od).alias("quarter"),
                   D.month_label(od).alias("month_label"),
                   D.eomonth(od, 0).alias("month_end"),
                   D.eomonth(od, 1).alias("next_month_end"),
                   D.networkdays(od, dd).alias("business_days_to_deliver"),
                   D.workday(od, 10).alias("tenth_business_day"),
                   D.workday(od, -3).alias("third_business_day_before"),
                   D.datedif(od, dd, "M").alias("months_to_deliver"),
                   D.datedif(od, dd, "D").alias("days_to_deliver"))
    return out


def customer_text(t) -> DataFrame:
    """L23 text functions per customer."""
    c = V.customers(t)
    name = F.col("first_name")
    out = c.select("customer_id",
                   X.text_before(F.col("email"), "@").alias("user"),
                   X.left(F.col("email"), 4).alias("email_head"),
                   X.find("@", F.col("email")).cast("long").alias("at_position"),
                   X.proper(F.col("last_name")).alias("segment_proper"),
                   X.right(name, 4).alias("name_tail"),
                   X.mid(name, 10, 3).alias("name_mid"),
                   X.substitute(name, "#", " No. ").alias("name_label"),
                   X.excel_trim(F.concat(F.lit("  "), F.col("city"), F.lit("   "), F.col("country"), F.lit(" ")))
                    .alias("place"),
                   X.excel_concat("Hello, ", X.proper(F.col("city")), "!").alias("greeting"))
    return out


def order_lookups(t) -> DataFrame:
    """L23 lookups per order: exact match (customer), match with default (the
    customer's nation, region 0 left out), bracket tier."""
    o = V.orders(t).select("order_id", "customer_id", "total_amount")
    with_name = L.exact_lookup(o, "customer_id", V.customers(t), "customer_id", ["first_name", "nation_id"], pos="customer_id")
    nations = t["nation"].where(F.col("n_regionkey") != 0)
    with_nation = L.xlookup(with_name, "nation_id", nations, "n_nationkey", "n_name", "nation", pos="n_nationkey")
    tiers = t["orders"].sparkSession.createDataFrame(PRICE_TIERS, "lo int, tier string")
    out = L.bracket_lookup(with_nation, "total_amount", tiers, "lo", "tier", "tier", pos="lo")
    return out.select("order_id", F.col("first_name").alias("customer_name"), "nation", "tier")
