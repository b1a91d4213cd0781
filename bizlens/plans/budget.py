"""Budget tracker reports (L26-L29) over a ledger of Income / Expense lines.

Ledger from the driver tables: every order is an Income line (amount = order
total, category = order priority, date = order date); every line item is an
Expense line (amount = extended price × tax, category = part type, date =
ship date).  Budgets are a small per-category table (monthly amounts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_label, month_start, quarter_label
from ..functions.numeric import zero_guard
from ..functions.text import status_label
from ..operators import aggregates as A
from ..operators import criteria as C
from ..operators import lookups as L
from ..operators import windows as W
from .common import money_div

# Monthly budget per expense category (part type) of the ledger.
MONTHLY_BUDGETS = {
    "ECONOMY": 180000, "LARGE": 190000, "MEDIUM": 200000,
    "PROMO": 170000, "SMALL": 185000, "STANDARD": 195000,
}


def budgets_frame(spark: SparkSession, budgets: dict[str, int] = MONTHLY_BUDGETS) -> DataFrame:
    """The budget table (category, monthly budget) as a DataFrame."""
    return spark.createDataFrame([(k, v) for k, v in budgets.items()], "category string, budget int")


def ledger_monthly(t, with_category: bool = True) -> DataFrame:
    """(month, type[, category], amount): the ledger reduced per month; every budget
    report rolls up from this frame.

    The product dimension is met only where the category is asked for.
    """
    keys = ["category"] if with_category else []
    o = t["orders"]
    income = (o.groupBy(month_start(F.col("o_orderdate")).alias("month"), *[F.col("o_orderpriority").alias(k) for k in keys])
               .agg(F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("amount")))
    amount = F.round(F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(4,2)"), 2).cast("decimal(12,2)")
    li = t["lineitem"].select("l_partkey", month_start(F.col("l_shipdate")).alias("month"), amount.alias("amount"))
    if with_category:
        p = t["part"].select("p_partkey", F.col("p_type").alias("category"))
        li = li.join(p, li.l_partkey == p.p_partkey)
    expense = li.groupBy("month", *keys).agg(F.sum("amount").alias("amount"))
    shape = lambda df, kind: df.select("month", F.lit(kind).alias("type"), *keys, "amount")
    return shape(income, "Income").unionByName(shape(expense, "Expense"))


def _expenses(t) -> DataFrame:
    """(year, month number, category, actual)."""
    led = ledger_monthly(t).where(F.col("type") == "Expense")
    return led.select(F.year("month").alias("year"), F.month("month").alias("month"), "category", F.col("amount").alias("actual"))


def _rate(net: Column, base: Column) -> Column:
    """A ratio of money, 4 dp, 0 when the base is 0."""
    return zero_guard(base, money_div(net, base, 4))


def budget_vs_actual_long(actual: DataFrame, budgets: DataFrame) -> DataFrame:
    """L26 long form: every budget category × year × month 1..12, with actual
    expense (0 where none), variance = budget − actual, var % (0 if no budget),
    plus a TOTAL category per (year, month).  ``actual``: year, month, category, actual."""
    actual = actual.where("year IS NOT NULL AND month IS NOT NULL AND category IS NOT NULL")
    # the range reads every column of the frame: the same plan, so its shuffles are done once
    bounds = actual.select(F.struct(F.min("year").alias("lo"), F.max("year").alias("hi"), F.count("category").alias("c"),
                                    F.sum("month").alias("m"), F.sum("actual").alias("a"))).scalar()
    grid = budgets.select("category", "budget", F.explode(F.sequence(bounds["lo"], bounds["hi"])).alias("year")) \
                  .select("*", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    g = L.fill_scaffold(grid, actual, ["year", "category", "month"], ["actual"])
    g = A.with_totals(g, ["year", "month", "category"], ["budget", "actual"], total_of="category")
    var = F.col("budget") - F.col("actual")
    return g.select("year", "category", "month", "budget", "actual", var.alias("variance"),
                    _rate(var, F.col("budget")).alias("var_pct"))


def budget_vs_actual(t) -> DataFrame:
    """L26 wide: one row per (year, category) incl. TOTAL, four columns per month."""
    spark = t["orders"].sparkSession
    long = budget_vs_actual_long(_expenses(t), budgets_frame(spark))
    return A.pivot_wide(long, ["year", "category"], "month", list(range(1, 13)),
                        ["budget", "actual", "variance", "var_pct"], name="m{value:02d}_{measure}")


def monthly_cashflow(t) -> DataFrame:
    """Income, expense, net, savings rate (4 dp, 0 if no income), cumulative net."""
    m = C.split_sums(ledger_monthly(t, False), "type", "amount", group_by=["month"])
    net = F.col("income") - F.col("expense")
    m = m.select("month", "income", "expense", net.alias("net"), _rate(net, F.col("income")).alias("savings_rate"))
    # One row per calendar month: a small frame, a plain ordered window.
    return W.running_total(m, "month", "net", "cumulative_net")


def expense_categories(t) -> DataFrame:
    """L28 + L29 category status, per year: total spent, share of the year's
    expenses (4 dp), monthly average (÷ 12), annual budget (monthly × 12),
    over/under and its label."""
    cat = _expenses(t).groupBy("year", "category").agg(F.sum("actual").alias("total_spent"))
    cat = W.share_of_total(cat, "total_spent", "pct_of_total", ["year"], scale=4, as_fraction=True)
    j = L.join_budget(cat, budgets_frame(t["orders"].sparkSession), "category")
    annual = A.annualise(F.col("budget"))
    over = annual - F.col("total_spent")
    return j.select("year", "category", "total_spent", "pct_of_total",
                    money_div(F.col("total_spent"), F.lit(12), 2).alias("monthly_average"),
                    annual.alias("annual_budget"), over.alias("over_under"),
                    status_label(over, "Under Budget", "Over Budget").alias("status"))


def top_expense_categories(t, n: int = 5) -> DataFrame:
    """the n largest expense categories of each year (ties by name)."""
    cat = _expenses(t).groupBy("year", "category").agg(F.sum("actual").alias("total_spent"))
    return W.top_n_per_group(cat, ["year"], [("total_spent", False), ("category", True)], n, rank_col="rank")


def annual_summary(t) -> DataFrame:
    """L29 per year: totals, savings rate, monthly averages (÷ 12), best and worst
    month by net (ties: earlier month), largest expense category, budget health.

    All of it rolls up from the monthly ledger."""
    spark = t["orders"].sparkSession
    led = ledger_monthly(t).withColumn("year", F.year("month")).withColumn("month", F.month("month"))
    net = F.col("income") - F.col("expense")
    pm = C.split_sums(led, "type", "amount", group_by=["year", "month"]).withColumn("net", net)
    best, worst = (A.top_by(pm, ["year"], "month", "net", out, largest=big) for out, big in (("best", True), ("worst", False)))
    cat = led.where(F.col("type") == "Expense").groupBy("year", "category").agg(F.sum("amount").alias("spent"))
    top_cat = A.top_by(cat, ["year"], "category", "spent", "largest_expense_category")
    tot = pm.groupBy("year").agg(F.sum("income").alias("income"), F.sum("expense").alias("expense"), F.sum("net").alias("net"))
    total_budget = budgets_frame(spark).select(A.annualise(F.sum("budget"))).scalar()
    name = lambda m: month_label(F.make_date(F.lit(2000), F.col(m), F.lit(1)), "MMMM").alias(f"{m}_month")
    per_month = lambda c: money_div(F.col(c), F.lit(12), 2)
    left = total_budget - F.col("expense")
    return (tot.join(best, "year").join(worst, "year").join(top_cat, "year")
               .select("year", F.col("income").alias("total_income"), F.col("expense").alias("total_expenses"),
                       F.col("net").alias("net_savings"), _rate(F.col("net"), F.col("income")).alias("savings_rate"),
                       per_month("income").alias("avg_monthly_income"), per_month("expense").alias("avg_monthly_expenses"),
                       per_month("net").alias("avg_monthly_savings"), name("best"), name("worst"), "largest_expense_category",
                       left.alias("overall_variance"), status_label(left).alias("budget_health")))


def quarterly_summary(t) -> DataFrame:
    """L29 quarters (D18): income, expenses, net, savings rate per (year, quarter)."""
    led = ledger_monthly(t, False).withColumn("year", F.year("month")).withColumn("quarter", quarter_label(F.col("month")))
    q = C.split_sums(led, "type", "amount", group_by=["year", "quarter"])
    net = F.col("income") - F.col("expense")
    return q.select("year", "quarter", "income", "expense", net.alias("net"), _rate(net, F.col("income")).alias("savings_rate"))


def month_profile(t) -> DataFrame:
    """income and expense per year and month name, in calendar order."""
    m = C.split_sums(ledger_monthly(t, False), "type", "amount", group_by=["month"])
    named = m.select(F.year("month").alias("year"), month_label(F.col("month"), "MMMM").alias("month_name"), "income", "expense")
    return W.sort_calendar(named, "month_name", "year")
