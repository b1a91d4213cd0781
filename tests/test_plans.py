"""Plan-shape checks for the scale properties the design relies on."""

import re

import pytest

import __spark_entry__ as E
from bizlens.plans import revenue

from conftest import SF001


def _plan(spark, name):
    df = E.queries()[name](spark, SF001)
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(spark, "daily_revenue")
    line = next(l for l in plan.splitlines() if "lineitem" in l and "ReadSchema" in l)
    schema = line.split("ReadSchema: ")[1]
    assert "l_orderkey" in schema and "l_extendedprice" in schema and "l_discount" in schema
    assert "l_shipdate" not in schema and "l_comment" not in schema and "l_tax" not in schema


def test_top_n_per_group_limits_before_shuffle(spark):
    plan = _plan(spark, "top_products_per_category")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_lines_reduced_per_order_before_join(spark):
    plan = _plan(spark, "daily_revenue")
    # a partial aggregate of the line items sits below the join with orders
    join_at = min(i for i, l in enumerate(plan.splitlines()) if "Join" in l)
    below = "\n".join(plan.splitlines()[join_at:])
    assert "partial_sum" in below


def _spark_plan(spark, name):
    """The plan without adaptive execution, in which reused exchanges show."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return _plan(spark, name)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _scans(plan, table):
    return sum(1 for line in plan.splitlines() if f"/{table}.parquet" in line and "FileScan" in line)


@pytest.mark.parametrize("name", ["category_revenue", "country_breakdown", "category_breakdown", "region_breakdown", "dashboard_regions", "dashboard_trend",
                                  "budget_vs_actual", "region_detail", "criteria_report", "country_top_products", "product_table"])
def test_one_scan_of_line_items_and_nothing_written(spark, name):
    plan = _spark_plan(spark, name)
    assert _scans(plan, "lineitem") == 1, plan
    assert "ExistingRDD" not in plan.replace("LocalTableScan", "") or name == "budget_vs_actual"


def test_partitions_follow_the_lines(spark, monkeypatch):
    """The joins of category_revenue have the more partitions the more lines there are, whatever the session's number."""
    monkeypatch.setattr(revenue, "ROWS_A_TASK", 100, raising=False)
    n = -(-spark.read.parquet(f"{SF001}/lineitem.parquet").count() // 100)
    found = re.findall(r"hashpartitioning\((?:order|product)_id#\d+L?, (?:category#\d+, )?(\d+)", _spark_plan(spark, "category_revenue"))
    assert len(found) >= 4 and set(found) == {str(n)}


@pytest.mark.parametrize("name", ["rfm_segments", "pareto", "value_segments", "sales_rank", "order_numbers", "order_lookups", "co_purchased_pairs"])
def test_no_python_and_no_nested_loops(spark, name):
    plan = _spark_plan(spark, name)
    assert "Python" not in plan and "MapInPandas" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_basket_pairs_join_aggregated_names(spark):
    plan = _plan(spark, "co_purchased_pairs")
    lines = plan.splitlines()
    join_at = max(i for i, l in enumerate(lines) if "Join" in l and "_o#" in l)
    assert any("HashAggregate" in l for l in lines[join_at:])
