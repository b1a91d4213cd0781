"""Name -> query callable ``(spark, sf_dir) -> DataFrame``, one per §2 report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import load_tables
from . import (budget, cleaning, customers, exchange, formulas, hierarchy, pages, products, profiling, quality, reports,
               revenue, series)
from . import views as V
from .common import to_report
from ..operators.windows import order_report

Query = Callable[[SparkSession, str], DataFrame]


def _on_tables(fn, **params) -> Query:
    """Reports compute in exact decimals; the registered query shows them as doubles."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return to_report(fn(load_tables(spark, sf_dir), **params))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Query] = {
    "daily_revenue": _on_tables(revenue.daily_revenue),
    "monthly_revenue": _on_tables(revenue.monthly_running_total),
    "category_revenue": _on_tables(revenue.category_revenue),
    "moving_average_3m": _on_tables(revenue.moving_average_3m),
    "yoy_growth": _on_tables(revenue.yoy_growth),
    "yoy_growth_calendar": _on_tables(revenue.yoy_growth, strict=True),
    "average_order_value": _on_tables(revenue.average_order_value),
    "top_customers": _on_tables(customers.top_customers),
    "product_performance": _on_tables(products.product_performance),
    "inventory_alerts": _on_tables(products.inventory_alerts),
    "cohort_retention": _on_tables(customers.cohort_retention),
    "rfm_segments": _on_tables(customers.rfm_segments, as_of=customers.AS_OF),
    "inactive_customers": _on_tables(customers.inactive_customers, as_of=customers.AS_OF),
    # The NOT EXISTS form of "no revenue order in the last 90 days" (never-ordered customers included)
    "customers_without_orders": _on_tables(customers.customers_without_orders,
                                           since=customers.AS_OF - dt.timedelta(days=90)),
    "top_products_per_category": _on_tables(products.top_products_per_category),
    "review_sentiment": _on_tables(products.review_sentiment),
    "co_purchased_pairs": _on_tables(products.co_purchased_pairs),
    "pareto": _on_tables(products.pareto),
    "fulfilment_times": _on_tables(reports.fulfilment_times),
    "kpis_by_year": _on_tables(reports.kpis_by_year),
    "country_breakdown": _on_tables(lambda t: reports.breakdown(reports.geo_totals(t, "country"))),
    "category_breakdown": _on_tables(lambda t: reports.breakdown(reports.category_totals(t))),
    "region_breakdown": _on_tables(lambda t: reports.breakdown(reports.geo_totals(t, "region"))),
    "region_detail": _on_tables(reports.region_detail),
    "dashboard_regions": _on_tables(reports.dashboard_regions),
    "dashboard_trend": _on_tables(reports.dashboard_trend),
    "dashboard_kpis": _on_tables(reports.dashboard_kpis),
    "criteria_report": _on_tables(reports.criteria_report),
    "monthly_trends": _on_tables(reports.monthly_trends),
    "executive_kpis": _on_tables(reports.executive_kpis),
    "country_top_products": _on_tables(reports.country_top_products),
    "order_numbers": _on_tables(reports.order_numbers),
    "sales_rank": _on_tables(products.sales_rank),
    "product_table": _on_tables(lambda t: products.product_table(
        reports.product_totals(t).join(
            V.products(t).select("product_id", F.col("name").alias("product"), "category"), "product_id"))),
    "value_segments": _on_tables(lambda t: customers.value_segments(
        V.order_lines(t), V.customer_geo(t).select("customer_id", "customer_name"), customers.AS_OF, count_col="lines")),
    "budget_vs_actual": _on_tables(budget.budget_vs_actual),
    "monthly_cashflow": _on_tables(budget.monthly_cashflow),
    "expense_categories": _on_tables(budget.expense_categories),
    "top_expense_categories": _on_tables(budget.top_expense_categories),
    "month_profile": _on_tables(budget.month_profile),
    "annual_summary": _on_tables(budget.annual_summary),
    "quarterly_summary": _on_tables(budget.quarterly_summary),
    "yearly_stats": _on_tables(series.yearly_stats),
    "overall_stats": _on_tables(series.overall_stats),
    "cleaned_documents": _on_tables(cleaning.cleaned_documents),
    "cleaned_conversations": _on_tables(cleaning.cleaned_conversations),
    "cleaning_null_report": _on_tables(cleaning.cleaning_null_report),
    "cleaning_summary": _on_tables(cleaning.cleaning_summary),
    "cleaning_value_counts": _on_tables(cleaning.cleaning_value_counts),
    "constraint_report": _on_tables(quality.constraint_report),
    "page_records": _on_tables(pages.page_records),
    "page_summary": _on_tables(pages.page_summary),
    "folder_profile": _on_tables(profiling.folder_profile),
    "folder_column_profile": _on_tables(profiling.folder_column_profile),
    "document_profile": _on_tables(profiling.document_profile),
    "document_column_profile": _on_tables(profiling.document_column_profile),
    "document_preview": _on_tables(profiling.document_preview),
    "documents_csv": _on_tables(exchange.documents_csv),
    "region_rewrite": _on_tables(exchange.region_rewrite),
    "report_bundle": _on_tables(exchange.report_bundle),
    "quarantined_rows": _on_tables(exchange.quarantined_rows),
    "cleaned_sales": _on_tables(exchange.cleaned_sales),
    "product_records": _on_tables(exchange.product_records),
    "tree_rollup": _on_tables(hierarchy.tree_rollup),
    "order_calendar": _on_tables(formulas.order_calendar),
    "customer_text": _on_tables(formulas.customer_text),
    "order_lookups": _on_tables(formulas.order_lookups),
}

# declared order of the reports that have one (column, ascending); NULLs last.
ORDERS: dict[str, list[tuple[str, bool]]] = {
    "daily_revenue": [("order_day", True)],
    "monthly_revenue": [("month", True)],
    "category_revenue": [("revenue", False), ("category", True)],
    "moving_average_3m": [("month", True)],
    "yoy_growth": [("month", True)],
    "yoy_growth_calendar": [("month", True)],
    "average_order_value": [("month", True)],
    "top_customers": [("lifetime_spend", False), ("customer_id", True)],
    "product_performance": [("total_revenue", False), ("product_id", True)],
    "inventory_alerts": [("current_stock", True), ("sku", True)],
    "cohort_retention": [("cohort_month", True), ("activity_month", True)],
    "rfm_segments": [("rfm_total", False), ("monetary", False), ("customer_id", True)],
    "inactive_customers": [("days_since_last_order", False), ("customer_id", True)],
    "top_products_per_category": [("category", True), ("rank_in_category", True)],
    "review_sentiment": [("avg_rating", False), ("total_reviews", False), ("product", True)],
    "co_purchased_pairs": [("times_bought_together", False), ("product_a", True), ("product_b", True)],
    "pareto": [("product_rank", True)],
    "fulfilment_times": [("month", True)],
    "kpis_by_year": [("year", True)],
    "monthly_trends": [("month", True)],
    "monthly_cashflow": [("month", True)],
    "budget_vs_actual": [("year", True), ("category", True)],
    "expense_categories": [("year", True), ("total_spent", False), ("category", True)],
    "top_expense_categories": [("year", True), ("rank", True)],
    "annual_summary": [("year", True)],
    "quarterly_summary": [("year", True), ("quarter", True)],
    "yearly_stats": [("year", True)],
    "country_top_products": [("country", True), ("rank", True)],
    "product_table": [("total_revenue", False), ("product_id", True)],
    "value_segments": [("total_spent", False), ("customer_id", True)],
    "sales_rank": [("units_rank", True), ("product_id", True)],
}


def _ordered(query: Query, keys: list[tuple[str, bool]]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return order_report(query(spark, sf_dir), keys)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES.update({name: _ordered(QUERIES[name], keys) for name, keys in ORDERS.items()})
