"""Bucketed co-location removes the shuffle of the order-key join."""

from bizlens.plans import revenue
from bizlens.sources import layout
from bizlens.sources.tables import load_tables

from conftest import SF001


def test_co_located_join_has_no_exchange_on_facts(spark):
    t = load_tables(spark, SF001)
    names = layout.write_co_located(t, database="bizlens_test", buckets=8)
    tb = layout.load_co_located(spark, SF001, names)
    df = revenue.daily_revenue(tb)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force the sort-merge plan
    try:
        plan = revenue.daily_revenue(tb)._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        join_at = min(i for i, l in enumerate(lines) if "SortMergeJoin" in l)
        # below the join: bucketed scans, no exchange on either input
        assert not any("Exchange" in l for l in lines[join_at:]), plan
        same = sorted(map(tuple, df.collect())) == sorted(map(tuple, revenue.daily_revenue(t).collect()))
        assert same
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
