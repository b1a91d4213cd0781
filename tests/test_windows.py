"""Global windows without a single task equal plain windows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bizlens.operators import windows as W


def _frame(spark, n=997, parts=7):
    rows = [(i, (i * 37) % 101, Decimal((i * 53) % 89) / 4) for i in range(n)]
    return spark.createDataFrame(rows, "id long, k long, v decimal(10,2)").repartition(parts)


def _hard(spark):
    """NULL keys and values, ties, longs beyond 2**53."""
    rows = [(i, None if i % 7 == 0 else i % 5, None if i < 40 or i % 3 == 0 else 9007199254740993 + i, Decimal(i) if i % 4 else None)
            for i in range(200)]
    return spark.createDataFrame(rows, "id long, k long, big long, d decimal(20,2)").repartition(5)


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("partitions", [1, 5, 64])
def test_row_window_equals_the_plain_one(spark, partitions):
    df = _frame(spark)
    got = W.global_row_window(df, [("k", False), ("id", True)], rn_col="rn", cum=("v", "cv"), total_col="n", partitions=partitions)
    w = Window.orderBy(F.col("k").desc_nulls_last(), "id")
    want = df.select("*", F.row_number().over(w).cast("long").alias("rn"),
                     F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cv"), F.count("*").over(Window.partitionBy()).alias("n"))
    assert got.dtypes == want.dtypes and _sorted(got) == _sorted(want)


@pytest.mark.parametrize("src", ["big", "d", "k"])
def test_running_values_with_nulls_and_large_longs(spark, src):
    df = _hard(spark)
    got = W.global_running(df, [("id", True)], {"s": ("sum", src), "m": ("max", src)}, totals={"t": src}, partitions=6)
    w = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.sum(src).over(w).alias("s"), F.max(src).over(w).alias("m"), F.sum(src).over(Window.partitionBy()).alias("t"))
    assert got.dtypes == want.dtypes and _sorted(got) == _sorted(want)


def test_no_python_and_no_size_switch(spark):
    plan = W.global_row_window(_frame(spark), [("k", True), ("id", True)], cum=("v", "cv"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInPandas" not in plan


def test_ntile_matches_builtin(spark):
    for n in (1003, 3):
        df = _frame(spark, n=n)
        got = W.global_ntile(df, [("k", True), ("id", True)], 5, "t")
        exp = df.withColumn("t", F.ntile(5).over(Window.orderBy("k", "id")))
        assert sorted((r.id, r.t) for r in got.collect()) == sorted((r.id, r.t) for r in exp.collect())


def test_several_ntiles(spark):
    df = _frame(spark, n=503)
    got = W.global_ntiles(df, {"a": [("k", True), ("id", True)], "b": [("v", False), ("id", True)]}, 5)
    exp = (df.withColumn("a", F.ntile(5).over(Window.orderBy("k", "id")).cast("long"))
             .withColumn("b", F.ntile(5).over(Window.orderBy(F.col("v").desc(), "id")).cast("long")))
    assert _sorted(got) == _sorted(exp)


@pytest.mark.parametrize("src", ["big", "d"])
@pytest.mark.parametrize("asc", [True, False])
def test_peer_cumsum_range_frame(spark, src, asc):
    df = _hard(spark)
    got = W.global_peer_cumsum(df, "k", asc, src, "cum")
    order = F.col("k").asc_nulls_last() if asc else F.col("k").desc_nulls_last()
    exp = df.withColumn("cum", F.sum(src).over(Window.orderBy(order)))
    assert got.dtypes == exp.dtypes and _sorted(got) == _sorted(exp)


def test_share_of_total_and_top_n(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 30), ("b", 3, 0), ("b", 4, 0)], "g string, id int, v int")
    s = {r.id: r.s for r in W.share_of_total(df, "v", "s", ["g"]).collect()}
    assert s == {1: 25.0, 2: 75.0, 3: 0, 4: 0}
    assert {r.id: r.s for r in W.share_of_total(df, "v", "s").collect()} == {1: 25.0, 2: 75.0, 3: 0, 4: 0}
    top = W.top_n_per_group(df, ["g"], [("v", False), ("id", True)], 1).collect()
    assert sorted(r.id for r in top) == [2, 3]


@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("asc", [True, False])
def test_global_rank_ranks_null_keys_too(spark, dense, asc):
    df = _hard(spark)
    got = W.global_rank(df, "k", asc, "r", dense=dense)
    fn = F.dense_rank() if dense else F.rank()
    order = F.col("k").asc_nulls_last() if asc else F.col("k").desc_nulls_last()
    exp = df.withColumn("r", fn.over(Window.orderBy(order)).cast("long"))
    assert _sorted(got) == _sorted(exp)


def test_renumber(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d), f"x{d}") for d in (5, 1, 3)], "d date, tag string")
    got = {r.tag: r.order_no for r in W.renumber(df, [("d", True), ("tag", True)], "order_no").collect()}
    assert got == {"x1": "ORD-00001", "x3": "ORD-00002", "x5": "ORD-00003"}
    wide = {r.tag: r.n for r in W.renumber(df, [("d", True)], "n", prefix="", width=0).collect()}
    assert wide == {"x1": "1", "x3": "2", "x5": "3"}


def test_sort_calendar_and_order_report(spark):
    df = spark.createDataFrame([(2, "April"), (1, "April"), (1, "January"), (1, "Nonsense"), (1, None), (1, "December")], "y int, m string")
    assert [(r.y, r.m) for r in W.sort_calendar(df, "m", "y").collect()] == [
        (1, "January"), (1, "April"), (1, "December"), (1, "Nonsense"), (1, None), (2, "April")]
    out = W.order_report(df, [("y", False), ("m", True)]).collect()
    assert out[0].y == 2 and out[-1].m is None


def test_moving_average(spark):
    df = spark.createDataFrame([(i, Decimal(i)) for i in range(1, 6)], "m int, v decimal(10,2)")
    assert [r.a for r in W.moving_average(df, "m", "v", "a", 3, digits=2).orderBy("m").collect()] == [1.0, 1.5, 2.0, 3.0, 4.0]
    assert [float(r.a) for r in W.moving_average(df, "m", "v", "a", 2).orderBy("m").collect()] == [1.0, 1.5, 2.5, 3.5, 4.5]
