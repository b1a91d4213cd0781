"""Property tests: text functions agree with the Python semantics they
re-express, on random ASCII text (one Spark job per generated batch)."""

import string

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bizlens.functions import text as X

ALPHABET = string.ascii_letters + string.digits + " '-_.,&/\t" + "  "


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=24), min_size=1, max_size=60))
def test_proper_and_squeeze_match_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = df.select("i", X.proper(F.col("s")).alias("p"), X.squeeze(F.col("s")).alias("q")).orderBy("i").collect()
    for r, v in zip(got, values):
        assert r.p == v.title(), (v, r.p)
        assert r.q == " ".join(v.split()), (v, r.q)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.integers(-10**6, 10**6).map(str),
                          st.decimals(-10**5, 10**5, places=2, allow_nan=False).map(str),
                          st.text(alphabet="0123456789.$,- abc", max_size=10)), min_size=1, max_size=60))
def test_parse_price_matches_python(spark, values):
    def py(v):
        s = v.strip().replace("$", "").replace(",", "")
        try:
            x = float(s)
        except ValueError:
            return None
        return x if x >= 0 else None
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = [r.p for r in df.select("i", X.parse_price(F.col("s")).alias("p")).orderBy("i").collect()]
    assert got == [py(v) for v in values]


def test_partitioning_invariance(spark):
    """Operators give the same answer whatever the input partitioning."""
    from bizlens.operators import baskets, windows as W
    from conftest import SF001
    items = spark.read.parquet(f"{SF001}/lineitem.parquet").selectExpr("l_orderkey AS order_id",
                                                                       "l_partkey AS product_id")
    names = spark.read.parquet(f"{SF001}/part.parquet").selectExpr("p_partkey AS product_id", "p_name AS name")
    cust = spark.read.parquet(f"{SF001}/orders.parquet").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("spend"))
    results = []
    for parts in (1, 7, 64):
        pairs = baskets.name_pair_counts(items.repartition(parts), names, min_count=1)
        tiles = W.global_ntile(cust.repartition(parts), [("spend", True), ("o_custkey", True)], 5, "t")
        results.append((sorted(map(tuple, pairs.collect())), sorted(map(tuple, tiles.collect()))))
    assert results[0] == results[1] == results[2]


def test_shares_and_totals(spark):
    import __spark_entry__ as E
    from conftest import SF01
    q = E.queries()
    pct = q["category_revenue"](spark, SF01).agg(F.sum("pct_of_total")).first()[0]
    assert abs(pct - 100) <= 0.01 * 6
    share = q["country_breakdown"](spark, SF01).agg(F.sum("share")).first()[0]
    assert abs(share - 1) <= 0.0001 * 25
    rd = q["region_detail"](spark, SF01)
    totals = {r.region: (r.units, r.revenue) for r in rd.where("product = 'TOTAL'").collect()}
    detail = {r.region: (r.u, r.r) for r in rd.where("product <> 'TOTAL'").groupBy("region")
              .agg(F.sum("units").alias("u"), F.sum("revenue").alias("r")).collect()}
    assert totals.keys() == detail.keys()
    for k in totals:
        assert totals[k][0] == detail[k][0] and abs(totals[k][1] - detail[k][1]) < 1e-3
