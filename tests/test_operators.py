"""Golden tests for quality rules, cleaning, baskets, segments, series guards, sinks."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from bizlens.operators import baskets, quality as Q, profile as P
from bizlens.plans import cleaning, customers
from bizlens.sources import csv as CSV, sinks

d = dt.date


def test_quality_rules(spark):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    child = spark.createDataFrame([(1, 1, "a@b.co", 5), (2, 2, None, -1), (3, 37, "bad", 3), (4, None, "x@y.org", None),
                                   (4, 2, "a@b.co", 2)], "cid int, pid int, email string, qty int")
    rows = {r.rule: r for r in Q.row_rules(child, "t", {
        **Q.not_null_rules(["email"]), "qty > 0": F.col("qty") > 0,
        "email_format": F.col("email").rlike(r"^[^@]+@[^@]+\.[a-z]{2,}$")}).collect()}
    assert rows["not_null(email)"].violations == 1
    assert rows["qty > 0"].violations == 1            # NULL passes a CHECK
    assert rows["email_format"].violations == 1       # NULL passes, "bad" fails
    assert Q.unique_key(child, "t", ["cid"]).first().violations == 2
    assert Q.unique_key(child, "t", ["email"]).first().violations == 2   # NULL emails never collide
    assert Q.foreign_key(child.limit(0), "t", "pid", parent, "id").first().checked == 0
    every = {r.rule: (r.checked, r.violations) for r in Q.check_table(
        child, "t", {"qty > 0": F.col("qty") > 0}, [["cid"], ["email"]], [("pid", parent, "id")]).collect()}
    assert every == {"qty > 0": (5, 1), "unique(cid)": (5, 2), "unique(email)": (5, 2), "foreign_key(pid)": (5, 1)}
    fk = Q.foreign_key(child, "t", "pid", parent, "id").first()
    assert (fk.checked, fk.violations) == (5, 1)       # NULL FK allowed; 37 is the orphan
    assert [r.pid for r in Q.orphans(child, "pid", parent, "id").collect()] == [37]


def test_profile_ops(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, "x"), ("b", "y")], "c1 string, c2 string")
    assert {r.column: r.nulls for r in P.null_counts(df).collect()} == {"c1": 1, "c2": 2}
    vc = {(r.column, r.value): r["count"] for r in P.value_counts(df, ["c1"]).collect()}
    assert vc == {("c1", "a"): 2, ("c1", None): 1, ("c1", "b"): 1}
    assert spark.range(1).select(P.duplicate_count(df)).first()[0] == 1


MESSY_CSV = """order_id,date,category,product_name,quantity,unit_price,region,salesperson
1,2024-03-15, Electronics ,  premium   bundle ,2.5,"$1,234.50",n,Ann Lee
2,03/15/2024,Electornics,men's kit,3.5, 99.5 , North,Bob
3,15.03.2024,ELECTRONICS,usb-c hub,1000,-5.00,SOUTH,Cy
4,15-Mar-2024,Home &  Garden,x,1001,abc,central,Di
5,02/30/2024,Home&Garden,x,-1,0,N/A,Ed
6,2024/03/15,garden tools,x,x,,-,Fay
7,15 Mar 2024,Home and Garden,x,NA,null,s,Gus
8,2024-03-15,toys,y,2,1,e,Hal
8,2024-03-15,toys,y,2,1,e,Hal
8,2024-03-15,toys,y,2,1,e,Hal \n"""


def test_cleaning_goldens(spark):
    folder = tempfile.mkdtemp(prefix="bizlens-csv-")
    with open(os.path.join(folder, "messy.csv"), "w") as f:
        f.write(MESSY_CSV)
    raw = CSV.read_sales_csv(spark, folder, columns=cleaning.SALES_COLUMNS)
    rows = cleaning.clean_sales(raw).collect()
    assert len(rows) == 9                      # exact duplicate dropped, trailing-space twin kept
    assert sum(r.salesperson == "Hal" for r in rows) == 2
    out = {(r.order_id, r.salesperson): r for r in rows}
    x = d(2024, 3, 15)
    by_id = {}
    for (oid, _), r in out.items():
        by_id.setdefault(oid, r)
    assert [by_id[i].date for i in range(1, 8)] == [x, x, x, x, None, None, None]
    assert [by_id[i].category for i in range(1, 8)] == ["Electronics", "Electronics", "Electronics",
                                                       "Home & Garden", "Home & Garden", "Garden Tools",
                                                       "Home & Garden"]
    assert [by_id[i].product_name for i in (1, 2, 3)] == ["Premium Bundle", "Men'S Kit", "Usb-C Hub"]
    assert [by_id[i].region for i in range(1, 8)] == ["North", "North", "South", "Central", None, None, "South"]
    assert [by_id[i].unit_price for i in range(1, 8)] == [1234.5, 99.5, None, None, 0.0, None, None]
    assert [by_id[i].quantity for i in range(1, 8)] == [2, 4, 1000, None, None, None, None]
    # idempotent on values: cleaning its own text form changes no value (the rows
    # that only became equal by trimming now merge, as dedup runs first)
    once = cleaning.clean_sales(raw)
    again = cleaning.clean_sales(once.select(*[F.col(c).cast("string").alias(c) for c in cleaning.SALES_COLUMNS]))
    assert set(map(tuple, again.collect())) == set(map(tuple, once.collect()))


def _brute(items, names):
    import itertools
    exp, by_order = {}, {}
    for o, p in items:
        by_order.setdefault(o, []).append(p)
    for ps in by_order.values():
        for a, b in itertools.product(ps, ps):
            if a < b:
                k = (min(names[a], names[b]), max(names[a], names[b]))
                exp[k] = exp.get(k, 0) + 1
    return exp


def test_baskets_match_brute_force(spark):
    import random
    random.seed(7)
    items = [(o, random.randint(1, 12)) for o in range(60) for _ in range(random.randint(1, 6))]
    items += [(999, p) for p in range(1, 13) for _ in range(3)]     # one very large basket
    names = {p: f"n{p % 5}" for p in range(1, 13)}
    idf = spark.createDataFrame(items, "order_id long, product_id long")
    ndf = spark.createDataFrame(list(names.items()), "product_id long, name string")
    for block in (1, 2, 512):           # a wide order in many, some, and one block
        for k in (1, 2, 3):
            got = {(r.product_a, r.product_b): r.times_bought_together
                   for r in baskets.name_pair_counts(idf, ndf, min_count=k, block_names=block).collect()}
            assert got == {p: n for p, n in _brute(items, names).items() if n >= k}, (block, k)


def test_wide_basket_is_spread_over_tasks(spark):
    n = 3000
    idf = spark.range(n).select(F.lit(1).cast("long").alias("order_id"), F.col("id").alias("product_id"))
    ndf = spark.range(n).select(F.col("id").alias("product_id"), F.concat(F.lit("n"), "id").alias("name"))
    out = baskets.name_pair_counts(idf, ndf, min_count=1, block_names=100)
    tasks = out.groupBy(F.spark_partition_id()).count().count()
    assert out.count() == n * (n - 1) // 2 and tasks >= 4


def test_value_segments_edges(spark):
    as_of = d(2024, 12, 31)
    rows = [(1, "vip_at_risk", d(2024, 1, 1), Decimal("5000.00")),     # VIP and inactive -> VIP
            (2, "new_edge", as_of - dt.timedelta(days=60), Decimal("10.00")),   # exactly -60 -> New
            (3, "risk_edge", as_of - dt.timedelta(days=200), Decimal("10.00")),
            (3, "risk_edge", as_of - dt.timedelta(days=90), Decimal("10.00")),  # last exactly -90 -> not At Risk
            (4, "old", as_of - dt.timedelta(days=300), Decimal("20.00"))]
    rows += [(10 + i, f"c{i}", as_of - dt.timedelta(days=70), Decimal("1.00")) for i in range(8)]
    sales = spark.createDataFrame(rows, "customer_id long, customer_name string, date date, revenue decimal(12,2)")
    names = sales.select("customer_id", "customer_name").distinct()
    seg = {r.customer_id: r.segment for r in customers.value_segments(sales.drop("customer_name"), names, as_of).collect()}
    assert seg[1] == "VIP" and seg[2] == "New" and seg[3] == "Regular" and seg[4] == "At Risk"


def test_corr_guards(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (1, 2.0, 5.0), (2, 3.0, 1.0), (3, 1.0, 2.0), (3, 2.0, 4.0)],
                               "g int, x double, y double")
    from bizlens.operators import aggregates as A
    assert {r.g: r.corr for r in A.corr_by(df, ["g"], "x", "y").collect()} == {1: 0.0, 2: None, 3: 1.0}


def test_sinks_round_trip(spark):
    root = tempfile.mkdtemp(prefix="bizlens-sink-")
    df = spark.createDataFrame([("EU", d(2024, 1, 2), 1.5), ("US", d(2024, 1, 3), 2.5)], "region string, d date, v double")
    sinks.write_csv(df, os.path.join(root, "csv"))
    back = spark.read.option("header", True).csv(os.path.join(root, "csv"))
    assert sorted(r.d for r in back.collect()) == ["2024-01-02", "2024-01-03"]
    sinks.write_partitioned(df, os.path.join(root, "by_region"), "region")
    assert {e for e in os.listdir(os.path.join(root, "by_region")) if e.startswith("region=")} == \
        {"region=EU", "region=US"}
    paths = sinks.write_report({"a": df, "b": df.limit(1)}, os.path.join(root, "bundle"))
    assert spark.read.parquet(paths["b"]).count() == 1


def test_hot_region_is_written_by_many_tasks(spark):
    root = tempfile.mkdtemp(prefix="bizlens-hot-")
    df = spark.range(200_000).select(F.when(F.col("id") % 10 < 9, "EU").otherwise(F.concat(F.lit("r"), F.col("id") % 5)).alias("region"),
                                     "id", F.sha2(F.col("id").cast("string"), 256).alias("text")).repartition(8)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        sinks.write_partitioned(df, os.path.join(root, "out"), "region")
    finally:
        spark.conf.set(key, before)
    files = [f for f in os.listdir(os.path.join(root, "out", "region=EU")) if f.startswith("part-")]
    assert len(files) > 3 and spark.read.parquet(os.path.join(root, "out")).count() == 200_000


def test_aggregate_operators(spark):
    from bizlens.operators import aggregates as A
    df = spark.createDataFrame([("EU", "a", 5, d(2024, 2, 1)), ("EU", "b", 5, d(2024, 8, 1)), ("US", "a", 7, d(2024, 3, 1)),
                                ("US", "c", 1, d(2024, 9, 1))], "reg string, prod string, v int, m date")
    top = {r.reg: r.best for r in A.top_by(df, ["reg"], "prod", "v", "best").collect()}
    assert top == {"EU": "a", "US": "a"}                      # tie on EU -> name order
    assert A.top_by(df, [], "prod", "v").first()[0] == "a"
    tot = {(r.reg, r.prod): r.v for r in A.with_totals(df, ["reg", "prod"], ["v"]).collect()}
    assert tot[("EU", "TOTAL")] == 10 and tot[("US", "TOTAL")] == 8 and tot[("EU", "a")] == 5
    wide = A.pivot_wide(df, ["reg"], "prod", ["a", "b", "c"], ["v"]).where("reg = 'EU'").first()
    assert (wide.a_v, wide.b_v, wide.c_v) == (5, 5, None)
    g = {r.reg: r.growth for r in A.half_year_growth(df, ["reg"], "m", "v").collect()}
    assert g == {"EU": 0.0, "US": round((1 - 7) / 7, 4)}
    st = A.customer_stats(df, key="reg", date="m", amount="v").where("reg = 'US'").first()
    assert (st.orders, st.total, st.first_date, st.last_date) == (2, 8, d(2024, 3, 1), d(2024, 9, 1))
    c = {r.reg: r.corr for r in A.corr_by(df.withColumn("w", F.col("v") * 2), ["reg"], "v", "w").collect()}
    assert c == {"EU": 0.0, "US": 1.0}


def test_budget_edges(spark):
    from bizlens.plans import budget as B
    led = spark.createDataFrame([
        (2024, 1, "Food", Decimal("700.00")),
        (2024, 1, "Pets", Decimal("50.00")),        # category without a budget
        (2024, 3, "Housing", Decimal("1800.00")),
    ], "year int, month int, category string, actual decimal(12,2)")
    budgets = spark.createDataFrame([("Food", 600), ("Housing", 1800)], "category string, budget int")
    rows = {(r.category, r.month): r for r in B.budget_vs_actual_long(led, budgets).collect()}
    assert ("Pets", 1) not in rows                                   # only budgeted categories are listed
    food_jan, food_feb = rows[("Food", 1)], rows[("Food", 2)]
    assert (food_jan.actual, food_jan.variance, food_jan.var_pct) == (Decimal("700.00"), Decimal("-100.00"), -0.1667)
    assert (food_feb.actual, food_feb.variance, food_feb.var_pct) == (0, 600, 1.0)   # month without data
    tot = rows[("TOTAL", 3)]
    assert (tot.budget, tot.actual) == (2400, Decimal("1800.00"))


def test_half_year_growth_zero_h1(spark):
    from bizlens.operators import aggregates as A
    df = spark.createDataFrame([("x", d(2024, 8, 1), 10), ("y", d(2024, 2, 1), 4), ("y", d(2024, 9, 1), 5)],
                               "k string, m date, v int")
    g = {r.k: r.growth for r in A.half_year_growth(df, ["k"], "m", "v").collect()}
    assert g == {"x": 0.0, "y": 0.25}


def test_approx_options(spark):
    from bizlens.plans import reports
    from bizlens.sources.tables import load_tables
    from conftest import SF001
    t = load_tables(spark, SF001)
    exact = reports.executive_kpis(t).first().unique_customers
    approx = reports.executive_kpis(t, approx=True).first().unique_customers
    assert abs(approx - exact) <= 0.05 * exact
    ex = {r.month: r.median_days_to_deliver for r in reports.fulfilment_times(t).collect()}
    ap = {r.month: r.median_days_to_deliver for r in reports.fulfilment_times(t, approx=True).collect()}
    # the sketch returns an observed value (no interpolation between the middle two)
    assert ex.keys() == ap.keys() and all(ap[m] is not None and ap[m] >= 0 for m in ap)


def test_read_sales_csv_header_from_file(spark):
    folder = tempfile.mkdtemp(prefix="bizlens-csv2-")
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("id,region,price\n1, North ,N/A\n2,-,$5\n3,,none\n4, - ,x\n")
    df = CSV.read_sales_csv(spark, folder)
    assert df.columns == ["id", "region", "price"]
    rows = {r.id: r for r in df.collect()}
    assert rows["1"].region == " North " and rows["1"].price is None     # whitespace kept, marker -> NULL
    assert rows["2"].region is None and rows["3"].region is None and rows["3"].price is None
    assert rows["4"].region == " - "                                      # not an exact marker


def test_top_k_flags(spark):
    from bizlens.operators import aggregates as A
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 1), (4, None), (5, 1)], "id int, v int")
    got = {r.id: (r.is_top, r.is_bottom) for r in A.top_k_flags(df, "id", "v", 1).collect()}
    assert got == {1: (True, False), 2: (False, False), 3: (False, False), 4: (False, False), 5: (False, True)}
    assert A.top_k_flags(df.limit(0), "id", "v", 2).collect() == []


def test_tree_of_any_depth(spark):
    import pytest
    from bizlens.operators import hierarchy as H
    rows = [(i, i - 1 if i else None, f"n{i}") for i in range(150)] + [(900, 901, "a"), (901, 900, "b"), (950, 777, "orphan")]
    nodes = spark.createDataFrame(rows, "id long, parent_id long, name string")
    walk = H.tree_paths(nodes, max_depth=200)
    got = {r.id: r for r in walk.collect()}
    assert len(got) == 153 and got[149].level == 150 and got[149].root_id == 0 and len(got[149].path_ids) == 150
    assert [got[i].status for i in (900, 901, 950)] == ["unreachable"] * 3 and got[900].level is None
    own = spark.createDataFrame([(149, 2), (149, 1), (10, 5)], "id long, v int")
    sums = {r.id: r.v for r in H.subtree_totals(walk, own, ["v"]).collect()}
    assert sums[0] == 8 and sums[10] == 8 and sums[11] == 3 and sums[149] == 3
    with pytest.raises(Exception, match="RECURSION_LEVEL_LIMIT"):
        H.tree_paths(nodes, max_depth=20).collect()


def test_text_tables_cleaning(spark):
    class T(dict):
        pass
    t = T(documents=spark.createDataFrame([(3, "a  b", "EN", " src1 "), (1, "a  b", "EN", " src1 "), (2, "N/A", "pt", "-"), (4, None, None, "x")],
                                          "doc_id long, text string, lang string, source string"))
    got = sorted(tuple(r) for r in cleaning.cleaned_documents(t).collect())
    assert got == [(1, "a b", "English", "Src1"), (2, None, "Pt", None), (4, None, None, "X")]
