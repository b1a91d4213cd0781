"""Declared schemas, all rules of several tables in one pass, several tilings by one range partitioning."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bizlens.operators import quality as Q
from bizlens.operators import windows as W
from bizlens.plans.quality import constraint_report
from bizlens.sources.tables import DECLARED, DRIVER_TABLES, SchemaDrift, declared_schema, load_tables, read_table

from conftest import SF001


def test_every_table_has_a_schema_and_the_given_ones_agree(spark):
    assert set(DECLARED) == set(DRIVER_TABLES)
    for name in DRIVER_TABLES:
        assert read_table(spark, SF001, name).schema == declared_schema(name)


def test_drift_raises_with_all_faults(spark, tmp_path):
    spark.range(3).select(F.col("id").cast("string").alias("r_regionkey")).write.parquet(f"{tmp_path}/region.parquet")
    with pytest.raises(SchemaDrift, match="region: r_regionkey is string, declared int; r_name is missing"):
        load_tables(spark, str(tmp_path))["region"]


def test_narrow_numbers_widen_and_further_columns_stay(spark, tmp_path):
    spark.range(3).selectExpr("cast(id as int) AS c_custkey", "'x' AS c_name", "cast(id as smallint) AS c_nationkey",
                              "cast(1.5 AS float) AS c_acctbal", "'y' AS c_mktsegment", "id AS more").write.parquet(f"{tmp_path}/customer.parquet")
    got = load_tables(spark, str(tmp_path))["customer"]
    assert got.dtypes == [(f.name, f.dataType.simpleString()) for f in declared_schema("customer")] + [("more", "bigint")]
    assert sorted(r.c_custkey for r in got.collect()) == [0, 1, 2]


def test_wide_numbers_are_drift(spark, tmp_path):
    spark.range(3).selectExpr("id AS r_regionkey", "'x' AS r_name").write.parquet(f"{tmp_path}/region.parquet")
    with pytest.raises(SchemaDrift, match="bigint, declared int"):
        read_table(spark, str(tmp_path), "region")


def test_every_file_is_looked_at_on_demand(spark, tmp_path):
    path = f"{tmp_path}/region.parquet"
    spark.range(3).selectExpr("cast(id AS int) AS r_regionkey", "'x' AS r_name").coalesce(1).write.parquet(path)
    spark.range(3).selectExpr("cast(id AS string) AS r_regionkey", "'x' AS r_name").coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(Exception, match="(?i)r_regionkey|merge"):
        read_table(spark, str(tmp_path), "region", every_file=True)


def _rows(df):
    return {(r.table, r.rule): (r.checked, r.violations) for r in df.collect()}


def test_several_tables_in_one_pass_match_the_single_checks(spark):
    rng = random.Random(3)
    parents = spark.createDataFrame([(i if i % 9 else None, f"n{i % 40}", i) for i in range(60)] + [(1, "twice", 1)], "id int, name string, v long")
    children = spark.createDataFrame([(rng.choice([None, *range(70)]), rng.choice([None, "n1", "n2", "lost"]), rng.randrange(5), rng.choice([None, "a", "1:a"]))
                                      for _ in range(500)] + [(5, "n1", 0, "a")] * 400, "pid long, pname string, no int, word string")
    other = spark.createDataFrame([(i,) for i in range(0, 90, 3)], "ref int")
    p_rules, c_rules = {"v < 50": F.col("v") < 50}, {"no > 0": F.col("no") > 0, **Q.not_null_rules(["word"])}
    got = _rows(Q.check_tables([
        Q.Declared("p", parents, p_rules, [["id"], ["name"]]),
        Q.Declared("c", children, c_rules, [["pid", "no"], ["pname", "word", "no"]], [("pid", "p", "id"), ("pname", "p", "name")]),
        Q.Declared("o", other, foreign=[("ref", "p", "id")]),
        Q.Declared("none", other.limit(0), {"ref > 0": F.col("ref") > 0}, [["ref"]], [("ref", "p", "id")])]))
    want = [Q.row_rules(parents, "p", p_rules), Q.unique_key(parents, "p", ["id"]), Q.unique_key(parents, "p", ["name"]),
            Q.row_rules(children, "c", c_rules), Q.unique_key(children, "c", ["pid", "no"]), Q.unique_key(children, "c", ["pname", "word", "no"]),
            Q.foreign_key(children, "c", "pid", parents, "id"), Q.foreign_key(children, "c", "pname", parents, "name"),
            Q.foreign_key(other, "o", "ref", parents, "id")]
    none = {("none", r): (0, 0) for r in ("ref > 0", "unique(ref)", "foreign_key(ref)")}
    assert got == _rows(Q.union_results(want)) | none


def test_a_table_that_refers_to_itself_and_a_key_used_twice(spark):
    tree = spark.createDataFrame([(1, None, 1), (2, 1, 7), (3, 9, 2), (4, 9, 8)], "id long, up long, like long")
    got = _rows(Q.check_tables([Q.Declared("t", tree, unique=[["id"]], foreign=[("up", "t", "id"), ("like", "t", "id")])]))
    assert got == {("t", "unique(id)"): (4, 0), ("t", "foreign_key(up)"): (4, 2), ("t", "foreign_key(like)"): (4, 2)}


def test_constraint_report_scans_each_table_once(spark):
    plan = constraint_report(load_tables(spark, SF001))._jdf.queryExecution().optimizedPlan().toString()
    for name in ("o_orderkey", "l_orderkey", "event_id" if "event_id" in plan else "user_id"):
        scans = [x for x in plan.splitlines() if "Relation [" in x and name in x]
        assert len(scans) == 1, (name, len(scans))


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 7, 501])
def test_tilings_match_the_builtin_with_nulls_and_ties(spark, n):
    rng = random.Random(n)
    df = spark.createDataFrame([(i, rng.choice([None, 1, 1, 1, 2, 7]), rng.choice([None, "a", "b", "ä"])) for i in range(n)], "id long, k int, w string")
    by = {"t": [("k", True), ("id", True)], "u": [("w", False), ("k", False), ("id", False)], "v": [("id", True)]}
    want = df.select("*", *(F.ntile(5).over(Window.orderBy(*(F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last() for c, asc in keys))).cast("long").alias(out)
                            for out, keys in by.items()))
    got = W.global_ntiles(df, by, 5)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == sorted(map(tuple, want.collect()), key=lambda r: r[0])
