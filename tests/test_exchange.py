"""Quoted CSV by splits, broken files, percentiles by selection, deep trees, rewrites, bundles, quarantine, listings, number and white-space parsing."""

import csv
import gzip
import io
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from bizlens.functions import dates as D
from bizlens.functions import text as X
from bizlens.operators import hierarchy as H
from bizlens.operators import quarantine as QU
from bizlens.operators.selection import group_percentiles
from bizlens.plans import cleaning
from bizlens.sources import folder as FO
from bizlens.sources import pages as PG
from bizlens.sources import quoted_csv as QC
from bizlens.sources import sinks as S


def test_line_states_follow_the_csv_module():
    """A line begun outside a quoted field ends inside one exactly if the csv module asks for more."""
    rng = random.Random(1)
    for _ in range(4000):
        line = "".join(rng.choices('a,"" ', k=rng.randrange(0, 12)))
        rows = list(csv.reader(io.StringIO(line + "\nZ,Z\n", newline="")))
        inside = rows[-1:] != [["Z", "Z"]]
        assert QC.ends_inside(line, False) == inside, line
        rows = list(csv.reader(io.StringIO('"' + line + "\nZ,Z\n", newline="")))
        assert QC.ends_inside(line, True) == (rows[-1:] != [["Z", "Z"]]), line


@pytest.mark.parametrize("split", [64, 1000, 1 << 20])
def test_records_by_splits_match_the_csv_module(spark, split):
    rng = random.Random(split)
    folder = tempfile.mkdtemp(prefix="bizlens-quoted-")
    want = {}
    for name in ("a.csv", "b.CSV", "c.csv", "empty.csv"):
        cells = lambda: [rng.choice(["", "x", "1,5", 'say "hi"', "line\nbreak", "\n\n", "é, 中\n", "end\r\ninside", "y" * rng.randrange(0, 300)]) for _ in range(3)]
        rows = [] if name == "empty.csv" else [cells() for _ in range(120)] + [["long", "z\n" * 2000, "tail"]] + [cells() for _ in range(20)]
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL if name == "a.csv" else csv.QUOTE_MINIMAL).writerows(rows)
        text = out.getvalue() + ('"never closed\nto the end' if name == "c.csv" else "")
        with open(os.path.join(folder, name), "w", newline="") as f:
            f.write(text)
        want[name] = [["" if c is None else c for c in r] for r in csv.reader(io.StringIO(text, newline="")) if r]
    got = QC.read_records(spark, folder, FO.CSV_GLOB, split).orderBy("file_path", "block", "at").collect()
    for name, rows in want.items():
        own = [["" if c is None else c for c in r.cells] for r in got if r.file_path.endswith(name)]
        assert own == rows, name


def test_a_task_takes_many_small_splits(spark, monkeypatch):
    """Both passes run in as many tasks as the files get by themselves, not in one a split."""
    rows = [(i, "a\nb" * (i % 90), None if i % 7 else "") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a string, b string").coalesce(2)
    path = tempfile.mkdtemp(prefix="bizlens-quoted-") + "/t"
    QC.write_quoted_csv(df, path)
    tasks, materialize = {}, QC.materialize

    def counted(frame, what):
        tasks[what] = frame.rdd.getNumPartitions()
        return materialize(frame, what)

    monkeypatch.setattr(QC, "materialize", counted)
    records = QC.read_records(spark, path, split_bytes=256)
    blocks = records.select("file_path", "block").distinct().count()
    own = spark.read.text(path).rdd.getNumPartitions()
    assert blocks > 60 and tasks["csv-states"] <= own and tasks["csv-records"] <= own
    assert sorted(map(tuple, QC.read_quoted_csv(spark, path, df.schema, 256).collect()), key=repr) == sorted(rows, key=repr)


def test_quoted_csv_keeps_nulls_and_types(spark):
    rows = [(1, None, "a\nb", 1.5), (2, "", '"', None), (None, "\r\n, ,", "x,y", -2.0), (4, " lead ", "\n", 0.0)]
    df = spark.createDataFrame(rows, "id long, a string, b string, c double")
    path = tempfile.mkdtemp(prefix="bizlens-quoted-") + "/t"
    QC.write_quoted_csv(df, path)
    assert sorted(map(tuple, QC.read_quoted_csv(spark, path, df.schema, 16).collect()), key=repr) == sorted(rows, key=repr)
    one = spark.createDataFrame([(None,), ("x",), ("",)], "v string")
    QC.write_quoted_csv(one, path + "1")
    assert sorted(r.v or repr(r.v) for r in QC.read_quoted_csv(spark, path + "1", one.schema).collect()) == ["''", "None", "x"]


def test_broken_files_are_error_rows(spark):
    from test_folder import make_folder
    folder = make_folder()
    before = {r.file_name: (r.row_count, r.numeric_column_count, r.status) for r in FO.profile_folder(spark, folder)[0].collect()}
    good = gzip.compress(b"a,b\n1,2\n3,4\n" * 5000)
    for name, data in (("broken.csv.gz", good[:len(good) // 2]), ("good.csv.gz", good), ("coding.csv", b"a,b\n\xff\xfe,1\n"), ("lines.csv", b'k,v\n1,"two\nlines, one cell"\n2,z\n')):
        with open(os.path.join(folder, name), "wb") as f:
            f.write(data)
    files, cols = FO.profile_folder(spark, folder)
    got = {r.file_name: r for r in files.collect()}
    assert {n for n, r in got.items() if r.status == "ERROR"} == {"broken.csv.gz", "coding.csv"}
    assert "ends inside" in got["broken.csv.gz"].error and "UTF-8" in got["coding.csv"].error
    assert all(got[n].error is None for n in before)
    assert {n: (got[n].row_count, got[n].numeric_column_count, got[n].status) for n in before} == before
    assert (got["lines.csv"].row_count, got["lines.csv"].column_count) == (3, 2)
    assert got["good.csv.gz"].row_count == 15_000
    assert not any(c.file_name in ("broken.csv.gz", "coding.csv") for c in cols.collect())


def test_percentiles_by_selection(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, rng.randrange(50), rng.randrange(10 ** 6)])) for _ in range(3000)] + [("lone", 7), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(5)
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    want = {r.k: tuple(r.p) if r.p else (None,) * 5 for r in df.groupBy("k").agg(F.percentile("v", shares).alias("p")).collect()}
    got = {r.k: tuple(r[f"p{i}"] for i in range(5)) for r in group_percentiles(df, ["k"], "v", shares).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k]) if want[k][0] is not None else got[k] == want[k]


def test_a_wide_group_spreads_over_partitions(spark):
    """A million distinct values of one group: no task holds them all."""
    df = spark.range(1_000_000).select(F.lit(1).alias("k"), (F.col("id") * 7 % 1_000_003).alias("v"))
    assert group_percentiles(df, ["k"], "v", [0.5]).first().p0 == df.select(F.percentile("v", 0.5)).first()[0]


def test_a_chain_of_ten_thousand_nodes(spark):
    n = 10_000
    chain = spark.range(n).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_id"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    odd = spark.createDataFrame([(n + 1, n + 2, "x"), (n + 2, n + 3, "y"), (n + 3, n + 1, "z"), (n + 4, n + 1, "below a cycle"), (n + 5, 10 ** 9, "orphan"), (n + 6, n + 5, "below an orphan"), (n + 7, n + 7, "own parent")],
                                "id long, parent_id long, name string")
    got = {r.id: r for r in H.tree_paths(chain.unionByName(odd), paths=False).collect()}
    assert all(got[i].level == i + 1 and got[i].root_id == 0 and got[i].root_name == "n0" for i in range(n))
    assert all(got[n + i].status == "unreachable" and got[n + i].level is None for i in range(1, 8))
    assert H.tree_paths(chain.limit(0)).collect() == []


def test_rewrite_replaces_only_its_regions(spark):
    path = tempfile.mkdtemp(prefix="bizlens-regions-") + "/r"
    S.write_partitioned(spark.createDataFrame([(1, "n"), (2, "s"), (3, "s")], "v int, region string"), path, "region")
    north = {f: os.stat(os.path.join(path, "region=n", f)).st_mtime_ns for f in os.listdir(os.path.join(path, "region=n"))}
    for _ in range(2):
        S.rewrite_partitions(spark.createDataFrame([(9, "s"), (8, "w")], "v int, region string"), path, "region")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "n"), (8, "w"), (9, "s")]
    assert north == {f: os.stat(os.path.join(path, "region=n", f)).st_mtime_ns for f in os.listdir(os.path.join(path, "region=n"))}


def test_a_bundle_is_whole_or_not_there(spark):
    path = tempfile.mkdtemp(prefix="bizlens-bundle-") + "/b"
    assert S.latest_version(spark, path) == 0 and S.read_bundle(spark, path) == {}
    first = {"a": spark.range(5), "b": spark.createDataFrame([("x", None)], "s string, m map<string,int>")}
    assert S.publish_bundle(first, path) == 1
    dies = spark.range(3).select(F.raise_error(F.lit("dies")).cast("long").alias("id"))
    with pytest.raises(Exception, match="dies"):
        S.publish_bundle({"a": spark.range(9), "b": dies}, path)
    found = S.read_bundle(spark, path, verify=True)
    assert S.latest_version(spark, path) == 1 and found["a"].count() == 5 and found["b"].count() == 1
    assert S.publish_bundle({"a": spark.range(9)}, path) == 2
    assert S.read_bundle(spark, path, verify=True)["a"].count() == 9 and S.read_bundle(spark, path, version=1)["a"].count() == 5
    where = S.manifest(spark, path).where("version = 2").first().folder
    spark.range(1).write.mode("append").parquet(f"{path}/{where}")  # somebody adds a row
    with pytest.raises(ValueError, match="not what was written"):
        S.read_bundle(spark, path, verify=True)


def test_quarantine_names_every_broken_rule(spark):
    rows = [(1, "a", 10, 1), (1, "b", None, 2), (2, None, -1, 9), (None, "c", 5, None), (None, "c", 5, 3), (3, "d", -2, 9)]
    df = spark.createDataFrame(rows, "id long, s string, v int, p long")
    parent = spark.createDataFrame([(1,), (2,), (3,), (3,)], "p long")
    rules = {"v > 0": F.col("v") > 0, "not_null(s)": F.col("s").isNotNull()}
    unique, foreign = [["id"], ["s", "v"]], [("p", parent, "p")]
    got = {(r.id, r.s, r.v, r.p): r.broken for r in QU.broken_rules(df, rules, unique, foreign).collect()}
    assert got == {rows[0]: ["unique(id)"], rows[1]: ["unique(id)"], rows[2]: ["foreign_key(p)", "not_null(s)", "v > 0"], rows[3]: ["unique(s, v)"], rows[4]: ["unique(s, v)"],
                   rows[5]: ["foreign_key(p)", "v > 0"]}
    clean, bad, metrics = QU.quarantine(df, rules, unique, foreign, observe="q")
    assert bad.count() == 6 and metrics.get == {"checked": 6, "broken_rows": 6} and clean.columns == df.columns and clean.count() == 0
    assert QU.broken_rules(df.limit(0), rules, unique, foreign).collect() == []
    assert [r.broken for r in QU.broken_rules(df.limit(1), {"v > 0": F.col("v") > 0}).collect()] == [[]]


def test_nested_listings(spark):
    pod = lambda t, inner="": f'<article class="x product_pod" title="1 > 0"><h3><a href="a/{t}/index.html" title="{t}">s</a></h3><p class="price_color">£1.50</p>{inner}</article>'
    pages = [(1, "u", pod("one", pod("two") + "between" + pod("three")) + pod("four")), (2, "u", "<!-- " + pod("hidden") + " --><article>" + pod("five") + "</article>"), (3, "u", None),
             (4, "u", '<article class="product_pod"><h3><a title="open">'), (4, "u", pod("same id")), (5, "u", "</article>" + pod("after a stray end"))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = sorted((r.page_id, r.title, r.pod_no, r.price) for r in PG.nested_records(df).collect())
    assert got == sorted([(1, "one", 0, 1.5), (1, "two", 1, 1.5), (1, "three", 2, 1.5), (1, "four", 3, 1.5), (2, "five", 0, 1.5), (4, "open", 0, None), (4, "same id", 0, 1.5)])


def test_numbers_and_spaces(spark):
    texts = ["1d", "5f", "0x1p3", "nan", "Infinity", "1e3", " 2.5 ", "$1,234.5", "-3", ".5", "5.", "", None, "1 2", "+7"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = [(r.p, r.q) for r in df.select("i", X.parse_price(F.col("s")).alias("p"), X.parse_quantity(F.col("s")).alias("q")).orderBy("i").collect()]
    assert [p for p, _ in got] == [None, None, None, None, None, 1000.0, 2.5, 1234.5, None, 0.5, 5.0, None, None, None, 7.0]
    assert [q for _, q in got] == [None, None, None, None, None, 1000, 2, None, None, 0, 5, None, None, None, 7]
    spaces = spark.createDataFrame([(" a   b　",), ("\x0bc\x1cd\x85",)], "s string")
    assert [r[0] for r in spaces.select(X.squeeze(F.col("s"))).collect()] == ["a b", "c d"]
    marks = spark.createDataFrame([("\u0001ab \u0001 c\u0001\u0001d",)], "s string")
    assert marks.select(X.proper(F.col("s"))).first()[0] == "\u0001ab \u0001 c\u0001\u0001d".title()


def test_cells_are_squeezed_once(spark):
    raw = spark.createDataFrame([("1",) * 8], ", ".join(f"{c} string" for c in cleaning.SALES_COLUMNS))
    plan = cleaning.clean_sales(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"\u1680") == len(cleaning.SALES_COLUMNS), plan


def test_white_space_and_days(spark):
    ends = spark.createDataFrame([(f"{w}a {w}b{w}",) for w in X.WHITE_CHARS] + [("\x7f",), (" ",), (None,)], "s string")
    assert [tuple(r) for r in ends.select(X.strip(F.col("s")), X.squeeze(F.col("s"))).collect()] == [(f"a {w}b", "a b") for w in X.WHITE_CHARS] + [("\x7f", "\x7f"), ("", ""), (None, None)]
    days = ["2020-02-29", "2021-02-29", " 02/29/2020 ", "29/02/2020", "31.04.2021", "30.04.2021", "2020-02-29\n", "30.04.2021\n", "03-mar-2020", "31-Feb-2020", "2020-1-01", "", None]
    got = [r[0] for r in spark.createDataFrame([(d,) for d in days], "s string").select(D.parse_date_multi(F.col("s")).cast("string")).collect()]
    assert got == ["2020-02-29", None, "2020-02-29", None, None, "2021-04-30", None, None, "2020-03-03", None, None, None, None]


def test_equal_turns_of_different_conversations_stay(spark):
    class T(dict):
        pass
    rows = [(1, 0, "user", "ok"), (2, 0, "user", "ok"), (2, 1, "user", "ok"), (2, 1, "user", "ok"), (None, 3, "user", None), (None, 3, "user", None), (None, 4, "user", None)]
    t = T(conversations=spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"),
          documents=spark.createDataFrame([(None, "a", "en", "s"), (None, "b", "en", "s"), (2, "a", "en", "s"), (None, "b", "en", "s")], "doc_id long, text string, lang string, source string"))
    assert sorted(map(tuple, cleaning.cleaned_conversations(t).collect()), key=repr) == sorted({(c, n, "User", x) for c, n, _, x in rows}, key=repr)
    assert sorted(map(tuple, cleaning.cleaned_documents(t).collect()), key=repr) == [(2, "a", "English", "S"), (None, "b", "English", "S")]
