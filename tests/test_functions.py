"""Golden tests for scalar functions, lookups and criteria (FIXTURES §2-§3)."""

import datetime as dt

from pyspark.sql import functions as F

from bizlens.functions import dates as D
from bizlens.functions import text as X
from bizlens.operators import criteria as C
from bizlens.operators import lookups as L

d = dt.date


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def col_values(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {typ}")
    return [r["v"] for r in df.select("i", fn(F.col("s")).alias("v")).orderBy("i").collect()]


def test_parse_date_multi(spark):
    got = col_values(spark, ["2024-03-15", "03/15/2024", "15.03.2024", "15-Mar-2024", "15-mar-2024",
                             "02/30/2024", "2024/03/15", "15 Mar 2024", None, " 2024-03-15 "],
                     D.parse_date_multi)
    x = d(2024, 3, 15)
    assert got == [x, x, x, x, x, None, None, None, None, x]


def test_proper_and_case(spark):
    got = col_values(spark, ["mIxEd CaSe", "men's kit", "usb-c hub", "  premium bundle", "", None, "2nd place"],
                     X.proper)
    assert got == ["Mixed Case", "Men'S Kit", "Usb-C Hub", "  Premium Bundle", "", None, "2Nd Place"]
    assert one(spark, F.upper(F.lit("mIxEd CaSe"))) == "MIXED CASE"
    assert one(spark, F.lower(F.lit("mIxEd CaSe"))) == "mixed case"


def test_text_functions(spark):
    assert one(spark, X.squeeze(F.lit("  John   Smith  "))) == "John Smith"
    assert one(spark, X.excel_trim(F.lit("  John   Smith  "))) == "John Smith"
    assert one(spark, X.text_before(F.lit("jane.doe@example.com"), "@")) == "jane.doe"
    assert one(spark, X.text_before(F.lit("no-at-sign"), "@")) is None
    assert one(spark, X.mid(F.lit("INV-2025-00412"), 5, 4)) == "2025"
    assert one(spark, X.right(F.lit("SKU-8842-BLK"), 3)) == "BLK"
    assert one(spark, X.substitute(F.lit("New York, NY 10001"), ",", " -")) == "New York - NY 10001"
    assert one(spark, X.substitute(F.lit("product_name_final_v2"), "_", " ")) == "product name final v2"
    assert one(spark, X.excel_concat("Hello, ", F.lit("Alice"), "! Welcome aboard.")) == "Hello, Alice! Welcome aboard."
    s = F.lit("2025/04/15")
    assert one(spark, X.excel_concat(X.mid(s, 6, 2), "-", X.right(s, 2), "-", X.left(s, 4))) == "04-15-2025"
    assert one(spark, X.find("@", F.lit("a@b"))) == 2


def test_price_and_quantity(spark):
    got = col_values(spark, ["$1,234.50", " 99.5 ", "-5.00", "abc", "0", None], X.parse_price)
    assert got == [1234.5, 99.5, None, None, 0.0, None]
    got = col_values(spark, ["2.5", "3.5", "1000", "1001", "-1", "x", None], X.parse_quantity)
    assert got == [2, 4, 1000, None, None, None, None]


def test_na_markers(spark):
    got = col_values(spark, ["N/A", "null", "none", "NA", "-", "", " - ", "ok", "NaN"], X.na_to_null)
    assert got == [None, None, None, None, None, None, " - ", "ok", None]


def test_rating_size_name(spark):
    got = col_values(spark, ["Three", "One", "Zero", None], X.rating_value)
    assert got == [3, 1, 0, 0]
    got = col_values(spark, [500, 2048, 5 * 1024 * 1024, 3 * 1024 ** 3], X.human_size, "long")
    assert got == ["500 bytes", "2.0 KB", "5.0 MB", "3.0 GB"]
    assert one(spark, X.safe_name(F.lit("sales:2024/q1?.csv"), F.lit(3))) == "3_sales_2024_q1_"
    assert one(spark, X.is_valid_email(F.lit("A.B@Example.COM"))) is True
    assert one(spark, X.is_valid_email(F.lit("bad@nodot"))) is False


def test_dates(spark):
    a, b = F.lit(d(2025, 1, 6)), F.lit(d(2025, 3, 28))
    assert one(spark, D.networkdays(a, b)) == 60
    assert one(spark, D.networkdays(b, a)) == -60
    assert one(spark, D.eomonth(F.lit(d(2025, 2, 10)), 0)) == d(2025, 2, 28)
    assert one(spark, D.eomonth(F.lit(d(2025, 3, 3)), 1)) == d(2025, 4, 30)
    assert one(spark, D.datedif(a, b, "M")) == 2
    assert one(spark, D.datedif(a, b, "D")) == 81
    assert one(spark, D.workday(F.lit(d(2025, 4, 1)), 30)) == d(2025, 5, 13)
    got = col_values(spark, [d(2025, 1, 15), d(2025, 5, 20), d(2025, 9, 1), d(2025, 12, 31)], D.quarter_label, "date")
    assert got == ["Q1", "Q2", "Q3", "Q4"]
    assert one(spark, D.month_label(F.lit(d(2019, 1, 1)))) == "Jan-2019"


def test_networkdays_brute_force(spark):
    import numpy as np
    rows = []
    base = d(2024, 12, 23)
    for i in range(0, 20):
        for j in range(0, 20):
            rows.append((base + dt.timedelta(days=i), base + dt.timedelta(days=i + j)))
    df = spark.createDataFrame(rows, "a date, b date")
    got = df.select("a", "b", D.networkdays(F.col("a"), F.col("b")).alias("n")).collect()
    for r in got:
        assert r["n"] == int(np.busday_count(r["a"], r["b"] + dt.timedelta(days=1))), r


def test_workday_brute_force(spark):
    import numpy as np
    rows = [(d(2025, 3, 1) + dt.timedelta(days=i), n) for i in range(14) for n in range(-24, 25) if n]
    df = spark.createDataFrame(rows, "a date, n int")
    got = df.select("a", "n", D.workday(F.col("a"), F.col("n")).alias("w")).collect()
    for r in got:
        exp = np.busday_offset(r["a"], r["n"], roll="backward" if r["n"] > 0 else "forward")
        assert r["w"] == exp.astype(dt.date), r


def test_holidays(spark):
    df = spark.createDataFrame([(d(2025, 1, 6), d(2025, 3, 28)), (d(2025, 1, 6), d(2025, 3, 28))], "a date, b date")
    hol = spark.createDataFrame([(d(2025, 1, 20),), (d(2025, 2, 17),), (d(2025, 2, 15),)], "holiday date")
    got = D.networkdays_with_holidays(df, "a", "b", hol).collect()
    assert [r["networkdays"] for r in got] == [58, 58]


# (row, badge, who, team, pay): own rows; badge 7 stands twice, team of 9 is NULL
STAFF = [(1, 7, "Ines Moreau", "Kitchen", 31000), (2, 3, "Tom Okoro", "Garden", 28500), (3, 7, "Ines M.", "Cellar", 1),
         (4, 9, "Lena Voss", None, 40250), (5, 12, "Raj Iyer", "Kitchen", 36700)]


def test_lookups(spark):
    staff = spark.createDataFrame(STAFF, "line int, badge int, who string, team string, pay int").repartition(3)
    q = spark.createDataFrame([(7,), (12,), (9,), (50,), (None,)], "v int")
    got = {r["v"]: r for r in L.exact_lookup(q, "v", staff, "badge", ["team", "pay"], pos="line").collect()}
    assert (got[7]["team"], got[7]["pay"]) == ("Kitchen", 31000)          # the first match by line
    assert got[12]["pay"] == 36700 and got[9]["team"] is None and got[50]["pay"] is None and got[None]["pay"] is None
    last = {r["v"]: r["x_who"] for r in L.exact_lookup(q, "v", staff.withColumn("line", -F.col("line")), "badge", ["who"], "line", "x_").collect()}
    assert last[7] == "Ines M."
    got = {r["v"]: r["r"] for r in L.xlookup(q, "v", staff, "badge", "team", "r", pos="line").collect()}
    assert got == {7: "Kitchen", 12: "Kitchen", 9: None, 50: "Not found", None: "Not found"}
    bands = spark.createDataFrame([(0, "a"), (250, "b"), (250, "late b"), (1000, "c"), (None, "none")], "lo int, band string").withColumn("line", F.monotonically_increasing_id())
    amounts = spark.createDataFrame([(249,), (250,), (-5,), (10**6,), (None,), (999,)], "amount int")
    got = {r["amount"]: r["band"] for r in L.bracket_lookup(amounts, "amount", bands, "lo", "band", "band", pos="line").collect()}
    assert got == {249: "a", 250: "b", -5: None, 10**6: "c", None: None, 999: "b"}


def test_first_match_and_mapping(spark):
    t = spark.createDataFrame([(2, "k", "second"), (1, "k", "first"), (3, "j", "only")], "pos int, key string, v string")
    got = {r["key"]: r["v"] for r in L.first_match(t, "key", "pos").collect()}
    assert got == {"k": "first", "j": "only"}
    m = {"electronics": "Electronics", "electornics": "Electronics", "home & garden": "Home & Garden"}
    got = col_values(spark, [" Electronics ", "Electornics", "ELECTRONICS", "garden tools", None],
                     lambda c: L.map_with_fallback(c, m))
    assert got == ["Electronics", "Electronics", "Electronics", "Garden Tools", None]


# (day, zone, item, seller, units, takings): own rows; one zone is blank
TILL = [(d(2023, 5, 2), "Harbour", "Lamp", "Noor", 4, 200), (d(2023, 5, 9), "Harbour", "Rug", "Noor", 1, 340), (d(2023, 5, 31), "Hill", "Lamp", "Piet", 10, 500),
        (d(2023, 6, 1), "Hill", "Rug", "Piet", 2, 610), (d(2023, 6, 15), None, "Lamp", "Noor", 6, 300), (d(2023, 6, 30), "Harbour", "Lamp", "Sato", 12, 560)]


def test_criteria_cells(spark):
    df = spark.createDataFrame(TILL, "day date, zone string, item string, seller string, units int, takings int")
    r = C.criteria_cells(df, {
        "harbour": ("sum", "takings", {"zone": "Harbour"}),
        "harbour_lamp": ("sum", "takings", {"zone": "=Harbour", "item": "Lamp"}),
        "noor": ("count", {"seller": "Noor"}),
        "six_up": ("count", {"units": ">=6", "item": "Lamp"}),
        "hill_avg": ("avg", "takings", {"zone": "Hill"}),
        "may": ("sum", "takings", {"day": (d(2023, 5, 1), d(2023, 5, 31))}),
        "valley_sum": ("sum", "takings", {"zone": "Valley"}), "valley_n": ("count", {"zone": "Valley"}), "valley_avg": ("avg", "takings", {"zone": "Valley"}),
        "not_hill": ("count", {"zone": "<>Hill"}), "other_case": ("count", {"zone": "harbour"}),
        "weighted": ("avg", "takings", {"item": "Rug"}, "units", 2)}).first()
    assert (r.harbour, r.harbour_lamp, r.noor, r.six_up, r.hill_avg, r.may) == (1100, 760, 3, 3, 555.0, 1040)
    assert (r.valley_sum, r.valley_n, r.valley_avg, r.other_case) == (0, 0, None, 0)
    assert r.not_hill == 4                      # the blank cell counts, as in a spreadsheet
    assert r.weighted == 316.67                 # 950 over 3 units
    r = C.criteria_cells(df, {"eq": ("count", {"zone": "=harbour"}), "plain": ("count", {"zone": "hARBOUR"}), "ne": ("count", {"zone": "<>harbour"})}, ignore_case=True).first()
    assert (r.eq, r.plain, r.ne) == (3, 3, 3)


def test_kpis(spark):
    df = spark.createDataFrame(TILL, "day date, zone string, item string, seller string, units int, takings int")
    r = C.kpis(df, "takings", "zone", None, 2, F.sum("units").alias("units")).first()
    assert (r.total, r.average, r.counta, r.units) == (2510, 418.33, 5, 35)


def test_bracket_lookup_keeps_types_and_hot_values(spark):
    big = 9007199254740992                                   # not exact as a double from here on
    b = spark.createDataFrame([(0, "a", 1), (big + 1, "b", 2)], "lo long, band string, line int")
    df = spark.createDataFrame([(i, big + i % 3) for i in range(300)], "id int, v long")
    got = {(r.v - big, r.band) for r in L.bracket_lookup(df, "v", b, "lo", "band", "band", pos="line").collect()}
    assert got == {(0, "a"), (1, "b"), (2, "b")}
    plan = L.bracket_lookup(df, "v", b, "lo", "band", "band", pos="line")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_more_scalars(spark):
    from bizlens.functions import numeric as N
    t0 = F.lit(dt.datetime(2025, 1, 1, 0, 0)).cast("timestamp")
    t1 = F.lit(dt.datetime(2025, 1, 2, 13, 30)).cast("timestamp")
    assert one(spark, D.hours_between(t0, t1)) == 37.5
    assert one(spark, D.months_since(F.lit(d(2025, 1, 1)), F.lit(d(2026, 3, 1)))) == 14
    assert one(spark, D.month_between(F.lit(d(2025, 1, 31)), 2025, 1)) is True
    assert one(spark, D.month_between(F.lit(d(2025, 2, 1)), 2025, 1)) is False
    assert one(spark, D.month_start(F.lit(dt.datetime(2025, 3, 17, 8, 0)))) == d(2025, 3, 1)
    assert one(spark, X.money_text(F.lit(1234.5))) == "$1,234.50"
    assert one(spark, X.percent_text(F.lit(0.1234))) == "12.3%"
    assert one(spark, X.status_label(F.lit(-1))) == "Over Budget"
    assert one(spark, N.safe_ratio(F.lit(5), F.lit(0))) == 0
    assert one(spark, N.safe_ratio(F.lit(5), F.lit(2))) == 2.5
    assert one(spark, N.round_half_even(F.lit(2.5))) == 2.0
    assert one(spark, N.zero_guard(F.lit(0), F.lit(3.0), 0.5)) == 0.5
