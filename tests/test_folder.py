"""A3/F5/D22/D23/L24 on a hand-made folder (FIXTURES §6)."""

import os
import tempfile

from bizlens.sources import folder as FO


def make_folder():
    d = tempfile.mkdtemp(prefix="bizlens-folder-")
    seven = ["1", "2", "3", "4", "5", "6", "7", "x", "y", "z", "100"]      # 7 of first 10 numeric
    six = ["1", "2", "3", "4", "5", "6", "a", "b", "c", "d", "100"]         # 6 of first 10 numeric
    with open(os.path.join(d, "sales.csv"), "w") as f:
        f.write("id,seven,six,name\n")
        for i in range(11):
            f.write(f"{i + 1},{seven[i]},{six[i]},\"n, {i}\"\n")
    with open(os.path.join(d, "UPPER.CSV"), "w") as f:
        f.write('a,b\n"$1,234",7\n2,8\n')
    open(os.path.join(d, "empty.csv"), "w").close()
    with open(os.path.join(d, "header_only.csv"), "w") as f:
        f.write("x,y,z\n")
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write("ignored\n")
    return d


def test_profile_folder(spark):
    d = make_folder()
    files, cols = FO.profile_folder(spark, d)
    fr = {r["file_name"]: r for r in files.collect()}
    assert set(fr) == {"sales.csv", "UPPER.CSV", "empty.csv", "header_only.csv"}
    s = fr["sales.csv"]
    assert (s.row_count, s.data_row_count, s.column_count, s.numeric_column_count, s.status) == (12, 11, 4, 2, "OK")
    assert fr["empty.csv"].status == "Empty" and fr["empty.csv"].row_count == 0
    assert fr["header_only.csv"].column_count == 3 and fr["header_only.csv"].numeric_column_count == 0
    assert fr["UPPER.CSV"].numeric_column_count == 2
    assert fr["sales.csv"].sheet_name.endswith("_sales") and fr["sales.csv"].size_text.endswith("bytes")
    cr = {(r["file_name"], r["col_name"]): r for r in cols.collect()}
    assert set(k for k in cr if k[0] == "sales.csv") == {("sales.csv", "id"), ("sales.csv", "seven")}
    seven = cr[("sales.csv", "seven")]
    assert (seven["min"], seven["max"], seven["avg"]) == (1.0, 100.0, 128 / 8)
    up = cr[("UPPER.CSV", "a")]
    assert (up["min"], up["max"]) == (2.0, 1234.0)
    total = FO.with_total(files).where("file_name = 'TOTAL'").first()
    assert total.row_count == 12 + 3 + 0 + 1


def test_preview(spark):
    d = make_folder()
    p = FO.preview(spark, d).where("file_name = 'sales.csv'").orderBy("row_no").collect()
    assert [r.row_no for r in p] == [1, 2, 3, 4, 5]
    assert p[0].cells == ["1", "1", "1", "n, 0"]


def test_quoted_cells_in_linear_time(spark):
    from pyspark.sql import functions as F
    lines = [("a,b", ["a", "b"]), ('"x, ""y""",z', ['x, "y"', "z"]), ('""', [""]), ("", [""]), (",", ["", ""]), ('"a,b', ["a,b"]), (" p , q ", ["p", "q"]),
             (",".join(f'"c,{i}"' for i in range(20_000)), [f"c,{i}" for i in range(20_000)])]
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(lines)], "i int, line string")
    for r in df.select("i", FO.cells(F.col("line")).alias("c")).collect():
        assert r.c == lines[r.i][1]
