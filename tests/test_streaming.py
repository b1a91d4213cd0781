"""The streaming daily revenue equals the batch form on the same events."""

import os
import tempfile

from pyspark.sql import functions as F

from bizlens.streaming import daily_purchase_revenue, daily_purchase_revenue_stream, run_available_now

from conftest import SF001


def test_stream_matches_batch(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    root = tempfile.mkdtemp(prefix="bizlens-stream-")
    src = os.path.join(root, "src")
    # Land the events as several files, in time order, as a feed would.
    events.withColumn("_b", F.ntile(4).over(__import__("pyspark.sql").sql.Window.orderBy("ts"))) \
          .write.partitionBy("_b").parquet(os.path.join(root, "staged"))
    for b in range(1, 5):
        spark.read.parquet(os.path.join(root, "staged", f"_b={b}")).write.mode("append").parquet(src)
    stream = daily_purchase_revenue_stream(spark, src, lateness="1 day", max_files_per_trigger=1)
    run_available_now(stream, os.path.join(root, "out"), os.path.join(root, "ckpt"))
    got = {(r.day, r.revenue, r.purchases) for r in spark.read.parquet(os.path.join(root, "out")).collect()}
    exp = {(r.day, r.revenue, r.purchases) for r in daily_purchase_revenue(events).collect()}
    # append mode emits a day once the watermark has passed it: all but the last day(s)
    assert got and got <= exp
    last_day = max(d for d, _, _ in exp)
    assert {e for e in exp if e[0] < last_day - __import__("datetime").timedelta(days=1)} <= got


def test_folder_profile_stream(spark):
    import shutil
    from test_folder import make_folder
    from bizlens.sources import folder as FO
    from bizlens.streaming import folder_profile_stream
    src = make_folder()
    root = tempfile.mkdtemp(prefix="bizlens-fstream-")
    land = os.path.join(root, "land")
    os.makedirs(land)
    # files arrive one after another
    for name in ("sales.csv", "UPPER.CSV", "header_only.csv"):
        shutil.copy(os.path.join(src, name), os.path.join(land, name))
    folder_profile_stream(spark, land, os.path.join(root, "out"), os.path.join(root, "ckpt"), max_files_per_trigger=1)
    got = {r.file_name: (r.row_count, r.column_count, r.numeric_column_count)
           for r in spark.read.parquet(os.path.join(root, "out", "files")).collect()}
    exp_files, _ = FO.profile_folder(spark, land)
    exp = {r.file_name: (r.row_count, r.column_count, r.numeric_column_count) for r in exp_files.collect()}
    assert got == exp
    cols = {(r.file_name, r.col_name) for r in spark.read.parquet(os.path.join(root, "out", "columns")).collect()}
    assert ("sales.csv", "seven") in cols and ("UPPER.CSV", "a") in cols


def test_folder_profile_stream_runs_a_batch_again(spark):
    from test_folder import make_folder
    from bizlens.streaming import folder_profile_stream
    land, root = make_folder(), tempfile.mkdtemp(prefix="bizlens-fstream2-")
    out = os.path.join(root, "out")
    folder_profile_stream(spark, land, out, os.path.join(root, "ckpt"))
    once = spark.read.parquet(os.path.join(out, "files")).count()
    folder_profile_stream(spark, land, out, os.path.join(root, "ckpt2"))   # as after a failure before the commit
    assert spark.read.parquet(os.path.join(out, "files")).count() == once == 3
