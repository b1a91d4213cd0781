"""Scratch spaces: what is written inside goes at the end, results stay."""

import os
import threading

import pytest

from bizlens.sources import folder as FO
from bizlens.sources import scratch as SC


def _local(path):
    return path.removeprefix("file:")


def _files(folder):
    return [f for _, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]


def test_a_space_goes_with_all_that_was_written_inside(spark):
    with SC.scratch_space(spark) as path:
        inner = SC.materialize(spark.range(100), "numbers")
        assert inner.count() == 100 and _files(_local(path))
        assert SC.shared_path(spark, "x").startswith(path)
    assert not os.path.exists(_local(path))
    assert not SC.shared_path(spark, "x").startswith(path)
    assert not [d for d in spark.catalog.listDatabases() if d.name.startswith("bizlens_space_")]


def test_a_space_goes_after_an_error(spark):
    with pytest.raises(ValueError), SC.scratch_space(spark) as path:
        SC.materialize(spark.range(5), "numbers")
        raise ValueError
    assert not os.path.exists(_local(path)) and not SC.shared_path(spark, "x").startswith(path)


def test_spaces_nest_and_results_are_kept_apart(spark):
    with SC.scratch_space(spark) as outer:
        written = []

        def make():
            step = SC.materialize(spark.range(50).selectExpr("id", "id % 7 AS k"), "step")
            written.append(step.inputFiles()[0])
            return step.groupBy("k").count()

        kept = SC.materialize_apart(spark, "kept", make)
        assert not os.path.exists(_local(written[0].replace("file:///", "/")))
        assert sorted(map(tuple, kept.collect())) == [(k, 50 // 7 + (k < 50 % 7)) for k in range(7)]
        assert _files(_local(outer))
    assert not os.path.exists(_local(outer))


def test_an_empty_space_and_another_thread(spark):
    with SC.scratch_space(spark) as path:
        seen = []
        t = threading.Thread(target=lambda: seen.append(SC.shared_path(spark, "x")))
        t.start()
        t.join()
        assert not seen[0].startswith(path)  # a space belongs to its thread
    assert not os.path.exists(_local(path))


def test_a_folder_profile_leaves_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n3,4\n")
    with SC.scratch_space(spark) as path:
        files, cols = (df.collect() for df in FO.profile_folder(spark, str(tmp_path)))
    assert [(f.file_name, f.row_count) for f in files] == [("a.csv", 3)] and len(cols) == 2
    assert not os.path.exists(_local(path))
