"""Refreshes that fail half-way, and lines that do not parse."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shoplake.sources import commits, snapshot


def _people(spark, *names):
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "user_id bigint, user_name string")


def _names(spark, root):
    df = snapshot.read_snapshot(spark, root, "dim_user", "2026-01-01", _people(spark).schema)
    return sorted(r.user_name for r in df.collect())


@pytest.mark.parametrize("fails", ["in a task", "before the commit"])
def test_a_failed_refresh_leaves_the_old_snapshot(spark, monkeypatch, fails):
    root = tempfile.mkdtemp(prefix="shoplake-commit-")
    snapshot.write_snapshot(_people(spark, "a", "b"), root, "dim_user", "2026-01-01")
    assert _names(spark, root) == ["a", "b"]
    with monkeypatch.context() as m, pytest.raises(Exception):
        if fails == "before the commit":
            m.setattr(commits, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
            snapshot.write_snapshot(_people(spark, "c"), root, "dim_user", "2026-01-01")
        else:
            snapshot.write_snapshot(_people(spark, "c").withColumn("user_name", F.raise_error(F.lit("lost"))), root, "dim_user", "2026-01-01")
    assert _names(spark, root) == ["a", "b"] and snapshot.snapshot_exists(spark, root, "dim_user", "2026-01-01")
    begun = snapshot.read_snapshot(spark, root, "dim_user", "2026-01-01", _people(spark).schema)
    snapshot.write_snapshot(_people(spark, "d", "e", "f"), root, "dim_user", "2026-01-01")
    assert _names(spark, root) == ["d", "e", "f"]
    assert sorted(r.user_name for r in begun.collect()) == ["a", "b"]           # a reader that has begun keeps its files
    path = snapshot.snapshot_path(root, "dim_user", "2026-01-01")
    assert commits.prune(spark, path, keep=1) >= 1 and commits.prune(spark, path, keep=1) == 0
    assert _names(spark, root) == ["d", "e", "f"] and len(os.listdir(path + ".versions")) == 1


def test_paths_without_a_manifest_are_read_as_they_are(spark):
    root = tempfile.mkdtemp(prefix="shoplake-commit-")
    assert not commits.published(spark, f"{root}/x") and commits.resolve(spark, f"{root}/x") == f"{root}/x"
    assert commits.prune(spark, f"{root}/x") == 0


def test_lines_that_do_not_parse_are_kept_apart(spark):
    root = tempfile.mkdtemp(prefix="shoplake-lines-")
    path = snapshot.snapshot_path(root, "t", "d")
    os.makedirs(path)
    lines = ["1\tann\t2.5", "2\t\\N\t\\N", "x\tbob\t1", "3\tcid", "4\tdan\t1\tmore", "5\teve\tlots", "6\t\t7", "\\N\tfay\t0", ""]
    with open(f"{path}/part-0", "w") as f:
        f.write("\n".join(lines) + "\n")
    schema = spark.createDataFrame([], "id bigint, name string, v double").schema
    good, bad = snapshot.read_snapshot_checked(spark, root, "t", "d", schema)
    assert sorted((str(tuple(r)) for r in good.collect())) == sorted(map(str, [
        (1, "ann", 2.5), (2, None, None), (6, None, 7.0), (None, "fay", 0.0)]))
    assert sorted(r.line for r in bad.collect()) == sorted(lines[i] for i in (2, 3, 4, 5, 8))
    assert good.select("name").count() == 4 and good.count() + bad.count() == len(lines)
    assert all(r.file.endswith("part-0") and r.block == 0 for r in bad.collect())
