"""Repeated and broken jobs leave the datasets as one run would."""

import os

import pytest
from pyspark.sql import functions as F

from ordertide.sources import publish as P


def ids(df):
    return sorted(r.id for r in df.collect())


def test_publish_swaps_and_repeats_nothing(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "data")
    assert P.publish(spark.range(5), path, "job-1") == 5
    assert ids(P.read_published(spark, path)) == [0, 1, 2, 3, 4]
    before = P.read_published(spark, path)
    assert P.publish(spark.range(10, 13), path, "job-2") == 3
    assert ids(P.read_published(spark, path)) == [10, 11, 12]
    assert ids(before) == [0, 1, 2, 3, 4]                              # a reader of the old rows isn't cut off
    assert P.publish(spark.range(99), path, "job-1") == 5              # the second run of one job: no rows, no way back
    assert ids(P.read_published(spark, path)) == [10, 11, 12]
    assert len(os.listdir(path)) == 3 + sum(f.startswith(".") for f in os.listdir(path))


def test_a_crash_before_the_swap_is_mended_by_the_next_run(spark, tmpdir_path, monkeypatch):
    path = os.path.join(tmpdir_path, "data")
    P.publish(spark.range(2), path, "a")

    def crash(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(P, "_swap", crash)
        with pytest.raises(RuntimeError):
            P.publish(spark.range(7), path, "b")
    assert ids(P.read_published(spark, path)) == [0, 1]
    assert P.publish(spark.range(7), path, "b") == 7
    assert len(ids(P.read_published(spark, path))) == 7


def test_a_half_written_version_is_written_anew(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "data")
    spark.range(50).write.parquet(f"{path}/version-x")
    os.unlink(f"{path}/version-x/_SUCCESS")
    assert P.publish(spark.range(3), path, "x") == 3 and ids(P.read_published(spark, path)) == [0, 1, 2]


def test_registry_appends_once(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "registry")
    row = lambda i: spark.range(i, i + 1)
    assert P.append_once(row(1), path, "run-1") and P.append_once(row(2), path, "run-2")
    assert not P.append_once(row(9), path, "run-1")
    assert ids(P.read_registry(spark, path)) == [1, 2]
    row(3).write.parquet(f"{path}/job_id=run-3")
    os.unlink(f"{path}/job_id=run-3/_SUCCESS")                          # a job that broke off isn't read ...
    assert ids(P.read_registry(spark, path)) == [1, 2]
    assert P.append_once(row(4), path, "run-3")                         # ... and is replaced by its next run
    assert {(r.id, r.job_id) for r in P.read_registry(spark, path).collect()} == {(1, "run-1"), (2, "run-2"), (4, "run-3")}


def test_partitions_and_keys(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "parts")
    P.publish(spark.range(6).withColumn("d", F.col("id") % 2), path, "p", partition_by=["d"])
    assert P.read_published(spark, path).filter("d = 1").count() == 3
    for bad in ("", "../x", "a/b"):
        with pytest.raises(ValueError):
            P.append_once(spark.range(1), path, bad)
