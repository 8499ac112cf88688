"""Create-or-replace by versions: readers and writers beside each other."""

import threading

import pytest
from pyspark.sql import functions as F

from tessera.sources import stage, versions


def test_replace_and_pinned_readers(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(LookupError):
        versions.read(spark, root)
    assert versions.current(spark, root) is None
    one = versions.create_or_replace(spark.range(10), root)
    before = versions.read(spark, root)
    two = versions.create_or_replace(versions.read(spark, root).select((F.col("id") * 2).alias("id"), F.lit("x").alias("s")), root)  # reads itself
    assert (one.number, two.number) == (1, 2) and two.info == {"rows": 10, "columns": ["id", "s"]}
    assert before.count() == 10 and before.columns == ["id"]
    assert versions.read(spark, root).agg(F.sum("id")).first()[0] == 90
    assert versions.read(spark, root, 1).agg(F.sum("id")).first()[0] == 45
    assert versions.remove_old(spark, root, keep=1) == [1]
    assert versions.current(spark, root) == two
    with pytest.raises(LookupError):
        versions.read(spark, root, 1)


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.create_or_replace(spark.range(10), root)
    with pytest.raises(Exception, match="stop"):
        versions.create_or_replace(spark.range(1000).select(F.when(F.col("id") == 999, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")).alias("id")), root)
    assert versions.current(spark, root).number == 1 and versions.read(spark, root).count() == 10


def test_readers_during_replaces_see_whole_versions(spark, tmp_path):
    """Each version holds one value in all its rows; writers race for the numbers."""
    root = str(tmp_path / "t")
    versions.create_or_replace(spark.range(300).select(F.lit(0).alias("v")), root)
    seen, faults = [], []

    def write(k):
        try:
            versions.create_or_replace(spark.range(300, numPartitions=3).select(F.lit(k).alias("v")), root)
        except Exception as exc:  # noqa: BLE001
            faults.append(exc)

    def read():
        for _ in range(6):
            try:
                seen.append(tuple(versions.read(spark, root).agg(F.count("v"), F.min("v"), F.max("v")).first()))
            except Exception as exc:  # noqa: BLE001
                faults.append(exc)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(1, 7)] + [threading.Thread(target=read) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not faults
    assert all(n == 300 and lo == hi for n, lo, hi in seen)
    assert versions.current(spark, root).number == 7
    assert {versions.read(spark, root, i).first()["v"] for i in range(1, 8)} == set(range(7))  # none was lost or mixed


def test_a_taken_number_is_refused(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.create_or_replace(spark.range(3), root)
    folder = versions._Folder(spark, root)
    assert not folder.add(1, {"data": "other", "info": {}}) and folder.add(2, {"data": "other", "info": {}})
    assert folder.read(1)["data"] != "other" and len(folder.fs.listStatus(folder.pointers)) == 2  # no drafts left


def test_first_only(spark, tmp_path):
    root = str(tmp_path / "t")
    a, b = versions.new_path(root), versions.new_path(root)
    assert versions.publish(spark, root, a, {"n": 1}, first_only=True).path == a
    assert versions.publish(spark, root, b, {"n": 2}, first_only=True).path == a and versions.current(spark, root).info == {"n": 1}


def test_by_name(spark, tmp_path):
    root, name = str(tmp_path / "t"), "tessera_versions_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    versions.create_or_replace(spark.range(4), root, name)
    assert spark.table(name).count() == 4
    versions.create_or_replace(spark.range(9), root, name)
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 9
    versions.create_or_replace(spark.range(2).select(F.lit("a").alias("s")), root, name)
    assert [r["s"] for r in spark.table(name).collect()] == ["a", "a"]
    spark.sql(f"DROP TABLE {name}")
    assert versions.read(spark, root, 2).count() == 9


def test_a_known_stage_runs_no_job(spark, sf_small):
    stage.stage(spark, sf_small)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("stage", "again")
    try:
        for _ in range(3):
            stage.stage(spark, sf_small)
            stage.table_rows(spark, sf_small, "observations")
        assert not tracker.getJobIdsForGroup("stage")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    first = stage.stage(spark, sf_small)
    assert stage.refresh(spark, sf_small) == first
    assert all(spark.read.parquet(first.path(t)).count() == n for t, n in first.counts.items())
