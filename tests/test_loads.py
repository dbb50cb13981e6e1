"""Loads that are repeated, newest loads by manifest, pulls that break off, bucketed joins."""

import os

import pytest
from pyspark.sql import functions as F

from curvemill.plans import jobs
from curvemill.sources import loads, sinks
from curvemill.sources.pulls import pull_new_files
from tests.conftest import as_tuples


def test_a_load_written_again_replaces_itself_only(spark, rows, tmp_path):
    target = str(tmp_path / "t")
    one, two = rows([(1, "a", 5), (2, "b", 5)], "v int, k string, s int"), rows(
        [(3, "a", 6)], "v int, k string, s int")
    assert loads.write_load(one, target, "one", "s", ["k"]) == 2
    assert loads.write_load(two, target, "two", "s", ["k"]) == 1
    assert loads.write_load(one.where("v = 2"), target, "one", "s", ["k"]) == 1
    assert loads.write_load(one.where("v = 2"), target, "one", "s", ["k"]) == 1
    assert as_tuples(loads.read_loads(spark, target).select("v", "load_id")) == [(2, "one"), (3, "two")]
    assert as_tuples(loads.manifest(spark, target).select("k", "newest_stamp", "load_rows", "load_id")) \
        == [("a", 6, 1, "two"), ("b", 5, 1, "one")]
    assert loads.write_load(one.where("false"), target, "one", "s", ["k"]) == 0
    assert as_tuples(loads.manifest(spark, target).select("load_id")) == [("two",)]
    for bad in ("", "7", "a/b", "a=b", "../x"):
        with pytest.raises(ValueError, match="A load is named"):
            loads.write_load(one, target, bad, "s")


def test_newest_load_opens_its_own_files(spark, rows, tmp_path):
    target = str(tmp_path / "t")
    for i in range(6):
        data = [(i * 10 + j, "a" if i != 5 else "b", None if j == 2 else i // 2) for j in range(3)]
        loads.write_load(rows(data, "v int, k string, s int"), target, f"l{i}", "s", ["k"])
    newest = loads.read_newest(spark, target, "k = 'a'", "s")
    assert as_tuples(newest.select("v")) == [(40,), (41,)]
    files = newest.inputFiles()
    assert files and all("load_id=l4/" in f or "_loads" in f for f in files)
    assert as_tuples(loads.read_newest(spark, target, stamp="s").select("v")) == [(40,), (41,), (50,), (51,)]
    nothing = loads.read_newest(spark, target, "k = 'z'", "s")
    assert nothing.count() == 0 and "v" in nothing.columns


def test_a_load_without_manifest_entry_is_not_the_newest(spark, rows, tmp_path, monkeypatch):
    target, frame = str(tmp_path / "t"), rows([(1, 1)], "v int, s int")
    loads.write_load(frame, target, "old", "s")
    replace = loads._replace

    def broken(df, folder, load):
        if folder.endswith(loads.MANIFEST):
            raise RuntimeError("lost")
        replace(df, folder, load)

    monkeypatch.setattr(loads, "_replace", broken)
    newer = rows([(2, 9)], "v int, s int")
    with pytest.raises(RuntimeError):
        loads.write_load(newer, target, "new", "s")
    assert loads.read_newest(spark, target, stamp="s").first().v == 1
    monkeypatch.undo()
    loads.write_load(newer, target, "new", "s")
    assert as_tuples(loads.read_newest(spark, target, stamp="s").select("v")) == [(2,)]


def test_late_rows_come_once_and_broken_pulls_add_nothing_twice(spark, rows, tmp_path):
    source, target, log = (str(tmp_path / n) for n in ("source", "target", "log"))

    def arrive(*values):
        rows([(v, 7) for v in values], "v int, stamp int").coalesce(1).write.mode("append").parquet(source)

    def pulled():
        return sorted(r.v for r in spark.read.parquet(target).collect())

    arrive(1, 2)
    assert pull_new_files(spark, source, target, log) == 2
    arrive(3)                                    # later, under the newest stamp
    os.utime(next(p for p in (tmp_path / "source").glob("*.parquet")), (0, 0))
    assert pull_new_files(spark, source, target, log) == 1 and pulled() == [1, 2, 3]
    assert pull_new_files(spark, source, target, log) == 0 and pulled() == [1, 2, 3]
    arrive(4)
    pull_new_files(spark, source, target, log)
    for lost in ((tmp_path / "log/commits/2",), (  # killed after, and before, the sink's commit
            tmp_path / "log/commits/2", tmp_path / "target/_spark_metadata/2")):
        for path in lost:
            path.unlink()
            crc = path.with_name(f".{path.name}.crc")
            crc.exists() and crc.unlink()
        pull_new_files(spark, source, target, log)
        assert pulled() == [1, 2, 3, 4]
    assert len(list((tmp_path / "target").glob("*.parquet"))) > 3      # the lost copy is there, unread
    arrive(5)
    pull_new_files(spark, source, target, log, shape=lambda df: df.withColumn("v", F.col("v") * 1))
    assert pulled() == [1, 2, 3, 4, 5]


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    left = spark.range(1000).selectExpr("id % 97 as a", "string(id) as b", "id as x")
    right = spark.range(500).selectExpr("id % 97 as a", "string(id) as b", "id as y")
    for name, df in (("bucket_left", left), ("bucket_right", right)):
        sinks.write_bucketed(df, name, ["a", "b"], 4, str(tmp_path / name))
        sinks.write_bucketed(df, name, ["a", "b"], 4, str(tmp_path / name))
        assert len(list((tmp_path / name).glob("*.parquet"))) == 4
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(old, ("-1", "false")):
            spark.conf.set(k, v)
        joined = spark.read.table("bucket_left").join(spark.read.table("bucket_right"), ["a", "b"])
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.where("x = y").count() == 500
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        for name in ("bucket_left", "bucket_right"):
            spark.sql(f"drop table {name}")


def test_a_repeated_job_replaces_its_results(spark, rows, tmp_path):
    target = str(tmp_path / "losses")
    for day, load in ((1, "monday"), (2, "tuesday"), (2, "tuesday")):
        now = F.lit(f"2026-05-1{day} 12:00:00").cast("timestamp")
        write = jobs.table_writer({"losses": target}, sinks.STRESS, now, "UTC", load=load)
        write(rows([(day, 1.0)], "v int, loss double"), "losses")
    assert as_tuples(loads.read_loads(spark, target).select("v", "load_id")) == [(1, "monday"), (2, "tuesday")]
    assert as_tuples(loads.read_newest(spark, target).select("v")) == [(2,)]
