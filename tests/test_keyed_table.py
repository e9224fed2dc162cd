"""Keyed table and replaceable tables: whole versions, replays, lookups, trimming."""

import os

import pytest
from pyspark.sql import functions as F

from hourprofile.sinks import keyed
from hourprofile.sinks.keyed import KeyedTable, current, manifest, publish, versions

SCHEMA = "sid string, date string, lanes int, current int, level string"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def content(df):
    return sorted(map(tuple, df.select("sid", "date", "lanes", "current", "level").collect()))


def test_first_row_wins_all_but_current(spark, tmp):
    t = KeyedTable(spark, tmp + "/t")
    with pytest.raises(FileNotFoundError):
        t.read()
    t.upsert(rows(spark, [("a", "02", 1, 5, "High"), ("a", "01", 1, 7, "Low"), ("b", "03", 1, 1, None)]), 0)
    t.upsert(rows(spark, [("a", "03", 2, 9, "Medium"), ("c", "01", 1, None, "Low"), ("b", "01", 1, 4, "High")]), 1)
    want = [("a", "01", 1, 9, "Low"), ("b", "01", 1, 1, "High"), ("c", "01", 1, None, "Low")]
    assert content(t.read()) == want
    t.compact()
    assert content(t.read()) == want
    t.upsert(rows(spark, [("a", "03", 2, 9, "Medium"), ("c", "01", 1, None, "Low"), ("b", "01", 1, 4, "High")]), 1)  # replayed
    assert content(t.read()) == want


def test_crash_between_folders_shows_the_version_before(spark, tmp, monkeypatch):
    t = KeyedTable(spark, tmp + "/t")
    t.upsert(rows(spark, [("a", "01", 1, 5, "High")]), 0, {"rejected": rows(spark, [("x", "01", 1, 0, "bad")])})
    before = versions(spark, t.root)

    def broken():
        raise OSError("executor and driver lost")

    with pytest.raises(OSError):
        t.upsert(rows(spark, [("a", "02", 1, 6, "Low"), ("b", "02", 1, 1, "Low")]), 1, {"rejected": rows(spark, [("y", "02", 1, 0, "bad")])}, after=broken)
    assert versions(spark, t.root) == before
    assert content(t.read()) == [("a", "01", 1, 5, "High")] and t.beside("rejected").count() == 1
    t.upsert(rows(spark, [("a", "02", 1, 6, "Low"), ("b", "02", 1, 1, "Low")]), 1, {"rejected": rows(spark, [("y", "02", 1, 0, "bad")])})
    assert content(t.read()) == [("a", "01", 1, 6, "High"), ("b", "02", 1, 1, "Low")]
    assert sorted((r.sid, r.epoch) for r in t.beside("rejected").collect()) == [("x", 0), ("y", 1)]


def test_second_writer_of_a_version_fails(spark, tmp):
    root = tmp + "/t"
    state = manifest(spark, root)
    keyed.commit(spark, root, state)
    with pytest.raises(RuntimeError, match="another writer"):
        keyed.commit(spark, root, state)
    assert versions(spark, root) == [1]


def test_lookup_reads_the_files_that_may_hold_the_key(spark, tmp):
    t = KeyedTable(spark, tmp + "/t", files=8)
    many = spark.range(4000).select(F.format_string("s%05d", "id").alias("sid"), F.lit("01").alias("date"), F.lit(1).alias("lanes"),
                                    F.col("id").cast("int").alias("current"), F.lit("Low").alias("level"))
    t.upsert(many, 0)
    t.compact()
    assert len(t.read().inputFiles()) == 8
    one = t.lookup(["s01234"])
    assert len(one.inputFiles()) == 1 and content(one) == [("s01234", "01", 1, 1234, "Low")]
    assert len(t.lookup(["s00000", "s03999"]).inputFiles()) == 2
    assert t.lookup(["nothing"]).count() == 0
    t.upsert(rows(spark, [("s01234", "02", 1, 7, "High")]), 1)  # not compacted yet: its files are read too
    assert content(t.lookup(["s01234"])) == [("s01234", "01", 1, 7, "Low")]
    plan = t.lookup(["s01234"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "s01234" in plan


def test_old_folders_go_and_kept_versions_stay_readable(spark, tmp):
    t = KeyedTable(spark, tmp + "/t", files=2, keep_versions=2)
    for epoch in range(6):
        t.upsert(rows(spark, [("a", f"{epoch:02d}", 1, epoch, "Low")]), epoch)
        if epoch % 2:
            t.compact()
    found = versions(spark, t.root)
    assert len(found) == 2
    for v in found:
        assert content(t.read(v)) == [("a", "00", 1, 5, "Low")]
    named = {f.rsplit("/", 1)[-1] for v in found for f in keyed._folders(manifest(spark, t.root, v))}
    assert set(os.listdir(t.root)) - {keyed.MANIFESTS} == named


def test_published_versions(spark, tmp):
    root = tmp + "/p"
    publish(spark.range(3), root)
    first = current(spark, root)  # a running reader
    publish(spark.range(5), root)
    assert first.count() == 3 and current(spark, root).count() == 5 and current(spark, root, 1).count() == 3
    spark.range(2).write.parquet(tmp + "/plain")
    assert current(spark, tmp + "/plain").count() == 2
