"""Salted joins, messages of mixed shapes, observed metrics, versions under a running stream."""

import json
import struct
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourprofile import sinks
from hourprofile import sources as S
from hourprofile import streaming as ST
from hourprofile.functions import columns as C
from hourprofile.operators import messages as MS
from hourprofile.operators import profile as P
from hourprofile.operators import skew
from hourprofile.plans import queries as Q
from hourprofile.plans import testviews as tv
from hourprofile.sinks.keyed import KeyedTable, current, publish
from hourprofile.spec import TEST_OBS, TEST_RESULT_FIELDS

from conftest import SF_SMALL


@pytest.fixture
def crowded(spark):
    """80 % of 40,000 rows on one id."""
    obs = spark.range(40_000).select(F.when(F.col("id") % 5 > 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 997)).alias("id"), F.col("id").alias("n"))
    st = spark.sql("select concat('s', id) as id, 1 as lane from range(997) union all select 'hot', lane from values (1), (2) as t(lane)")
    return st, obs


def per_task(spark, df):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return sorted(r["count"] for r in df().groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_salted_join_spreads_a_crowded_key(spark, crowded):
    st, obs = crowded
    plain = per_task(spark, lambda: st.join(obs, "id"))
    even = per_task(spark, lambda: skew.salted_join(st, obs, "id"))
    assert sum(plain) == sum(even)
    assert max(plain) > 5 * plain[len(plain) // 2]
    assert max(even) <= 2 * even[len(even) // 2]


def test_salted_join_has_the_rows_of_the_join(spark, crowded):
    st, obs = crowded
    assert skew.salted_join(st, obs, "id").exceptAll(st.join(obs, "id")).count() == 0
    assert skew.hot_keys(obs, "id", 8).keys() == {"hot"}
    none = obs.limit(0)
    assert skew.hot_keys(none, "id", 8) == {} and skew.salted_join(st, none, "id").count() == 0
    nulls = obs.limit(10).withColumn("id", F.lit(None).cast("string"))
    assert skew.salted_join(st, nulls, "id").count() == 0


def test_salted_average_equals_the_others(spark):
    st = spark.createDataFrame([("hot", "l", 1.0, 2.0, lane, "t", "Y") for lane in (1, 1, 2)] + [("b", "m", 1.0, 2.0, 1, "t", "N")], list(P.PROFILE_KEYS))
    obs = spark.createDataFrame([("b" if n % 9 == 0 else "hot", *[n * h if n % 7 != h % 7 else None for h in range(24)]) for n in range(2000)],
                                "id string, " + ", ".join(f"{v} long" for v in P.VOLUME_COLUMNS))
    a, b = (P.hourly_average(st, obs, **how) for how in ({}, {"salted": True}))
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0 and a.count() == 3


# ---------------------------------------------------------------- messages
def test_mixed_messages(spark):
    schema = T._parse_datatype_string("a string, n int")
    cases = [('{"a":"x","n":"3"}', ("x", 3, False)), ('{"n":7}', (None, 7, False)), ("{}", (None, None, False)), ('["y","4"]', ("y", 4, False)),
             ('["\\"06\\"","\\"12\\""]', ("06", 12, False)), ('["y"]', (None, None, True)), ('["y","4","5"]', (None, None, True)), ('{"a":"x"', (None, None, True)),
             ("null", (None, None, True)), ("12", (None, None, True)), ('"text"', (None, None, True)), (None, (None, None, True)), ("", (None, None, True)),
             ('{"a":"x","n":"many"}', ("x", None, False)), ('{"a":"x","a":"y"}', (None, None, True)), ('{"a":null,"n":null}', (None, None, False))]
    df = spark.createDataFrame([(str(k), v) for k, (v, _) in enumerate(cases)], "key string, value string")
    got = {r.key: (r.a, r.n, r.corrupt) for r in MS.decode_mixed(df, schema).collect()}
    assert got == {str(k): want for k, (_, want) in enumerate(cases)}
    as_bytes = df.withColumn("value", F.col("value").cast("binary"))
    assert {r.key: (r.a, r.n, r.corrupt) for r in MS.decode_mixed(as_bytes, schema).collect()} == got


def test_mixed_topic_is_scored(spark, tmp):
    mapping, models, profile = Q._scoring_inputs(spark, SF_SMALL)
    msgs = S.stream_json_messages(spark, _folder(spark, Q.mixed_messages(spark, SF_SMALL), tmp + "/topic"))
    table = KeyedTable(spark, tmp + "/t")
    ST.score_stream(spark, msgs, TEST_OBS, TEST_RESULT_FIELDS, mapping, models, profile, table, tmp + "/ck", hour=8, shape="mixed").awaitTermination()
    kinds = {r.reason: r.n for r in table.beside("rejected").groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    stations = [int(r.station_id) % 5 for r in tv.observations(spark, SF_SMALL).select("station_id").collect()]
    assert kinds == {"corrupt": sum(s > 1 for s in stations)}
    counts = {r.kind: r.rows for r in table.beside("metrics").groupBy("kind").agg(F.sum("rows").alias("rows")).collect()}
    assert counts["ok"] == sum(s < 2 for s in stations) and counts["corrupt"] == kinds["corrupt"] and counts["scored"] > 0


def _folder(spark, msgs, path):
    msgs.write.json(path)
    return path


# ---------------------------------------------------------------- metrics, triggers, versions
def test_listener_sees_every_batch(spark, tmp):
    for k in range(3):
        spark.createDataFrame([(str(k), json.dumps({"k": k}))] * (k + 1), "key string, value string").coalesce(1).write.mode("append").json(tmp + "/topic")
    log = ST.ProgressLog()
    spark.streams.addListener(log)
    try:
        q = sinks.stream_files(sinks.with_metrics(S.stream_json_messages(spark, tmp + "/topic", max_files=1), "m"), tmp + "/out", tmp + "/ck")
        q.awaitTermination()
        assert sorted(v["rows"] for v in ST.await_progress(log, q, "m") if v["rows"]) == [1, 2, 3]
    finally:
        spark.streams.removeListener(log)


def test_profile_replaced_while_an_interval_stream_runs(spark, tmp):
    """``processingTime`` trigger: the version published in between scores what comes after."""
    mapping, models, profile = Q._scoring_inputs(spark, SF_SMALL)
    root, topic, out = tmp + "/profile", tmp + "/topic", tmp + "/out"
    publish(profile, root)
    msgs = Q._messages(spark, SF_SMALL)
    half = F.pmod(F.xxhash64("key"), F.lit(2))
    msgs.where(half == 0).coalesce(1).write.mode("append").json(topic)
    q = ST.score_stream(spark, S.stream_json_messages(spark, topic), TEST_OBS, TEST_RESULT_FIELDS, mapping, models, root, out, tmp + "/ck",
                        hour=8, trigger={"processingTime": "1 seconds"})
    try:
        _until(lambda: _rows(spark, out) > 0, q)
        first = _rows(spark, out)
        publish(profile.withColumn("avgvolume08", F.lit(-1.0)), root)
        msgs.where(half == 1).coalesce(1).write.mode("append").json(topic)
        _until(lambda: _rows(spark, out) > first, q)
    finally:
        q.stop()
    rows = spark.read.parquet(out)
    assert rows.where("historical = -1").count() == rows.count() - first > 0
    assert current(spark, root).where("avgvolume08 = -1").count() == profile.count()


def _rows(spark, path):
    try:
        return spark.read.parquet(path).count()
    except Exception as e:  # no epoch yet, or one being written
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return 0


def _until(done, query, seconds=120):
    end = time.monotonic() + seconds
    while not done():
        assert query.isActive and time.monotonic() < end, query.exception()
        time.sleep(0.5)


# ---------------------------------------------------------------- points
def test_binary_points(spark):
    pts = [(-104.5, 39.25), (0.0, -0.0), (None, 1.0), (1e-300, 1.7976931348623157e308)]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pts)], "k int, x double, y double")
    got = {r.k: r.w for r in df.select("k", C.point_wkb("x", "y").alias("w")).collect()}
    assert got == {k: None if x is None else bytearray(struct.pack("<BIIdd", 1, 0x20000001, 4326, x, y)) for k, (x, y) in enumerate(pts)}
