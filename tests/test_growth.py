"""What must not grow with the tables: memory of a task, broadcasts, generated methods, text on disk."""

import contextlib
import glob
import io
import os
import re

import pytest
from pyspark.sql import functions as F

from hourprofile import sinks
from hourprofile import sources as S
from hourprofile import streaming as ST
from hourprofile.operators import filters as FL
from hourprofile.operators import messages as MS
from hourprofile.operators import model as M
from hourprofile.operators import profile as P
from hourprofile.operators import score as SC
from hourprofile.plans import queries as Q
from hourprofile.spec import AVG_COLUMNS, TEST_OBS, TEST_RESULT_FIELDS, TEST_STATION

LARGEST_COMPILED = 8000  # bytes of a method that HotSpot still compiles


def _obs(spark, n=60):
    rows = spark.range(n)
    return rows.select(*[F.lit("2024-01-02").alias("date"), F.lit("02").alias("day_of_data"), F.lit("3").alias("day_of_week"), F.lit("N").alias("direction"),
                         F.lit("08").alias("state"), F.lit("R").alias("segment"), F.lit("01").alias("month_of_data"), F.col("id").cast("string").alias("station_id")],
                       *[(F.col("id") + h).cast("string").alias(v) for h, v in enumerate(TEST_OBS.volumes)])


def _method_size(spark, df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("codegen")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())))


@pytest.fixture
def static(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_station_keys_are_dealt_by_id_before_they_are_made_distinct(static):
    st = static.range(40).select(F.lit("08").alias("state"), F.col("id").cast("string").alias("station_id"), F.lit("N").alias("direction"), F.lit("l").alias("location"),
                                 F.lit("40.5").alias("latitude"), F.lit("105.1").alias("longitude"), F.lit("1").alias("lane_of_travel"), F.lit("R").alias("type"), F.lit("Y").alias("highway"))
    out = P.profile(_obs(static), st.unionByName(st), TEST_OBS, TEST_STATION)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and not re.search(r"Exchange hashpartitioning\(id#\d+, location#", plan)
    assert out.count() == 40


def test_only_a_profile_of_few_rows_is_broadcast(static, monkeypatch):
    profile = static.createDataFrame([(str(k), "l", 1.0, 2.0, 1, "Y", *[float(k)] * 24) for k in range(6)],
                                     ["id", "location", "latitude", "longitude_w", "lanes", "highway", *AVG_COLUMNS])
    live = static.range(20).select((F.col("id") % 8).cast("string").alias("sid"), F.array(*[F.col("id")] * 24).alias("volumes"), F.col("id").alias("volume"))
    for limit, join in ((6, "BroadcastHashJoin"), (5, "SortMergeJoin")):
        monkeypatch.setattr(SC, "BROADCAST_ROWS", limit)
        for out, n in ((SC.attach_profile(live, profile, 8), 16), (SC.attach_profile_hours(live, profile), 16 * 24)):
            assert join in out._jdf.queryExecution().executedPlan().toString() and out.count() == n


def test_scored_epochs_leave_nothing_behind(spark, tmp, monkeypatch):
    mapping, models, profile = Q._scoring_inputs(spark, "/root/testdata/sf0.001")
    MS.encode(_obs(spark), key=["station_id"]).write.json(tmp + "/topic")
    places = []
    monkeypatch.setattr(ST, "scratch_path", lambda s, name: places.append(f"{tmp}/{name}-{len(places)}") or places[-1])
    ST.score_stream(spark, S.stream_json_messages(spark, tmp + "/topic"), TEST_OBS, TEST_RESULT_FIELDS, mapping, models, profile, tmp + "/out", tmp + "/ck", hour=8).awaitTermination()
    assert places and not any(map(os.path.exists, places))
    assert spark.read.parquet(tmp + "/out_metrics").agg(F.sum("rows")).first()[0] >= 60


def test_all_hours_meet_nulls_and_missing_models_like_one_hour(spark):
    rows = [([0, 3], [float(h) / 7 for h in range(24)]), ([1, None], [1.0] * 24), ([2, 4], [None if h == 8 else 0.5 for h in range(24)]),
            ([2, 4], [float("nan") if h == 9 else 0.5 for h in range(24)])]
    d = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "id int, positions array<int>, logs array<double>").repartition(3)
    models = M.rule_models(spark, 5).where("hour not in (1, 2)")
    every = M.predict_hours(d, models, 2)
    assert "ArrowEvalPython" in every._jdf.queryExecution().executedPlan().toString()
    assert {r.hour for r in every.collect()} == set(range(24)) - {1, 2}
    for h in (0, 1, 8, 9, 23):
        want, got = M.predict(d, models, h, n_positions=2), every.where(F.col("hour") == h)
        plain = lambda df: sorted((r.id, repr(r.predicted)) for r in df.collect())
        assert plain(got) == plain(want)
    assert M.predict_hours(d, models.limit(0), 2).count() == 0


def test_generated_methods_can_be_compiled(static, tmp):
    mapping, models, profile = Q._scoring_inputs(static, "/root/testdata/sf0.001")
    _obs(static).write.parquet(tmp + "/obs")
    obs = static.read.parquet(tmp + "/obs")
    assert _method_size(static, FL.all_nonnegative(obs, TEST_OBS.volumes)) < LARGEST_COMPILED
    assert _method_size(static, P.observations(obs, TEST_OBS)) < LARGEST_COMPILED
    decoded = MS.decode(MS.encode(obs, key=["station_id"]), TEST_OBS.schema())
    tagged = SC.tagged(decoded, TEST_OBS, mapping)
    assert _method_size(static, tagged) < LARGEST_COMPILED
    tagged.write.parquet(tmp + "/tagged")
    scored = SC.score_encoded(static.read.parquet(tmp + "/tagged"), TEST_OBS, TEST_RESULT_FIELDS, models, profile, 8)
    assert _method_size(static, scored) < LARGEST_COMPILED


def test_volume_reasons_keep_their_order(spark):
    bad = ["-1", "NaN", "Infinity", "-Infinity", "-0.0", "", None, "text", "1e308", "-1e-320"]
    rows = spark.createDataFrame([(a, b, "3", "4") for a in bad for b in bad], "a string, b string, c string, d string")
    cols, want = ["a", "b", "c", "d"], []
    for a in bad:
        for b in bad:
            kinds = {"negative" if x in ("-1", "-Infinity", "-1e-320") else "not_finite" if x in ("NaN", "Infinity") else "missing" if x in ("", None, "text") else "ok" for x in (a, b)}
            want.append("negative" if "negative" in kinds else "not_finite" if "not_finite" in kinds else "missing" if "missing" in kinds else "ok")
    got = [r[0] for r in rows.coalesce(1).select(FL.nonnegative_reason(cols)).collect()]
    assert got == want
    assert FL.all_nonnegative(rows, cols).count() == want.count("ok") == 4


def test_logs_of_files_are_compressed(spark, tmp):
    _obs(spark, 500).write.csv(tmp + "/src", header=True)
    ST.publish(spark, tmp + "/src", TEST_OBS, tmp + "/topic", tmp + "/ck", key=("station_id",)).awaitTermination()
    files = [f for f in glob.glob(tmp + "/topic/part-*")]
    assert files and all(f.endswith(".json.gz") for f in files)
    assert spark.read.json(tmp + "/topic", schema="key string, value string").where("value like '{%'").count() == 500
    sinks.write_csv(_obs(spark), tmp + "/csv", compression="gzip")
    assert glob.glob(tmp + "/csv/*.csv.gz") and spark.read.csv(tmp + "/csv", header=True).count() == 60
