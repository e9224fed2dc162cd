"""Each message of a scored stream is parsed once, whatever its later steps filter by."""

import json

import pytest
from pyspark.sql import functions as F

from hourprofile import streaming as ST
from hourprofile.operators import messages as MS
from hourprofile.operators import score as SC
from hourprofile.plans import queries as Q
from hourprofile.spec import TEST_OBS, TEST_RESULT_FIELDS

SF = "/root/testdata/sf0.001"
LOG = "key string, value string, topic string, partition int, offset long, timestamp timestamp"


def _record(station, **other):
    row = {"date": "2024-01-02", "day_of_data": "02", "day_of_week": "3", "direction": "click", "state": "08", "segment": "BUILDING", "month_of_data": "01",
           "station_id": str(station), **{v: str(h) for h, v in enumerate(TEST_OBS.volumes)}} | other
    return {c: row[c] for c in TEST_OBS.columns if row[c] is not None}


@pytest.fixture
def inputs(spark):
    mapping, models, profile = Q._scoring_inputs(spark, SF)
    known = {f: mapping.where(F.col("field") == f).first()["value"] for f in TEST_OBS.categoricals}
    return mapping, models, profile, known


@pytest.mark.parametrize("shape", ["object", "array"])
def test_filters_do_not_repeat_the_parser(spark, inputs, shape):
    mapping, models, profile, _ = inputs
    msgs = spark.range(1).select(F.lit("k").alias("key"), F.col("id").cast("string").alias("value"), F.current_timestamp().alias("timestamp"), F.lit(1).alias("partition"), F.col("id").alias("offset"))
    plan = ST.scored(msgs, TEST_OBS, TEST_RESULT_FIELDS, mapping, models, profile, hour=8, shape=shape)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_the_same_messages_are_scored_as_when_they_are_tagged(spark, inputs):
    mapping, models, profile, known = inputs
    station = profile.first()["id"].split("_")
    at = known | {"state": station[0], "station_id": station[1], "direction": station[2]}
    kinds = [at, at, {**at, "v08": "-1"}, {**at, "v03": "text"}, {**at, "v04": None}, {**at, "segment": "unheard of"}, {**at, "segment": None}, {**at, "station_id": None}, {**at, "date": None}]
    values = [json.dumps(_record(1, **k)) for k in kinds] + [json.dumps(_record(1, **at))[:-1], "null", "{}", "[]", "", None]
    msgs = spark.createDataFrame([(str(i), v, "t", 0, i, None) for i, v in enumerate(values)], LOG)
    got = ST.scored(msgs, TEST_OBS, TEST_RESULT_FIELDS, mapping, models, profile, hour=8)
    ok = SC.tagged(ST.decoded(msgs, TEST_OBS), TEST_OBS, mapping).where("reason = 'ok'")
    want = SC.score_encoded(ok, TEST_OBS, TEST_RESULT_FIELDS, models, profile, 8, keep=["date", "timestamp", "partition", "offset"])
    assert {r.offset for r in got.collect()} == {0, 1, 8}
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert got.schema == want.schema


def test_rows_behind_the_generator_are_the_same(spark):
    rows = spark.createDataFrame([(1, "a", None), (None, None, None), (1, "a", None), (3, "", [1, None])], "a int, b string, c array<int>")
    once = MS.parsed_once(rows)
    assert once.columns == rows.columns and sorted(map(repr, once.collect())) == sorted(map(repr, rows.collect()))
