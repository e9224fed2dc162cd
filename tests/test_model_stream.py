"""Model parity with MLlib, message decoding modes, streams, plan guards."""

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourprofile import sinks
from hourprofile import sources as S
from hourprofile import streaming as ST
from hourprofile.functions import columns as C
from hourprofile.operators import encode as E
from hourprofile.operators import messages as MS
from hourprofile.operators import model as M
from hourprofile.operators import score as SC
from hourprofile.plans import queries as Q
from hourprofile.plans import testviews as tv
from hourprofile.spec import TEST_OBS, TEST_RESULT_FIELDS

from conftest import SF_SMALL

CATS = TEST_OBS.categoricals


@pytest.fixture(scope="module")
def encoded(spark):
    return Q._encoded(spark, SF_SMALL)


def test_gram_pass_equals_block_gram(spark, encoded):
    enc, _, k = encoded
    g = M.gram_matrix(M.gram(M.design(enc, CATS, TEST_OBS.volumes), k), k + 25)
    dec = enc.select(F.array(*[F.col(f"pos_{c}") for c in CATS]).alias("positions"),
                     *[F.round(C.log_volume(v), 6).cast("decimal(12,6)").alias(f"q{h:02d}")
                       for h, v in enumerate(TEST_OBS.volumes)])
    gb = M.gram_matrix(M.gram_blocks(dec, k), k + 25)
    n = g[k + 24, k + 24]
    assert n == enc.count()
    # block form quantises features to 1e-6: agreement to that order per row
    assert np.allclose(g, gb, rtol=1e-6, atol=1e-5 * n)


def test_exact_gram_large_values(spark):
    """Huge volumes (log ~ 40) still sum exactly: chunks shrink, no overflow."""
    from decimal import Decimal
    rows = [([0, 1], [int(40_123_456 - r)] + [0] * 23) for r in range(3000)]
    df = spark.createDataFrame(rows, "positions array<int>, qlogs array<bigint>").repartition(2)
    g = {(r["i"], r["j"]): r["g"] for r in M.gram_exact(df, 2).collect()}
    exact = sum(Decimal(40_123_456 - r) ** 2 for r in range(3000)) * Decimal("1e-12")
    assert g[(2, 2)] == float(round(exact, 6))
    assert g[(0, 0)] == 3000.0 and g[(26, 26)] == 3000.0


def test_gd_matches_mllib_sgd(spark, encoded):
    from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD
    enc, _, k = encoded
    d = M.design(enc, CATS, TEST_OBS.volumes)
    g = M.gram_matrix(M.gram(d, k), k + 25)
    hour = 8
    ours = M.fit(spark, g, k, hours=[hour]).first()
    pts = []
    for r in d.collect():
        x = np.zeros(k)
        x[list(r["positions"])] = 1.0
        logs = list(r["logs"])
        feats = np.concatenate([x, logs[:hour], logs[hour + 1:]])
        pts.append(LabeledPoint(logs[hour], feats))
    rdd = spark.sparkContext.parallelize(pts, 4)
    ref = LinearRegressionWithSGD.train(rdd, iterations=100, step=0.01, intercept=True)
    assert ours["intercept"] == pytest.approx(ref.intercept, rel=1e-9, abs=1e-9)
    assert np.allclose(ours["coef"], ref.weights.toArray(), rtol=1e-9, atol=1e-9)


def test_models_save_load_and_predict(spark, encoded, tmp):
    enc, _, k = encoded
    models = M.rule_models(spark, k)
    back = M.load(spark, M.save(models, tmp + "/models"))
    assert back.count() == 24 and len(back.first()["coef"]) == k + 23
    d = M.design(enc, CATS, TEST_OBS.volumes, keep=("id", "date"))
    p = M.predict(d, back, 3).select("id", "date", "positions", "logs", "predicted").first()
    explicit = M.predict(d, back, 3, n_positions=len(CATS))
    lam = M.predict(d, back, 3)
    assert explicit.exceptAll(lam).count() == 0
    coef = [((q % 5) - 2) / 64 for q in range(k)] + [((m % 4) + 1) / 128 for m in range(23)]
    logs = list(p["logs"])
    feats = logs[:3] + logs[4:]
    raw = 3 / 8 + sum(coef[q] for q in p["positions"]) + sum(c * x for c, x in zip(coef[k:], feats))
    assert p["predicted"] == pytest.approx(np.exp(raw), rel=1e-12)


def test_normal_solver_runs(spark, encoded):
    enc, _, k = encoded
    g = M.gram_matrix(M.gram(M.design(enc, CATS, TEST_OBS.volumes), k), k + 25)
    m = M.fit(spark, g, k, solver="normal", hours=[0]).first()
    assert np.isfinite(m["intercept"]) and len(m["coef"]) == k + 23


def test_decode_modes_and_shapes(spark):
    schema = "id int, Name string, Age int"
    from pyspark.sql import types as T
    st = T._parse_datatype_string(schema)
    df = spark.createDataFrame([('{"id":1,"Name":"a","Age":3}',), ('{"id":2,"Name":"b","Age":"x"}',),
                                ('{"id":3,',)], "value string")
    out = MS.decode(df, st, keep=()).orderBy("id").collect()
    assert [tuple(r) for r in out if not r["corrupt"]] == [(1, "a", 3, False)]
    assert sum(r["corrupt"] for r in out) == 2
    with pytest.raises(Exception):
        MS.decode(df, st, mode="FAILFAST", keep=()).collect()
    arr = spark.createDataFrame([('["1","a","3"]',)], "value string")
    assert tuple(MS.decode(arr, st, shape="array", keep=()).first()) == (1, "a", 3, False)
    esc = spark.createDataFrame([('{\\"id\\":5,\\"Name\\":\\"e\\",\\"Age\\":1}',)], "value string")
    assert MS.decode(esc, st, unescape=True, keep=()).first()["id"] == 5


def test_encode_key_and_shapes(spark):
    df = spark.createDataFrame([("a", "1", None)], "x string, y string, z string")
    obj = MS.encode(df, key=["x", "y"]).first()
    assert obj["key"] == "a_1" and obj["value"] == '{"x":"a","y":"1"}'
    arr = MS.encode(df, key=["x"], shape="array").first()
    assert arr["value"] == '["a","1",null]'
    ts = MS.encode(df).first()
    assert ts["key"] is not None


def test_read_lines_header_per_file(spark, tmp):
    df = spark.createDataFrame([(str(i), f"n{i}") for i in range(50)], "a string, b string")
    sinks.write_csv(df.repartition(4), tmp + "/csv", header=True, quote_all=True)
    lines = S.read_lines(spark, tmp + "/csv")
    assert lines.count() == 50 and set(lines.columns) == {"a", "b"}
    assert lines.filter(F.col("a") == "a").count() == 0


def test_stream_restart_and_upsert_replay(spark, tmp):
    """Publish in two rounds: the second run resumes from the checkpoint and
    only reads the new files; folding is unchanged by a replay."""
    obs = tv.observations(spark, SF_SMALL)
    days = sorted(r[0] for r in obs.select("date").distinct().collect())
    first, second = days[: len(days) // 2], days[len(days) // 2:]
    src, topic, ck = tmp + "/src", tmp + "/topic", tmp + "/ck"
    sinks.write_csv(obs.where(F.col("date").isin(first)), src + "/a", header=True)
    ST.publish(spark, src + "/*", TEST_OBS, topic, ck, key=(*TEST_OBS.key, "date")).awaitTermination()
    n1 = spark.read.json(topic, schema="key string, value string").count()
    sinks.write_csv(obs.where(F.col("date").isin(second)), src + "/b", header=True)
    ST.publish(spark, src + "/*", TEST_OBS, topic, ck, key=(*TEST_OBS.key, "date")).awaitTermination()
    n2 = spark.read.json(topic, schema="key string, value string").count()
    assert n1 == obs.where(F.col("date").isin(first)).count()
    assert n2 == obs.count()

    mapping, models, profile = Q._scoring_inputs(spark, SF_SMALL)
    msgs = S.stream_json_messages(spark, topic, max_files=1)
    rows = ST.scored(msgs, TEST_OBS, TEST_RESULT_FIELDS, mapping, models, profile, hour=8)
    ST.upsert_stream(rows, tmp + "/log", tmp + "/uck").awaitTermination()
    table = ST.read_upserted(spark, tmp + "/log")
    batch_rows = SC.score(spark.read.json(topic, schema="key string, value string")
                          .transform(lambda d: MS.decode(d, TEST_OBS.schema()))
                          .where(~F.col("corrupt")),
                          TEST_OBS, TEST_RESULT_FIELDS, mapping, models, profile, 8, keep=("date",))
    expect = SC.upsert_fold(batch_rows, "sid", ["date", "lanes"]).select(*table.columns)
    assert table.exceptAll(expect).count() == 0 and expect.exceptAll(table).count() == 0
    # replay: the same messages again into a fresh fold give the same table
    again = SC.upsert_fold(batch_rows.unionByName(batch_rows), "sid", ["date", "lanes"])
    assert again.select(*table.columns).exceptAll(expect).count() == 0
    assert len(glob.glob(tmp + "/log/epoch=*")) >= 2
    # compaction keeps the table unchanged
    ST.compact_upserted(spark, tmp + "/log")
    after = ST.read_upserted(spark, tmp + "/log")
    assert after.exceptAll(expect).count() == 0 and expect.exceptAll(after).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_guards(spark):
    prof = Q.hourly_profile_eager(spark, SF_SMALL)
    plan = _plan(prof)
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # the events scan reads only the four columns the profile needs
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan
    assert "partial_avg" in plan and "partial_sum" in plan
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    txt = ev.select("user_id", "value").where(F.col("value") > 1)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,1.0)]" in txt
    assert "ReadSchema: struct<user_id:bigint,value:double>" in txt
    mapping, models, profile = Q._scoring_inputs(spark, SF_SMALL)
    scored = SC.score(tv.observations(spark, SF_SMALL), TEST_OBS, TEST_RESULT_FIELDS, mapping,
                      models, profile, 8)
    scored.collect()
    splan = scored._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in splan and "ArrowEvalPython" not in splan
    assert splan.count("BroadcastHashJoin") >= 3  # mapping fields, models, profile
    lookup = Q.profile_lookup(spark, SF_SMALL)
    lookup.collect()
    assert "BroadcastHashJoin" in _plan(lookup) or "BroadcastHashJoin" in lookup._jdf.queryExecution() \
        .executedPlan().toString()


def test_train_job_end_to_end(spark, tmp):
    from hourprofile.operators import profile as P
    from hourprofile.plans import jobs as J
    obs = tv.observations(spark, SF_SMALL)
    mapping, models = J.train_job(spark, obs, TEST_OBS, tmp + "/train")
    k = mapping.count()
    assert models.count() == 24
    r = models.orderBy("hour").first()
    assert len(r["coef"]) == k + 23 and np.isfinite(r["intercept"]) and 1 <= r["iterations"] <= 100
    assert E.load_mapping(spark, tmp + "/train/mapping").count() == k
    prof = J.profile_job(obs, tv.stations(spark, SF_SMALL), TEST_OBS, Q.TEST_STATION,
                         out=tmp + "/profile")
    assert prof.count() == P.profile(obs, tv.stations(spark, SF_SMALL), TEST_OBS,
                                     Q.TEST_STATION).count()


def test_score_stream_quarantine(spark, tmp):
    mapping, models, profile = Q._scoring_inputs(spark, SF_SMALL)
    obs = tv.observations(spark, SF_SMALL)
    msgs = MS.encode(obs, key=list((*TEST_OBS.key, "date")))
    first = msgs.orderBy("key").limit(3).collect()
    good_n = msgs.count()
    import re
    bad_rows = [("bad1", first[0]["value"][:-1]),
                ("neg", re.sub(r'"v08":"[0-9]+"', '"v08":"-5"', first[1]["value"])),
                ("unseen", first[2]["value"].replace('"direction":"', '"direction":"zz'))]
    spark.createDataFrame(bad_rows, "key string, value string").unionByName(msgs) \
        .write.json(tmp + "/topic")
    src = S.stream_json_messages(spark, tmp + "/topic")
    prof = tmp + "/profile"
    profile.write.parquet(prof)
    ST.score_stream(spark, src, TEST_OBS, TEST_RESULT_FIELDS, mapping, models, prof, tmp + "/out",
                    tmp + "/ck", hour=8, rejected=tmp + "/q", keep=("date",)).awaitTermination()
    q = {r["key"]: r["reason"] for r in spark.read.parquet(tmp + "/q").collect()}
    assert q == {"bad1": "corrupt", "neg": "negative", "unseen": "unseen"}
    got = spark.read.parquet(tmp + "/out").drop("epoch")
    good = MS.quarantine(MS.decode(msgs, TEST_OBS.schema()))[0]
    expect = SC.score(good, TEST_OBS, TEST_RESULT_FIELDS, mapping, models, profile, 8,
                      keep=("date",)).select(*got.columns)
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0
    assert got.count() > 0 and good_n > 0
    # every message is counted once, and so is every result row
    n = {r["kind"]: r["rows"] for r in spark.read.parquet(tmp + "/out_metrics").groupBy("kind").agg(F.sum("rows").alias("rows")).collect()}
    assert n.pop("scored") == got.count()
    assert n == {"ok": good_n, "corrupt": 1, "negative": 1, "unseen": 1}


def test_ties_fold_by_sequence(spark, tmp):
    """Records of one station and date are folded by the log's offsets, in whatever
    order and micro-batch they come."""
    mapping, models, profile = Q._scoring_inputs(spark, SF_SMALL)
    one = tv.observations(spark, SF_SMALL).limit(40).collect()
    obs = spark.createDataFrame(one, TEST_OBS.schema())
    copies = [obs.withColumn("v08", F.lit(str(10 + k))).withColumn("_seq", F.lit(k)) for k in range(3)]
    tables = []
    for name, order in (("up", (0, 1, 2)), ("down", (2, 1, 0))):
        for k in order:
            MS.encode(copies[k], key=list((*TEST_OBS.key, "date")), columns=TEST_OBS.columns, offset=F.col("_seq")) \
                .coalesce(1).write.mode("append").json(f"{tmp}/{name}")
        msgs = S.stream_json_messages(spark, f"{tmp}/{name}", max_files=1)
        rows = ST.scored(msgs, TEST_OBS, TEST_RESULT_FIELDS, mapping, models, profile, hour=8)
        ST.upsert_stream(rows, f"{tmp}/{name}-log", f"{tmp}/{name}-ck").awaitTermination()
        tables.append(ST.read_upserted(spark, f"{tmp}/{name}-log").orderBy("sid").collect())
        assert len(glob.glob(f"{tmp}/{name}-log/epoch=*")) == 3
    assert tables[0] and tables[0] == tables[1]


def test_integer_prediction(spark):
    """The integer form truncates the back-transformed prediction."""
    row = spark.createDataFrame([([0, 2], [float(i) / 7 for i in range(24)])], "positions array<int>, logs array<double>")
    m = M.rule_models(spark, 4)
    plain = M.predict(row, m, 5, n_positions=2).first()["predicted"]
    assert M.predict(row, m, 5, n_positions=2, integer=True).first()["predicted"] == int(plain) > 0


def test_local_hour_of_a_zone(spark):
    one = spark.range(1).select(ST.local_hour("UTC").alias("u"), ST.local_hour("Asia/Kolkata").alias("k"),
                                F.minute(F.localtimestamp()).alias("m")).first()
    assert one["k"] == (one["u"] + 5 + (one["m"] >= 30)) % 24
