"""Operator tests on literal frames: nulls, empties, bad text, negatives."""

import math

import pytest
from pyspark.sql import functions as F

from hourprofile.functions import columns as C
from hourprofile.operators import encode as E
from hourprofile.operators import filters as FL
from hourprofile.operators import profile as P
from hourprofile.operators import project as PR
from hourprofile.operators import score as SC
from hourprofile.spec import StationSpec, ObsSpec

VOLS = tuple(f"v{h:02d}" for h in range(24))


def _key(t):
    return tuple((x is None, str(x)) for x in t)


def rows(df, *cols):
    src = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in src.collect()), key=_key)


def test_composite_key_null_policies(spark):
    df = spark.createDataFrame([("08", "0001", "North"), ("08", None, "East")], "a string, b string, c string")
    prop = rows(PR.composite_key(df, ["a", "b", "c"]), "id")
    assert prop == [("08_0001_North",), (None,)]
    ph = rows(PR.composite_key(df, ["a", "b", "c"], nulls="placeholder"), "id")
    assert ("08_*_East",) in ph


def test_nonzero_filter_modes(spark):
    df = spark.createDataFrame(
        [("a", "0", "1"), ("b", "0.5", "1"), ("c", "40.5", "1"), ("d", "text", "1"),
         ("e", None, "1"), ("f", "40.5", "0.0")], "k string, lat string, lon string")
    assert [r[0] for r in rows(FL.nonzero(df, ["lat", "lon"]), "k")] == ["b", "c"]
    assert [r[0] for r in rows(FL.nonzero(df, ["lat", "lon"], legacy_int_cast=True), "k")] == ["c"]


def test_all_nonnegative_and_quarantine(spark):
    base = ["1"] * 24
    data = [("ok", *base), ("neg", "-1", *base[1:]), ("miss", None, *base[1:]),
            ("text", "x", *base[1:]), ("negmiss", "-2", None, *base[2:])]
    schema = "k string, " + ", ".join(f"{v} string" for v in VOLS)
    df = spark.createDataFrame(data, schema)
    assert [r[0] for r in rows(FL.all_nonnegative(df, VOLS), "k")] == ["ok"]
    good, bad = FL.all_nonnegative(df, VOLS, quarantine=True)
    assert [r[0] for r in rows(good, "k")] == ["ok"]
    assert dict(rows(bad, "k", "reason")) == {"neg": "negative", "miss": "missing",
                                               "text": "missing", "negmiss": "negative"}


def test_typed_try_cast(spark):
    df = spark.createDataFrame([("1.5", "7", "x"), ("abc", "2.9", None)], "a string, b string, c string")
    out = rows(PR.typed(df, {"a": ("a", "double"), "b": ("b", "int"), "c": ("c", "string")}))
    assert (1.5, 7, "x") in out and (None, None, None) in out
    legacy = rows(PR.typed(df, {"b": ("b", "int")}, legacy_int_cast=True))
    assert (2,) in legacy


OBS = ObsSpec(key=("st", "sid", "dir"), categoricals=("dir",), volumes=VOLS)
STATION = StationSpec(key=("st", "sid", "dir"), latitude="lat", longitude="lon", attributes={
    "location": ("loc", "string"), "latitude": ("lat", "double"), "longitude_w": ("lon", "double"),
    "lanes": ("lane", "int"), "type": ("typ", "string"), "highway": ("hw", "string")})


def _obs(spark, data):
    schema = "st string, sid string, dir string, " + ", ".join(f"{v} string" for v in VOLS)
    return spark.createDataFrame(data, schema)


def _stations(spark, data):
    return spark.createDataFrame(data, "st string, sid string, dir string, loc string, lat string, "
                                       "lon string, lane string, typ string, hw string")


def test_profile_naive_equals_eager_with_fanout_nulls_duplicates(spark):
    v = lambda x: [str(x)] * 24
    obs = _obs(spark, [("08", "1", "N", *v(10)), ("08", "1", "N", *v(20)),
                       ("08", "1", "N", None, *v(30)[1:]),        # null volume ignored by avg
                       ("08", "2", "S", *v(5)),                   # no station
                       (None, "3", "N", *v(7))])                  # null key part
    st = _stations(spark, [
        ("08", "1", "N", "loc1", "40.5", "105.1", "1", "R", "Y"),
        ("08", "1", "N", "loc1", "40.5", "105.1", "2", "R", "Y"),   # second lane
        ("08", "1", "N", "loc1", "40.5", "105.1", "2", "R", "Y"),   # exact duplicate
        ("08", "9", "N", "noobs", "1", "1", "1", "R", "Y"),         # station without obs
        ("08", "1", "N", "zero", "0", "105.1", "1", "R", "Y"),      # dropped: zero latitude
    ])
    naive = P.profile(obs, st, OBS, STATION, eager=False)
    eager = P.profile(obs, st, OBS, STATION, eager=True)
    assert naive.count() == 2
    assert naive.exceptAll(eager).count() == 0 and eager.exceptAll(naive).count() == 0
    r = {row["lanes"]: row for row in naive.collect()}
    assert r[1]["avgvolume00"] == pytest.approx(15.0)
    assert r[1]["avgvolume01"] == pytest.approx(20.0)
    assert r[2]["longitude"] == pytest.approx(-105.1)


def test_encoder_fit_dense_and_stable(spark):
    df = spark.createDataFrame([(c,) for c in "dbcaadbx"] + [(None,)], "f string")
    for parts in (1, 3, 8):
        m = E.fit(df.repartition(parts), ["f"])
        got = sorted((r["value"], r["idx"]) for r in m.collect())
        assert got == [("a", 0), ("b", 1), ("c", 2), ("d", 3), ("x", 4)]


def test_dense_index_distributed_equals_window(spark):
    df = spark.createDataFrame([(g, f"v{i:03d}") for g in range(3) for i in range(0, 150, g + 1)],
                               "g int, v string")
    one = E.dense_index(df, "g", "v")
    dist = E.dense_index(df, "g", "v", num_partitions=7)
    assert one.exceptAll(dist).count() == 0 and dist.exceptAll(one).count() == 0
    got = sorted((r["g"], r["idx"]) for r in dist.collect())
    assert got == sorted((g, i) for g in range(3) for i in range(len(range(0, 150, g + 1))))


def test_dense_index_loses_no_row(spark, tmp):
    df = spark.range(0, 400_000, 1, 16).select((F.col("id") % 2).cast("int").alias("g"), F.sha1(F.col("id").cast("string")).alias("v"),
                                               (F.col("id") * 3).alias("more"))
    E.dense_index(df, "g", "v").write.parquet(tmp + "/idx")
    for r in spark.read.parquet(tmp + "/idx").groupBy("g").agg(
            F.count("idx").alias("n"), F.countDistinct("idx").alias("d"), F.min("idx").alias("lo"), F.max("idx").alias("hi"), F.countDistinct("more").alias("m")).collect():
        assert (r.n, r.d, r.lo, r.hi, r.m) == (200_000, 200_000, 0, 199_999, 200_000)


def test_one_rule_for_volumes(spark):
    from hourprofile.functions import columns as C
    from hourprofile.operators import filters as FL
    rows = [("5",), ("12.5",), ("-1",), ("NaN",), ("Infinity",), ("-Infinity",), ("",), ("text",), (None,), ("3000000000",)]
    df = spark.createDataFrame(rows, "v string")
    got = [(r.v, r.n, r.why, r.cur) for r in df.select(
        "v", C.volume("v").alias("n"), FL.nonnegative_reason(["v"]).alias("why"),
        C.scaled_current(C.volume("v")).alias("cur")).collect()]
    assert [x[1] for x in got] == [5, 12, -1, None, None, None, None, None, None, 3000000000]
    assert [x[2] for x in got] == ["ok", "ok", "negative", "not_finite", "not_finite", "negative", "missing", "missing", "missing", "ok"]
    assert got[3][3] is None and got[0][3] == 9


def test_not_finite_row_changes_no_other(spark):
    import numpy as np
    from hourprofile.operators import model as M
    with pytest.raises(ValueError):
        M.gram_matrix(spark.createDataFrame([(0, 0, None)], "i int, j int, g double"), 1)
    a = np.eye(3) * 7e9
    w, rank, _ = M.normal_equations(a, np.array([7e9, 0.0, 7e9]))
    assert np.allclose(w, [1, 0, 1]) and rank == 3


def test_array_messages_quotes_and_lengths(spark):
    from pyspark.sql import types as T
    from hourprofile.operators import messages as MS
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType())])
    df = spark.createDataFrame([("k", '["\\"06\\"","\\"12\\""]'), ("k", '["06"]'), ("k", None), ("k", '["x","y"]')], "key string, value string")
    got = [(r.a, r.n, r.corrupt) for r in MS.decode(df, schema, shape="array", unquote=True).collect()]
    assert got == [("06", 12, False), (None, None, True), (None, None, True), ("x", None, False)]
    df = spark.createDataFrame([("k", "{}"), ("k", None), ("k", '{"a":"1"}')], "key string, value string")
    assert [r.corrupt for r in MS.decode(df, schema).collect()] == [False, True, False]


def test_upsert_text_without_merge():
    from hourprofile import sinks
    assert sinks.on_conflict_sql("t", "s", ["sid"], ["sid", "current"], ["current"]) == (
        'INSERT INTO t ("sid", "current") SELECT "sid", "current" FROM s ON CONFLICT ("sid") DO UPDATE SET "current" = EXCLUDED."current"')


def test_hour_in_a_zone(spark):
    from hourprofile.functions import columns as C
    r = spark.range(1).select(C.current_hour("UTC").alias("u"), C.current_hour("Asia/Kolkata").alias("k"), C.current_hour("Asia/Tokyo").alias("t")).first()
    assert (r.t - r.u) % 24 == 9 and (r.k - r.u) % 24 in (5, 6)


def test_encoder_offsets_and_unseen(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "z")], "f string, g string")
    m = E.fit(df, ["f", "g"])
    assert sorted((r["field"], r["value"], r["offset"] + r["idx"]) for r in m.collect()) == [
        ("f", "a", 0), ("f", "b", 1), ("g", "x", 2), ("g", "y", 3), ("g", "z", 4)]
    new = spark.createDataFrame([("a", "x"), ("c", "y")], "f string, g string")
    assert rows(E.apply(new, m, ["f", "g"], on_unseen="null"), "f", "pos_f", "pos_g") == [
        ("a", 0, 2), ("c", None, 3)]
    assert rows(E.apply(new, m, ["f", "g"], on_unseen="skip"), "f") == [("a",)]
    with pytest.raises(Exception, match="unseen value for f"):
        E.apply(new, m, ["f", "g"], on_unseen="fail").collect()


def test_mapping_json_roundtrip(spark, tmp):
    df = spark.createDataFrame([("07", "North"), ("23", "East West")], "d string, n string")
    m = E.fit(df, ["d", "n"])
    back = E.load_mapping_json(spark, E.save_mapping_json(m, tmp + "/m"), ["d", "n"])
    assert m.exceptAll(back).count() == 0 and back.exceptAll(m).count() == 0
    text = open([p for p in __import__("glob").glob(tmp + "/m/part-*")][0]).read()
    assert text.startswith("[{") and '"\\"07\\"":0' in text


def test_level_current_wkt(spark):
    df = spark.createDataFrame([(21, 10.0), (20, 10.0), (5, 10.0), (4, 10.0), (1, 0.0), (3, None)],
                               "v int, h double")
    out = rows(df.select("v", C.level("v", "h").alias("l")))
    assert dict(out) == {21: "High", 20: "Medium", 5: "Medium", 4: "Low", 1: "High", 3: None}
    cur = dict(rows(spark.createDataFrame([(0,), (1,), (7,), (100,), (12345,), (-4,)], "v int")
                    .select("v", C.scaled_current("v"))))
    for v in (0, 1, 7, 100, 12345):
        assert cur[v] == int(max(v + v * 0.5 * 1.764052345967664, 0))
    assert cur[-4] == 0
    w = spark.range(1).select(C.point_wkt(F.lit(-105.5), F.lit(40.25)).alias("w")).first()["w"]
    assert w == "POINT(-105.5 40.25)"


def test_at_hour_and_without_hour(spark):
    df = spark.range(1).select(F.array(*[F.lit(h) for h in range(24)]).alias("a"))
    r = df.select(C.at_hour("a", 5).alias("x"), C.without_hour("a", 5).alias("y")).first()
    assert r["x"] == 5 and r["y"] == [h for h in range(24) if h != 5]


def test_log_volume_negative_is_null(spark):
    r = spark.range(1).select(C.log_volume(F.lit(-1)).alias("a"), C.log_volume(F.lit(0)).alias("b")).first()
    assert r["a"] is None and r["b"] == pytest.approx(math.log(0.01))


def test_upsert_fold_first_and_latest(spark):
    df = spark.createDataFrame([("s", 1, "a", 10), ("s", 2, "b", 20), ("s", 3, "c", 30), ("t", 1, "x", 1)],
                               "sid string, seq int, other string, current int")
    first = {r["sid"]: r for r in SC.upsert_fold(df, "sid", "seq").collect()}
    assert (first["s"]["other"], first["s"]["current"], first["s"]["seq"]) == ("a", 30, 1)
    latest = {r["sid"]: r for r in SC.upsert_fold(df, "sid", "seq", policy="latest").collect()}
    assert (latest["s"]["other"], latest["s"]["current"]) == ("c", 30)
    # replaying rows already folded leaves the result unchanged
    again = SC.upsert_fold(df.unionByName(df), "sid", "seq")
    assert again.exceptAll(SC.upsert_fold(df, "sid", "seq")).count() == 0


def test_mapping_json_import_of_dumped_format(spark, tmp):
    # the layout a Python json.dump of a list of dicts produces: quoted keys,
    # spaces after separators, fields in order
    text = '[{"\\"07\\"": 1, "\\"23\\"": 0}, {"\\"North\\"": 0}]'
    with open(tmp + "/mapping.txt", "w") as fh:
        fh.write(text)
    m = E.load_mapping_json(spark, tmp + "/mapping.txt", ["day_of_data", "direction"])
    got = sorted((r["field"], r["value"], r["idx"], r["offset"]) for r in m.collect())
    assert got == [("day_of_data", "07", 1, 0), ("day_of_data", "23", 0, 0), ("direction", "North", 0, 2)]


def test_result_point_orders(spark):
    df = spark.createDataFrame([(40.25, 105.5)], "latitude double, longitude double")
    a = SC.with_point(df).first()
    b = SC.with_point(df, order="latlon").first()
    assert a["geom"] == "POINT(-105.5 40.25)" and a["srid"] == 4326
    assert b["geom"] == "POINT(40.25 105.5)"
