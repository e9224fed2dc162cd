"""Property tests (hypothesis) on small random frames."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from hourprofile.operators import messages as MS
from hourprofile.operators import profile as P
from hourprofile.operators import score as SC

from test_operators import OBS, STATION, _obs, _stations

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

vol = st.one_of(st.none(), st.integers(min_value=0, max_value=500).map(str))
obs_row = st.tuples(st.sampled_from(["01", "02"]), st.sampled_from(["1", "2", "3"]),
                    st.sampled_from(["N", "S"]), *[vol] * 24)
station_row = st.tuples(st.sampled_from(["01", "02"]), st.sampled_from(["1", "2", "3"]),
                        st.sampled_from(["N", "S"]), st.sampled_from(["a", "b", None]),
                        st.sampled_from(["0", "0.5", "40.5", "x"]), st.sampled_from(["105.1", "0"]),
                        st.sampled_from(["1", "2"]), st.just("R"), st.sampled_from(["Y", None]))


@SETTINGS
@given(obs=st.lists(obs_row, min_size=1, max_size=25), stations=st.lists(station_row, max_size=12))
def test_naive_equals_eager(spark, obs, stations):
    o, s = _obs(spark, obs), _stations(spark, stations)
    naive = P.profile(o, s, OBS, STATION, eager=False)
    eager = P.profile(o, s, OBS, STATION, eager=True)
    assert naive.exceptAll(eager).count() == 0 and eager.exceptAll(naive).count() == 0


text = st.one_of(st.none(), st.text(alphabet='ab"\\,é 01', max_size=6))


@SETTINGS
@given(rows=st.lists(st.tuples(text, text, text), min_size=1, max_size=20),
       shape=st.sampled_from(["object", "array"]))
def test_message_roundtrip_with_nulls(spark, rows, shape):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b", "c")])
    df = spark.createDataFrame(rows, schema)
    back = MS.decode(MS.encode(df, key=F_lit_key(), shape=shape), schema, shape=shape)
    assert back.where("corrupt").count() == 0
    assert sorted(map(tuple, back.select("a", "b", "c").collect()), key=repr) == sorted(rows, key=repr)


def F_lit_key():
    from pyspark.sql import functions as F
    return F.lit("k")


fold_row = st.tuples(st.sampled_from(["s1", "s2", "s3"]), st.integers(0, 50), st.text("xyz", max_size=2),
                     st.integers(0, 9))


@SETTINGS
@given(rows=st.lists(fold_row, min_size=1, max_size=30, unique_by=lambda r: (r[0], r[1])),
       perm=st.randoms(use_true_random=False), parts=st.integers(1, 5))
def test_fold_independent_of_order_partitioning_and_replay(spark, rows, perm, parts):
    """Arrival order and partitioning do not change the fold; replaying rows
    already folded leaves it unchanged. (Splitting into micro-batches is
    covered by the streaming test, where state buffers carry the orderings.)"""
    schema = "sid string, seq int, other string, current int"
    whole = SC.upsert_fold(spark.createDataFrame(rows, schema), "sid", "seq")
    shuffled = list(rows)
    perm.shuffle(shuffled)
    other = SC.upsert_fold(spark.createDataFrame(shuffled, schema).repartition(parts), "sid", "seq")
    assert other.exceptAll(whole).count() == 0 and whole.exceptAll(other).count() == 0
    replay = SC.upsert_fold(spark.createDataFrame(rows + shuffled, schema), "sid", "seq")
    assert replay.exceptAll(whole).count() == 0 and whole.exceptAll(replay).count() == 0
