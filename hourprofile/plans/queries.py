"""Registered queries: one callable per operator group, ``(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables through ``testviews`` and runs over the
whole tables. The matching DuckDB SQL lives in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import sources as S
from ..functions import columns as FN
from ..operators import encode as E
from ..operators import filters as FL
from ..operators import messages as MS
from ..operators import ml as ML
from ..operators import model as M
from ..operators import score as SC
from ..operators import profile as P
from ..operators import project as PR
from ..session import materialize, scratch_path
from ..spec import RESULT_COLUMNS, TEST_OBS, TEST_RESULT_FIELDS, TEST_STATION
from .. import sinks
from .. import streaming as ST
from ..sinks.keyed import KeyedTable, publish
from . import jobs as J
from . import testviews as tv

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def hourly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average each hour per station, then attach the station groups (no join
    meets more than one row per station, however hot)."""
    return P.profile(tv.observations(spark, sf_dir), tv.stations(spark, sf_dir),
                     TEST_OBS, TEST_STATION, eager=True)


@register
def hourly_profile_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same result by the straightforward plan: join first, then average."""
    return P.profile(tv.observations(spark, sf_dir), tv.stations(spark, sf_dir),
                     TEST_OBS, TEST_STATION, eager=False)


@register
def hourly_profile_eager(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same result; averages per id before the join (scale plan)."""
    return P.profile(tv.observations(spark, sf_dir), tv.stations(spark, sf_dir),
                     TEST_OBS, TEST_STATION, eager=True)


# ------------------------------------------------------------ sources, projections, filters
def _typed_obs(df: DataFrame) -> DataFrame:
    """Raw observation strings -> same names, volumes as BIGINT."""
    vols = set(TEST_OBS.volumes)
    return df.select(*[F.col(c).try_cast("bigint").alias(c) if c in vols else F.col(c)
                       for c in df.columns])


@register
def csv_header_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV directory scan with header and explicit string schema, no inference."""
    path = tv.staged_obs_csv(spark, sf_dir)
    return _typed_obs(S.read_csv(spark, path, TEST_OBS.schema(), header=True))


@register
def lines_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text scan, header lines dropped, naive split on ',' with quotes stripped."""
    path = tv.staged_obs_csv(spark, sf_dir)
    return _typed_obs(S.read_lines(spark, path, columns=None, sep=","))


def _keyed(spark, sf_dir, nulls):
    obs = tv.observations(spark, sf_dir).withColumn(
        "dir_or_null", F.nullif(F.col("direction"), F.lit("error")))
    out = PR.composite_key(obs, ["state", "station_id", "dir_or_null"], out="id", nulls=nulls)
    return out.select("date", "station_id", "direction", "id")


@register
def composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite station key; null when any part is null."""
    return _keyed(spark, sf_dir, "propagate")


@register
def composite_key_placeholder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite key with '*' standing in for a null part."""
    return _keyed(spark, sf_dir, "placeholder")


@register
def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep the station columns, build the id, rename and cast (bad text -> null)."""
    return P.stations(tv.stations(spark, sf_dir), TEST_STATION, drop_zero_coordinates=False)


@register
def filter_nonzero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations whose coordinates both parse to non-zero numbers."""
    return P.stations(tv.stations(spark, sf_dir), TEST_STATION)


@register
def filter_nonzero_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same, comparing after integer truncation (0.5 counts as zero)."""
    return P.stations(tv.stations(spark, sf_dir), TEST_STATION, legacy_int_cast=True)


@register
def filter_all_nonnegative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observation tagged ok / negative / not_finite / missing in one pass (the
    quarantine split of ``filters.all_nonnegative`` filters on this tag)."""
    obs = PR.composite_key(tv.observations(spark, sf_dir), TEST_OBS.key)
    tagged = obs.withColumn("reason", FL.nonnegative_reason(TEST_OBS.volumes))
    return _typed_obs(tagged.select("id", "date", "reason", *TEST_OBS.volumes))


#: What stands in volume v08 of the dirty view, by station number modulo 7.
DIRTY = ("-1", "12.5", "NaN", "Infinity", "", "text", "3000000000")


def dirty_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with a rule-made bad or odd volume in every row."""
    kind = F.col("station_id").cast("bigint") % len(DIRTY)
    return tv.observations(spark, sf_dir).withColumn("v08", F.element_at(F.array(*map(F.lit, DIRTY)), (kind + 1).cast("int")))


@register
def dirty_volumes_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reason and typed volume of observations with odd volumes."""
    obs = PR.composite_key(dirty_observations(spark, sf_dir), TEST_OBS.key)
    return obs.select("id", "date", FL.nonnegative_reason(TEST_OBS.volumes).alias("reason"), FN.volume("v08").alias("volume"))


@register
def dirty_volumes_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly profile over odd volumes: decimals truncate, bad text is no volume."""
    return P.profile(dirty_observations(spark, sf_dir), tv.stations(spark, sf_dir), TEST_OBS, TEST_STATION)


@register
def dense_index_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distributed dense numbering of the order keys of every return flag."""
    keys = tv.table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    return E.dense_index(keys, "l_returnflag", "l_orderkey")


@register
def station_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many-to-many join of stations (a row per lane) to daily observations."""
    st = P.stations(tv.stations(spark, sf_dir), TEST_STATION)
    ob = P.observations(tv.observations(spark, sf_dir), TEST_OBS, keep=("date",))
    return P.attach_station(st, ob).select("id", "location", "lanes", "date", *P.VOLUME_COLUMNS)


@register
def station_join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join with the rows of crowded ids dealt over salts."""
    st = P.stations(tv.stations(spark, sf_dir), TEST_STATION)
    ob = P.observations(tv.staged_observations(spark, sf_dir), TEST_OBS, keep=("date",))
    return P.attach_station(st, ob, salted=True).select("id", "location", "lanes", "date", *P.VOLUME_COLUMNS)


@register
def hourly_profile_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly profile over the salted join: sums and counts per salt, then combined."""
    return P.profile(tv.staged_observations(spark, sf_dir), tv.stations(spark, sf_dir), TEST_OBS, TEST_STATION, salted=True)


# ------------------------------------------------------------ categorical encoder
CATS = TEST_OBS.categoricals
# Training window of the unseen-category query: levels fitted on the first half
# of the month are applied to the whole month.
TRAIN_WINDOW_END = "2024-01-16"


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with an id whose 24 volumes are all >= 0 (training input)."""
    obs = PR.composite_key(tv.observations(spark, sf_dir), TEST_OBS.key)
    return FL.all_nonnegative(obs, TEST_OBS.volumes)


@register
def category_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values of every categorical field, one pass."""
    return E.levels(training_rows(spark, sf_dir), CATS)


@register
def category_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense value index per field plus one-hot block offsets."""
    return E.fit(training_rows(spark, sf_dir), CATS)


@register
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels per field, block offsets and the one-hot width."""
    return E.level_counts(E.fit(training_rows(spark, sf_dir), CATS))


@register
def mapping_json_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping written in the JSON list-of-objects form and imported back."""
    path = E.save_mapping_json(E.fit(training_rows(spark, sf_dir), CATS),
                               scratch_path(spark, "mapping-json"))
    return E.load_mapping_json(spark, path, CATS)


@register
def encoded_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-hot position of every categorical of every training row."""
    enc, _, _ = _encoded(spark, sf_dir)
    return enc.select("id", "date", *[f"pos_{c}" for c in CATS])


@register
def encoded_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels fitted on the first half-month, applied to all rows; unseen -> null."""
    # the rows feed the fit and the encoding: one table instead of two scans
    rows = materialize(training_rows(spark, sf_dir), "train-rows")
    mapping = E.fit(rows.where(F.col("date") < F.lit(TRAIN_WINDOW_END)), CATS)
    enc = E.apply(rows, mapping, CATS, on_unseen="null")
    return enc.select("id", "date", *[f"pos_{c}" for c in CATS])


# ------------------------------------------------------------ features, Gram, models, scoring
SCORE_HOUR = 8  # hour injected in place of the wall clock in every scoring query


def _encoded(spark: SparkSession, sf_dir: str):
    """Training rows encoded once: the rows are written as a table in the
    shared folder (lineage cut), the mapping is saved and read back, so the
    Gram passes and solvers never re-run the scan and aggregation upstream."""
    return J.encode_training(spark, training_rows(spark, sf_dir), TEST_OBS,
                             keep=("id", "date"))


@register
def log_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label = log volume of the scoring hour; features = the other 23 hours."""
    rows = training_rows(spark, sf_dir)
    logs = F.array(*[FN.log_volume(v) for v in TEST_OBS.volumes])
    label = FN.at_hour(logs, SCORE_HOUR)
    return rows.select("id", "date", F.round(label, 6).alias("label"),
                       *[F.round(FN.feature_at(logs, SCORE_HOUR, m), 6).alias(f"f{m:02d}")
                         for m in range(23)])


@register
def gram_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Gram matrix of [one-hot | log volumes | 1] that training reads."""
    enc, _, k = _encoded(spark, sf_dir)
    return J.training_gram(enc, TEST_OBS, k)


@register
def fit_24_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Gram pass, 24 gradient-descent fits, saved and loaded back; a row per
    weight (the last feature is the intercept), rounded to 1e-6."""
    _, models = J.train_job(spark, training_rows(spark, sf_dir), TEST_OBS, scratch_path(spark, "trained-gd"))
    weights = F.posexplode(F.concat("coef", F.array("intercept"))).alias("feature", "weight")
    return models.select("hour", "iterations", weights).select("hour", "iterations", "feature", (F.round("weight", 6) + 0.0).alias("weight"))


@register
def fit_normal_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 least-squares fits over dependent columns: the rank, the residual sum of
    squares and the mean prediction per date, none of which depends on the solution chosen."""
    # the rows feed the training and the predictions: one table instead of two scans
    rows = materialize(training_rows(spark, sf_dir), "rank-rows")
    mapping, models = J.train_job(spark, rows, TEST_OBS, scratch_path(spark, "trained-normal"), solver="normal")
    enc = E.apply(rows, mapping, CATS)
    p = M.predict_hours(M.design(enc, CATS, TEST_OBS.volumes, keep=("date",)), models, len(CATS), back_transform=False)
    means = p.groupBy("hour", "date").agg(F.round(F.avg("predicted"), 6).alias("predicted"))
    return means.join(F.broadcast(models.select("hour", "rank", F.round("rss", 3).alias("rss"))), "hour")


@register
def predict_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction of the scoring hour's model (deterministic coefficient table)."""
    enc, _, k = _encoded(spark, sf_dir)
    d = M.design(enc, CATS, TEST_OBS.volumes, keep=("id", "date"))
    p = M.predict(d, M.rule_models(spark, k), SCORE_HOUR, n_positions=len(CATS))
    return p.select("id", "date", F.round("predicted", 6).alias("predicted"))


@register
def sparse_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sparse feature vector that pipeline stages make for the scoring hour: a row per
    entry that isn't zero, values rounded to 1e-6."""
    rows = materialize(training_rows(spark, sf_dir), "sparse-rows")
    stages = Pipeline(stages=[ML.CategoryEncoder(inputCols=list(CATS)), ML.HourFeatures(fields=list(CATS), volumes=list(TEST_OBS.volumes), hour=SCORE_HOUR)])
    out = stages.fit(rows).transform(rows).select("id", "date", vector_to_array("features").alias("x"))
    entries = out.select("id", "date", F.size("x").alias("size"), F.posexplode("x").alias("index", "value")).where("value <> 0")
    return entries.withColumn("value", F.round("value", 6))


@register
def predict_all_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction of every record by each of the 24 models, from one read."""
    enc, _, k = _encoded(spark, sf_dir)
    d = M.design(enc, CATS, TEST_OBS.volumes, keep=("id", "date"))
    p = M.predict_hours(d, M.rule_models(spark, k), len(CATS))
    return p.select("id", "date", "hour", F.round("predicted", 6).alias("predicted"))


def _live(spark: SparkSession, sf_dir: str, obs: DataFrame | None = None) -> DataFrame:
    obs = (obs if obs is not None else tv.observations(spark, sf_dir)) \
        .withColumn("sid", FN.composite_key(TEST_OBS.key))
    return obs.select("sid", "date", FN.volume(FN.at_hour(F.array(*TEST_OBS.volumes), SCORE_HOUR)).alias("volume"))


def _profile(spark: SparkSession, sf_dir: str, obs: DataFrame | None = None) -> DataFrame:
    obs = obs if obs is not None else tv.observations(spark, sf_dir)
    return P.profile(obs, tv.stations(spark, sf_dir), TEST_OBS, TEST_STATION, eager=True)


@register
def at_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume of the scoring hour picked from the 24 columns."""
    return _live(spark, sf_dir).withColumnRenamed("sid", "id")


@register
def profile_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record looked up in the written profile: one row per matching lane."""
    obs = tv.staged_observations(spark, sf_dir)  # read twice: profile and live rows
    j = SC.attach_profile(_live(spark, sf_dir, obs), materialize(_profile(spark, sf_dir, obs), "profile"), SCORE_HOUR)
    return j.select("sid", "date", "lanes", "volume", "historical")


@register
def level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High / Medium / Low against the historical average of the hour."""
    obs = tv.staged_observations(spark, sf_dir)  # read twice: profile and live rows
    j = SC.attach_profile(_live(spark, sf_dir, obs), materialize(_profile(spark, sf_dir, obs), "profile"), SCORE_HOUR)
    return j.select("sid", "date", "lanes", "volume", "historical",
                    FN.level("volume", "historical").alias("level"))


@register
def level_all_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level of every record, lane and hour against the profile's 24 averages."""
    obs = tv.staged_observations(spark, sf_dir)
    live = obs.select(FN.composite_key(TEST_OBS.key).alias("sid"), "date", F.array(*[FN.volume(v) for v in TEST_OBS.volumes]).alias("volumes"))
    j = SC.attach_profile_hours(live, materialize(_profile(spark, sf_dir, obs), "profile"))
    return j.select("sid", "date", "lanes", "hour", "volume", "historical", FN.level("volume", "historical").alias("level"))


@register
def scaled_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic live-volume stand-in: int(max(v + v*0.5*z0, 0))."""
    return _live(spark, sf_dir).select("sid", "date", "volume",
                                       FN.scaled_current("volume").alias("current"))


# ------------------------------------------------------------ messages
MSG_KEY = (*TEST_OBS.key, "date")  # composite station id + observation date


def _messages(spark: SparkSession, sf_dir: str, shape: str = "object") -> DataFrame:
    return MS.encode(tv.observations(spark, sf_dir), key=list(MSG_KEY), shape=shape,
                     columns=TEST_OBS.columns)


@register
def message_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record -> (key, JSON object value), null fields omitted."""
    return _messages(spark, sf_dir)


@register
def message_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record -> (key, JSON array of the raw fields)."""
    return _messages(spark, sf_dir, shape="array")


@register
def message_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes value -> string -> from_json(schema) -> data.* (round trip)."""
    msgs = _messages(spark, sf_dir).select("key", F.col("value").cast("binary").alias("value"))
    return MS.decode(msgs, TEST_OBS.schema())


@register
def message_decode_failfast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FAILFAST decoding of well-formed messages (a malformed one fails the query)."""
    return MS.decode(_messages(spark, sf_dir), TEST_OBS.schema(), mode="FAILFAST")


@register
def message_array_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON-array messages (raw fields by position) decoded to typed rows."""
    return MS.decode(_messages(spark, sf_dir, shape="array"), TEST_OBS.schema(), shape="array")


@register
def message_array_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON-array messages whose raw fields still carry their quotes."""
    obs = tv.observations(spark, sf_dir)
    key = FN.composite_key(list(MSG_KEY))
    quoted = obs.select(key.alias("key"), *[F.concat(F.lit('"'), F.col(c), F.lit('"')).alias(c) for c in TEST_OBS.columns])
    return MS.decode(MS.encode(quoted, key=F.col("key"), shape="array", columns=TEST_OBS.columns), TEST_OBS.schema(), shape="array", unquote=True)


@register
def message_decode_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed messages (every 'error'-direction message truncated by one
    character) decode PERMISSIVE to nulls with corrupt = true."""
    msgs = _messages(spark, sf_dir)
    broken = F.when(F.col("key").contains("_error_"),
                    F.expr("substr(value, 1, length(value) - 1)")).otherwise(F.col("value"))
    return MS.decode(msgs.select("key", broken.alias("value")), TEST_OBS.schema())


@register
def message_unescaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that arrive with escaped quotes, un-escaped before they are parsed."""
    msgs = _messages(spark, sf_dir)
    escaped = msgs.select("key", F.replace("value", F.lit('"'), F.lit('\\"')).cast("binary").alias("value"))
    return MS.decode(escaped, TEST_OBS.schema(), unescape=True)


def mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of all kinds, by station number modulo 5: an object, an array, an object
    cut short, JSON null and a number."""
    kind = F.col("station_id").cast("bigint") % 5
    obj, arr = (F.to_json(f(*[F.col(c) for c in TEST_OBS.columns])) for f in (F.struct, F.array))
    value = (F.when(kind == 0, obj).when(kind == 1, arr).when(kind == 2, F.expr("substr(_o, 1, length(_o) - 1)"))
             .when(kind == 3, F.lit("null")).otherwise(F.col("station_id")))
    return tv.observations(spark, sf_dir).withColumn("_o", obj).select(FN.composite_key(list(MSG_KEY)).alias("key"), value.alias("value"))


@register
def message_mixed_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of both shapes and malformed ones in one log, decoded by what each is."""
    return MS.decode_mixed(mixed_messages(spark, sf_dir), TEST_OBS.schema())


# ------------------------------------------------------------ streams
_STREAM_STAGE: dict[tuple, dict] = {}


def _published(spark: SparkSession, sf_dir: str) -> str:
    """Publish the staged observation CSV as JSON messages (file twin of the
    topic), several micro-batches, once per session and scale."""
    k = (spark.sparkContext.applicationId, sf_dir, "published")
    if k not in _STREAM_STAGE:
        out = scratch_path(spark, "topic")
        q = ST.publish(spark, tv.staged_obs_csv(spark, sf_dir), TEST_OBS, out,
                       scratch_path(spark, "publish-ckpt"), key=MSG_KEY,
                       max_files=tv.files_per_trigger(spark))
        q.awaitTermination()
        _STREAM_STAGE[k] = {"out": out}
    return _STREAM_STAGE[k]["out"]


def _scoring_inputs(spark: SparkSession, sf_dir: str):
    k = (spark.sparkContext.applicationId, sf_dir, "inputs")
    if k not in _STREAM_STAGE:
        obs = tv.staged_observations(spark, sf_dir)
        rows = FL.all_nonnegative(PR.composite_key(obs, TEST_OBS.key), TEST_OBS.volumes)
        mpath = E.save_mapping(E.fit(rows, CATS), scratch_path(spark, "mapping"))
        mapping = E.load_mapping(spark, mpath)
        kk = E.width(mapping)
        models = spark.read.parquet(M.save(M.rule_models(spark, kk), scratch_path(spark, "models")))
        ppath = scratch_path(spark, "profile")
        J.profile_job(obs, tv.stations(spark, sf_dir), TEST_OBS,
                      TEST_STATION, out=ppath, eager=True)
        _STREAM_STAGE[k] = {"mapping": mapping, "models": models,
                            "profile": spark.read.parquet(ppath)}
    d = _STREAM_STAGE[k]
    return d["mapping"], d["models"], d["profile"]


def _scored_stream(spark: SparkSession, sf_dir: str):
    """Run the scoring stream (several micro-batches); returns the paths of rows and counts."""
    k = (spark.sparkContext.applicationId, sf_dir, "scored")
    if k not in _STREAM_STAGE:
        mapping, models, profile = _scoring_inputs(spark, sf_dir)
        msgs = S.stream_json_messages(spark, _published(spark, sf_dir), max_files=tv.files_per_trigger(spark, 3))
        out = scratch_path(spark, "scored")
        ST.score_stream(spark, msgs, TEST_OBS, TEST_RESULT_FIELDS, mapping, models, profile, out,
                        scratch_path(spark, "score-ckpt"), hour=SCORE_HOUR, metrics=out + "-counts").awaitTermination()
        _STREAM_STAGE[k] = {"out": out, "metrics": out + "-counts"}
    d = _STREAM_STAGE[k]
    return d["out"], d["metrics"]


@register
def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV file stream -> JSON messages with key and ingest time -> log; read back."""
    msgs = spark.read.json(_published(spark, sf_dir), schema="key string, value string")
    return MS.decode(msgs, TEST_OBS.schema())


@register
def stream_ingest_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published messages carry the time of their micro-batch: whether it reads as a time not
    in the future, and whether all messages of a day and direction share few of them."""
    msgs = spark.read.json(_published(spark, sf_dir), schema="key string, value string")
    schema = T.StructType([*TEST_OBS.schema().fields, T.StructField("timestamp", T.StringType())])
    rows = MS.decode(msgs, schema).withColumn("time", F.col("timestamp").try_cast("timestamp"))
    stamped = F.coalesce((F.col("time") <= F.current_timestamp()) & (F.col("time") > F.lit("2024-01-01").cast("timestamp")), F.lit(False))
    batches = rows.agg(F.count_distinct("time").alias("batches"))
    return (rows.crossJoin(F.broadcast(batches)).select("date", "station_id", "direction", stamped.alias("stamped"), (F.col("batches") > 1).alias("several_batches")))


@register
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message stream -> decode -> encode -> predict -> profile lookup -> level."""
    out, _ = _scored_stream(spark, sf_dir)
    return spark.read.parquet(out).select("date", *RESULT_COLUMNS).withColumn("predicted", F.round("predicted", 6))


@register
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored stream folded per sid in streaming state: first row (by date,
    lane) wins every column but current, the last row wins current."""
    mapping, models, profile = _scoring_inputs(spark, sf_dir)
    msgs = S.stream_json_messages(spark, _published(spark, sf_dir), max_files=tv.files_per_trigger(spark, 3))
    rows = ST.scored(msgs, TEST_OBS, TEST_RESULT_FIELDS, mapping, models, profile, hour=SCORE_HOUR)
    log = scratch_path(spark, "upsert-log")
    ST.upsert_stream(rows, log, scratch_path(spark, "upsert-ckpt")).awaitTermination()
    return ST.read_upserted(spark, log).withColumn("predicted", F.round("predicted", 6))


@register
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch fold where the last row (by date, lane) refreshes every column."""
    out, _ = _scored_stream(spark, sf_dir)
    rows = spark.read.parquet(out)
    return (SC.upsert_fold(rows, "sid", ["date", "lanes"], policy="latest")
            .withColumn("predicted", F.round("predicted", 6)).select(*RESULT_COLUMNS))


@register
def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows counted per micro-batch of the scoring stream, summed."""
    _, counts = _scored_stream(spark, sf_dir)
    return spark.read.parquet(counts).where(F.col("kind") == "scored").agg(F.sum("rows").alias("rows"))


@register
def batch_metrics_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows and volume counted in the streaming plan itself, as its listener is
    told per micro-batch, summed."""
    mapping, models, profile = _scoring_inputs(spark, sf_dir)
    msgs = S.stream_json_messages(spark, _published(spark, sf_dir), max_files=tv.files_per_trigger(spark, 3))
    rows = ST.scored(msgs, TEST_OBS, TEST_RESULT_FIELDS, mapping, models, profile, hour=SCORE_HOUR)
    log = ST.ProgressLog()
    spark.streams.addListener(log)
    try:
        q = sinks.stream_files(sinks.with_metrics(rows, "scored", F.sum("current").alias("current")), scratch_path(spark, "observed"),
                               scratch_path(spark, "observed-ckpt"))
        q.awaitTermination()
        found = ST.await_progress(log, q, "scored")
    finally:
        spark.streams.removeListener(log)
    batches = spark.createDataFrame([(v["rows"], v["current"]) for v in found], "rows long, current long")
    return batches.agg(F.sum("rows").alias("rows"), F.sum("current").alias("current"))


@register
def keyed_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring stream into a keyed table, compacted after every second micro-batch;
    read by merging the base with the epochs since."""
    return _keyed_table(spark, sf_dir).read().select(*RESULT_COLUMNS).withColumn("predicted", F.round("predicted", 6))


@register
def keyed_table_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed table's rows of the 20 stations with the most events."""
    users = (tv.table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
             .join(tv.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("user_id") == F.col("c_custkey"))
             .orderBy(F.col("n").desc(), "user_id").limit(20))
    station = F.concat_ws("_", F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.col("c_custkey").cast("string"), "event_type")
    types = tv.table(spark, sf_dir, "events").select("event_type").distinct()
    keys = [r.sid for r in users.crossJoin(types).select(station.alias("sid")).collect()]
    found = _keyed_table(spark, sf_dir).lookup(keys)
    return found.select(*RESULT_COLUMNS).withColumn("predicted", F.round("predicted", 6))


def _keyed_table(spark: SparkSession, sf_dir: str) -> KeyedTable:
    k = (spark.sparkContext.applicationId, sf_dir, "keyed")
    if k not in _STREAM_STAGE:
        mapping, models, profile = _scoring_inputs(spark, sf_dir)
        msgs = S.stream_json_messages(spark, _published(spark, sf_dir), max_files=tv.files_per_trigger(spark, 3))
        table = KeyedTable(spark, scratch_path(spark, "keyed"))
        ST.score_stream(spark, msgs, TEST_OBS, TEST_RESULT_FIELDS, mapping, models, profile, table, scratch_path(spark, "keyed-ckpt"),
                        hour=SCORE_HOUR, compact_every=2).awaitTermination()
        _STREAM_STAGE[k] = {"table": table}
    return _STREAM_STAGE[k]["table"]


@register
def stream_upsert_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert table read from the stream's own state, after a restart half way."""
    mapping, models, profile = _scoring_inputs(spark, sf_dir)
    topic, checkpoint = scratch_path(spark, "topic-state"), scratch_path(spark, "state-ckpt")
    all_messages = spark.read.json(_published(spark, sf_dir), schema="key string, value string")
    half = F.pmod(F.xxhash64("key"), F.lit(2))
    for part in (0, 1):
        all_messages.where(half == part).repartition(tv.stage_parts(spark), "key").write.mode("append").json(topic, compression=sinks.LOG_COMPRESSION)
        msgs = S.stream_json_messages(spark, topic, max_files=tv.files_per_trigger(spark, 2))
        rows = ST.scored(msgs, TEST_OBS, TEST_RESULT_FIELDS, mapping, models, profile, hour=SCORE_HOUR)
        ST.upsert_stream(rows, None, checkpoint).awaitTermination()
    return ST.read_state(spark, checkpoint, rows).withColumn("predicted", F.round("predicted", 6))


@register
def stream_profile_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of the profile under one stream: the first half-month's messages are
    scored against the profile of these days, then the whole month's profile is
    published and the rest is scored against it."""
    mapping, models, _ = _scoring_inputs(spark, sf_dir)
    obs = tv.staged_observations(spark, sf_dir)
    early = F.col("date") < F.lit(TRAIN_WINDOW_END)
    topic, root, out = (scratch_path(spark, n) for n in ("topic-versions", "profile-versions", "scored-versions"))
    checkpoint = scratch_path(spark, "versions-ckpt")
    for rows, known in ((obs.where(early), obs.where(early)), (obs.where(~early), obs)):
        publish(_profile(spark, sf_dir, known), root)
        MS.encode(rows, key=list(MSG_KEY), columns=TEST_OBS.columns).repartition(tv.stage_parts(spark), "key").write.mode("append").json(topic, compression=sinks.LOG_COMPRESSION)
        msgs = S.stream_json_messages(spark, topic, max_files=tv.files_per_trigger(spark, 2))
        ST.score_stream(spark, msgs, TEST_OBS, TEST_RESULT_FIELDS, mapping, models, root, out, checkpoint, hour=SCORE_HOUR).awaitTermination()
    return spark.read.parquet(out).select("sid", "date", "lanes", "current", "historical", "level")


def _message_stream(spark: SparkSession, msgs: DataFrame, name: str):
    """Messages written to a folder of several files, and a stream over it."""
    topic = scratch_path(spark, name)
    msgs.repartition(tv.stage_parts(spark), "key").write.json(topic, compression=sinks.LOG_COMPRESSION)
    return S.stream_json_messages(spark, topic, max_files=tv.files_per_trigger(spark, 3))


@register
def stream_upsert_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two messages a station and date, folded in the order of their log offsets
    (later dates come first, the raised volume before the plain one)."""
    mapping, models, profile = _scoring_inputs(spark, sf_dir)
    obs = tv.staged_observations(spark, sf_dir)
    seq = 2 * F.datediff(F.lit("2024-01-01").cast("date"), F.col("date").cast("date"))
    raised = obs.withColumn("v08", (F.col("v08").try_cast("bigint") + 100).cast("string")).withColumn("_seq", seq)
    both = raised.unionByName(obs.withColumn("_seq", seq + 1))
    msgs = MS.encode(both, key=list(MSG_KEY), columns=TEST_OBS.columns, offset=F.col("_seq"))
    rows = ST.scored(_message_stream(spark, msgs, "topic-arrival"), TEST_OBS, TEST_RESULT_FIELDS, mapping, models, profile, hour=SCORE_HOUR)
    log = scratch_path(spark, "arrival-log")
    ST.upsert_stream(rows, log, scratch_path(spark, "arrival-ckpt")).awaitTermination()
    return ST.read_upserted(spark, log).withColumn("predicted", F.round("predicted", 6))


@register
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that the scoring stream rejects, with the reason: odd volumes (see
    ``DIRTY``), every 11th station's messages cut short, every 13th's segment unknown."""
    mapping, models, profile = _scoring_inputs(spark, sf_dir)
    station = F.col("station_id").cast("bigint")
    obs = dirty_observations(spark, sf_dir).withColumn("segment", F.when(station % 13 == 0, F.lit("NEW")).otherwise(F.col("segment")))
    value = F.to_json(F.struct(*TEST_OBS.columns))
    cut = F.when(station % 11 == 0, F.expr("substr(_v, 1, length(_v) - 1)")).otherwise(F.col("_v"))
    msgs = obs.withColumn("_v", value).select(FN.composite_key(list(MSG_KEY)).alias("key"), cut.alias("value"))
    out = scratch_path(spark, "sifted")
    ST.score_stream(spark, _message_stream(spark, msgs, "topic-dirty"), TEST_OBS, TEST_RESULT_FIELDS, mapping, models, profile,
                    out, scratch_path(spark, "sifted-ckpt"), hour=SCORE_HOUR, rejected=out + "-rejected").awaitTermination()
    return spark.read.parquet(out + "-rejected").select("key", "reason")


@register
def point_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WKT point of every profile row (signed longitude first), SRID 4326."""
    prof = _profile(spark, sf_dir)
    return prof.select("id", "lanes", FN.point_wkt("longitude", "latitude").alias("wkt"),
                       F.lit(4326).alias("srid"))


@register
def point_wkb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary point (little-endian, with SRID) of every profile row, as hex digits."""
    return _profile(spark, sf_dir).select("id", "lanes", F.lower(F.hex(FN.point_wkb("longitude", "latitude"))).alias("wkb"))


def reset_stages() -> None:
    """Forget staged inputs so the next query rebuilds them (bench fairness)."""
    tv._STAGED.clear()
    _STREAM_STAGE.clear()
