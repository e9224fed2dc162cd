"""Structured Streaming jobs: publish records as messages, score them, fold
the results into a keyed table.

Every job takes an explicit checkpoint location (restart resumes from the
offsets/file log there) and returns the ``StreamingQuery``; tests drive them
with ``trigger(availableNow=True)``.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .. import sinks
from .. import sources as S
from ..operators import messages as MS
from ..operators import score as SC
from ..session import drop_path, materialize, scratch_path
from ..sinks.keyed import KeyedTable, current
from ..spec import RESULT_COLUMNS, ObsSpec


def publish(spark: SparkSession, source_dir: str, spec: ObsSpec, out: str, checkpoint: str,
            key: Sequence[str] | None = None, shape: str = "object", header: bool = True,
            max_files: int | None = None, trigger: dict | None = None, multiline: bool = False,
            kafka: Mapping[str, str] | None = None) -> StreamingQuery:
    """CSV files -> ``(key, value)`` messages -> log.

    The value is the JSON of the record plus its ingest ``timestamp``. ``key``
    names the columns of the message key (default: ingest time as text); ``multiline``
    reads records whose fields hold line breaks (a file is then one split).
    With ``kafka={"servers": ..., "topic": ...}`` the log is a Kafka topic,
    otherwise the JSON-lines folder ``out`` (file twin with the same frame).
    """
    src = S.stream_csv(spark, source_dir, spec.schema(), header=header, max_files=max_files, multiline=multiline)
    src = src.withColumn("timestamp", F.current_timestamp())
    msgs = MS.encode(src, key=list(key) if key else None, shape=shape)
    if kafka:
        return sinks.stream_kafka(msgs, kafka["servers"], kafka["topic"], checkpoint, trigger)
    return sinks.stream_json_files(msgs, out, checkpoint, trigger)


#: Columns of the log that order its messages; a file twin may give some of them.
LOG_ORDER = ("timestamp", "partition", "offset")


def _log_columns(df: DataFrame) -> list[str]:
    return [c for c in LOG_ORDER if c in df.columns]


def local_hour(zone: str | None = None):
    """The wall-clock hour in ``zone`` (default: the session's zone), fixed per micro-batch."""
    now = F.localtimestamp()
    return F.hour(now if zone is None else F.convert_timezone(None, F.lit(zone), now))


def decoded(messages: DataFrame, spec: ObsSpec, shape: str = "object",
            mode: str = "PERMISSIVE") -> DataFrame:
    """Log frame -> typed records (+ ``key``, the log's order and ``corrupt``); ``shape``
    ``mixed`` reads each message by the shape that it has."""
    if shape == "mixed":
        return MS.decode_mixed(messages, spec.schema(), keep=("key", *_log_columns(messages)))
    return MS.decode(messages, spec.schema(), shape=shape, mode=mode, unquote=shape == "array",
                     keep=("key", *_log_columns(messages)))


def scored(messages: DataFrame, spec: ObsSpec, fields: Mapping[str, str], mapping: DataFrame,
           models: DataFrame, profile: DataFrame, hour=None, keep: Sequence[str] | None = None,
           shape: str = "object", zone: str | None = None) -> DataFrame:
    """Score the good messages, as one plan (``score_stream`` keeps the others as well).

    ``hour=None`` = wall-clock hour of the micro-batch in ``zone``. ``keep``: by
    default the date and the log's order, by which ``upsert_stream`` folds.
    """
    keep = ["date", *_log_columns(messages)] if keep is None else keep
    good, _ = MS.quarantine(MS.parsed_once(decoded(messages, spec, shape)))
    h = local_hour(zone) if hour is None else hour
    return SC.score(good, spec, fields, mapping, models, profile, h, keep=keep)


#: What ``score.tagged`` calls messages.
REASONS = ("ok", "corrupt", "negative", "not_finite", "missing", "unseen")


def _observed_counts(name: str, good: DataFrame, bad: DataFrame, scored_rows: DataFrame):
    """The three frames with counts observed in their plans, and a function that gives the
    counts as ``(kind, rows)`` once all of them have been written."""
    seen = Observation(f"{name}-ok"), Observation(f"{name}-bad"), Observation(f"{name}-rows")
    count = F.count(F.lit(1))
    reasons = [F.coalesce(F.sum((F.col("reason") == r).cast("long")), F.lit(0)).alias(r) for r in REASONS[1:]]
    bad, scored_rows = bad.observe(seen[1], *reasons), scored_rows.observe(seen[2], count.alias("scored"))

    def counts(spark: SparkSession) -> DataFrame:
        found = {**seen[1].get, **seen[2].get, "ok": good}
        rows = [(k, int(n)) for k, n in found.items() if n]
        return spark.createDataFrame(rows or [("scored", 0)], "kind string, rows long").coalesce(1)

    return bad, scored_rows, counts


def score_stream(spark: SparkSession, messages: DataFrame, spec: ObsSpec,
                 fields: Mapping[str, str], mapping: DataFrame, models: DataFrame,
                 profile: DataFrame | str, out: str | KeyedTable, checkpoint: str, hour=None,
                 trigger: dict | None = None, keep: Sequence[str] | None = None,
                 shape: str = "object", rejected: str | None = None, metrics: str | None = None,
                 zone: str | None = None, compact_every: int = 0) -> StreamingQuery:
    """Score every micro-batch; no message is lost.

    Result rows go to ``out/epoch=<n>``, messages that can't be scored, with a
    ``reason`` (``score.tagged``), to ``rejected/epoch=<n>`` and the counts of result
    rows (kind ``scored``) and of messages by reason to ``metrics/epoch=<n>``
    (default folders: ``out`` with a suffix). A replayed epoch overwrites its own
    folders. Counts are observed in the plans that write, nothing is read again.

    With a ``KeyedTable`` as ``out`` the result rows are upserted into it instead; rows,
    ``rejected`` and ``metrics`` of an epoch become visible together, and every
    ``compact_every`` epochs the table is compacted.

    A ``profile`` given as a path is read anew for every micro-batch: a version made
    current by ``keyed.publish`` takes effect with the next one, while a batch that is
    running goes on with the files of its own version.
    """
    dec = decoded(messages, spec, shape)
    keep = ["date", *_log_columns(messages)] if keep is None else keep
    table = out if isinstance(out, KeyedTable) else None
    folder, at = "" if table else out.rstrip("/"), "{}/epoch={}".format
    rejected, metrics = rejected or folder + "_rejected", metrics or folder + "_metrics"
    h = local_hour(zone) if hour is None else hour

    def write_epoch(batch: DataFrame, epoch: int) -> None:
        own = batch.sparkSession
        prof = current(own, profile) if isinstance(profile, str) else profile
        # written once for the passes below: cached text would take many times the memory or disk
        place = scratch_path(own, "epoch")
        SC.tagged(batch, spec, mapping).write.parquet(place)
        tagged = own.read.parquet(place)
        try:
            ok = tagged.where(F.col("reason") == "ok")
            bad = tagged.where(F.col("reason") != "ok").drop("corrupt", *[f"pos_{c}" for c in spec.categoricals])
            good = SC.score_encoded(ok, spec, fields, models, prof, h, keep)
            bad, good, counts = _observed_counts(f"epoch-{epoch}", ok.count(), bad, good)
            if table:
                table.upsert(good, epoch, {"rejected": bad}, after=lambda: {"metrics": counts(own)})
                if compact_every and (epoch + 1) % compact_every == 0:
                    table.compact()
            else:
                good.write.mode("overwrite").parquet(at(folder, epoch))
                bad.write.mode("overwrite").parquet(at(rejected, epoch))
                counts(own).write.mode("overwrite").parquet(at(metrics, epoch))
        finally:
            drop_path(own, place)

    w = dec.writeStream.foreachBatch(write_epoch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


class ProgressLog(StreamingQueryListener):
    """Metrics observed in streaming plans (``sinks.with_metrics``), one entry per
    micro-batch: ``rows`` holds ``(query id, batch, metric, values)``."""

    def __init__(self):
        self.rows: list[tuple[str, int, str, dict]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows += [(str(p.id), p.batchId, name, row.asDict()) for name, row in (p.observedMetrics or {}).items()]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def await_progress(log: ProgressLog, query: StreamingQuery, name: str, seconds: float = 60.0) -> list[dict]:
    """The values of a metric of every micro-batch of a query that has ended. Listeners
    are told from a queue, so the last events may still be on their way."""
    last = query.lastProgress
    until = time.monotonic() + seconds
    while True:
        found = {b: v for q, b, n, v in log.rows if q == str(query.id) and n == name}
        if last is None or last.batchId in found or name not in (last.observedMetrics or {}):
            return [found[b] for b in sorted(found)]
        if time.monotonic() > until:
            raise TimeoutError(f"no progress of batch {last.batchId} after {seconds} s")
        time.sleep(0.05)


def _order(rows: DataFrame, seq: Sequence[str] | None) -> list[str]:
    return [*_log_columns(rows), "date", "lanes"] if seq is None else list(seq)


def upsert_stream(scored_rows: DataFrame, changelog: str | None, checkpoint: str, key: str = "sid",
                  seq: Sequence[str] | None = None, policy: str = "first",
                  trigger: dict | None = None) -> StreamingQuery:
    """Fold scored rows per key with streaming state (update mode) and write
    each micro-batch's changed keys to ``changelog/epoch=<n>``.

    ``seq`` orders the rows of a key; by default the order of the log, as far as the
    rows have it, then date and lane. State holds one row per key (bounded by the station dimension). A replayed
    epoch overwrites its own folder, so restarts are idempotent;
    ``read_upserted`` gives the table as the upserts leave it. Without a ``changelog``
    the state alone is the table: ``read_state`` reads it from the checkpoint.
    """
    folded = SC.upsert_fold(scored_rows, key, _order(scored_rows, seq), policy=policy)

    def write_epoch(batch: DataFrame, epoch: int) -> None:
        if changelog is None:
            batch.write.format("noop").mode("overwrite").save()  # the batch must run for its state to be kept
        else:
            batch.write.mode("overwrite").parquet(f"{changelog.rstrip('/')}/epoch={epoch}")

    w = (folded.writeStream.outputMode("update").foreachBatch(write_epoch)
         .option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def upsert_stream_jdbc(scored_rows: DataFrame, table: str, options: Mapping[str, str],
                       checkpoint: str, key: str = "sid", seq: Sequence[str] | None = None,
                       update_cols: Sequence[str] = ("current",),
                       trigger: dict | None = None) -> StreamingQuery:
    """Same fold, applied to a database table: each micro-batch's changed keys
    (one row per key) are staged partition-parallel and merged in one
    statement that inserts new keys and updates only ``update_cols``.
    The table is created on the first batch if absent."""
    from ..spec import RESULT_SCHEMA
    folded = SC.upsert_fold(scored_rows, key, _order(scored_rows, seq)).select(*RESULT_COLUMNS)

    def write_epoch(batch: DataFrame, epoch: int) -> None:
        sinks.ensure_table(batch.sparkSession, table, RESULT_SCHEMA, [key], dict(options))
        sinks.upsert_jdbc(batch, table, [key], list(update_cols), dict(options),
                          staging=f"{table}_staging")

    w = (folded.writeStream.outputMode("update").foreachBatch(write_epoch)
         .option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def _newest(log: DataFrame, key: str) -> DataFrame:
    cols = [c for c in log.columns if c not in (key, "epoch")]
    return (log.groupBy(key).agg(F.max_by(F.struct(*cols, "epoch"), F.col("epoch")).alias("_r"))
            .select(key, *[F.col(f"_r.{c}").alias(c) for c in cols], F.col("_r.epoch").alias("epoch")))


def _snapshot_path(changelog: str) -> str:
    return changelog.rstrip("/") + "_snapshot"


def read_upserted(spark: SparkSession, changelog: str, key: str = "sid") -> DataFrame:
    """Current table: the newest version of every key, from the last compacted
    snapshot (if any) plus the epochs written after it."""
    log = spark.read.parquet(changelog)
    snap = _snapshot_or_none(spark, changelog)
    if snap is not None:
        upto = snap.agg(F.max("epoch")).first()[0]
        log = snap.unionByName(log.where(F.col("epoch") > F.lit(upto)))
    out = _newest(log, key)
    return out.select(*[c for c in RESULT_COLUMNS if c in out.columns])


def _snapshot_or_none(spark: SparkSession, changelog: str):
    try:
        return spark.read.parquet(_snapshot_path(changelog))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None  # no snapshot yet


def compact_upserted(spark: SparkSession, changelog: str, key: str = "sid") -> str:
    """Fold the changelog (and any earlier snapshot) into a new snapshot,
    keeping each key's newest version and its epoch. Reads then touch the
    snapshot plus the epochs written after it instead of the whole log."""
    log = spark.read.parquet(changelog)
    snap = _snapshot_or_none(spark, changelog)
    if snap is not None:
        upto = snap.agg(F.max("epoch")).first()[0]
        log = snap.unionByName(log.where(F.col("epoch") > F.lit(upto)))
    # written aside first: the new snapshot must not be read while it is replaced
    folded = materialize(_newest(log, key), "upsert-snapshot")
    folded.write.mode("overwrite").parquet(_snapshot_path(changelog))
    return _snapshot_path(changelog)


def read_state(spark: SparkSession, checkpoint: str, scored_rows: DataFrame, key: str = "sid",
               seq: Sequence[str] | None = None, latest_cols: Sequence[str] = ("current",)) -> DataFrame:
    """The upsert table out of the state that ``upsert_stream`` (policy ``first``) keeps in
    its checkpoint, one row per key, without a change log.

    The state holds the buffers of the two aggregates: the first row's columns and
    its place, the last row's columns and its place. ``scored_rows`` gives their names and types.
    """
    order = _order(scored_rows, seq)
    cols = [c for c in scored_rows.columns if c != key]
    kinds = {f.name: f.dataType.simpleString() for f in scored_rows.schema.fields}
    shape = "struct<{}>".format
    fields = [",".join(f"{c}:{kinds[c]}" for c in part) for part in
              ([c for c in cols if c not in latest_cols], order, [c for c in cols if c in latest_cols], order)]
    buffers = shape(",".join(f"{n}:{shape(f)}" for n, f in zip(("first", "first_place", "last", "last_place"), fields)))
    state = spark.read.format("statestore").load(checkpoint)
    rows = state.select(F.col(f"key.{key}").alias(key), F.col("value").cast(buffers).alias("_v"))
    out = rows.select(key, *[F.col(f"_v.last.{c}" if c in latest_cols else f"_v.first.{c}").alias(c) for c in cols])
    return out.select(*[c for c in RESULT_COLUMNS if c in out.columns])
