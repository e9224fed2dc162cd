"""Versioned Parquet folders: a keyed table without a database.

Folders are written aside and become part of the table by one small manifest file that
is renamed into place, so readers see a whole version or the one before. A version
names a base folder (key-clustered: range-partitioned and sorted by key, with
min/max and Bloom filters, and an index of key ranges per file) and the folders of the
epochs upserted since. Reading merges them; compaction writes a new base and drops
what the kept versions don't name. One writer at a time, as a streaming query is.

The same manifest makes any table replaceable while it is read (``publish``, ``current``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFESTS = "_manifest"
FIRST, LAST = "first_seq", "last_seq"


# ---------------------------------------------------------------- manifests
def _files(spark: SparkSession, root: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path
    return at(root).getFileSystem(spark._jsc.hadoopConfiguration()), at


def versions(spark: SparkSession, root: str) -> list[int]:
    fs, at = _files(spark, root)
    folder = at(f"{root}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """The newest (or named) version's content; an empty one before the first commit."""
    root = root.rstrip("/")
    if version is None:
        found = versions(spark, root)
        if not found:
            return {"version": 0, "base": None, "index": None, "epochs": {}}
        version = found[-1]
    fs, at = _files(spark, root)
    stream = fs.open(at(f"{root}/{MANIFESTS}/v{version:012d}.json"))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, root: str, content: dict) -> int:
    """Make ``content`` the next version: written aside, then renamed into place."""
    root = root.rstrip("/")
    version = content["version"] + 1
    fs, at = _files(spark, root)
    place, aside = at(f"{root}/{MANIFESTS}/v{version:012d}.json"), at(f"{root}/{MANIFESTS}/_{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps({**content, "version": version}, sort_keys=True).encode()))
    out.close()
    if fs.exists(place) or not fs.rename(aside, place):
        fs.delete(aside, False)
        raise RuntimeError(f"version {version} of {root} was committed by another writer")
    return version


def _fresh(root: str, kind: str) -> str:
    return f"{root.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- replaceable tables
def publish(df: DataFrame, root: str) -> int:
    """Write ``df`` to a folder of its own and make it the current version of ``root``."""
    folder = _fresh(root, "base")
    df.write.parquet(folder)
    spark = df.sparkSession
    return commit(spark, root, {**manifest(spark, root), "base": folder, "index": None, "epochs": {}})


def current(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The current (or named) version of a published table; a plain Parquet folder as it is."""
    if not versions(spark, root):
        return spark.read.parquet(root)
    return spark.read.parquet(manifest(spark, root, version)["base"])


# ---------------------------------------------------------------- keyed table
class KeyedTable:
    """One row per key, as keyed upserts leave it.

    The first row of a key (by ``order``) wins every column but ``update``, which come
    from its last row: insert, then on conflict update only those. Folded rows carry the
    place of their first and last row, so folds combine in any order and a replayed
    epoch, which replaces its own folders, changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "sid", order: Sequence[str] = ("date", "lanes"),
                 update: Sequence[str] = ("current",), files: int = 8, keep_versions: int = 2):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.order, self.update, self.files, self.keep_versions = list(order), list(update), files, keep_versions

    def _merged(self, folded: DataFrame) -> DataFrame:
        cols = [c for c in folded.columns if c not in (self.key, FIRST, LAST)]
        firsts, lasts = [c for c in cols if c not in self.update], [c for c in cols if c in self.update]
        out = folded.groupBy(self.key).agg(
            F.min_by(F.struct(*firsts), FIRST).alias("_f"), F.max_by(F.struct(*lasts), LAST).alias("_l"), F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST))
        return out.select(self.key, *[F.col(f"_f.{c}" if c in firsts else f"_l.{c}").alias(c) for c in cols], FIRST, LAST)

    def fold(self, rows: DataFrame) -> DataFrame:
        seq = F.struct(*self.order)
        return self._merged(rows.withColumns({FIRST: seq, LAST: seq}))

    def _clustered(self, folded: DataFrame):
        return (folded.sortWithinPartitions(self.key).write.option(f"parquet.bloom.filter.enabled#{self.key}", "true")
                .option("parquet.block.size", str(16 << 20)))

    def upsert(self, rows: DataFrame, epoch: int, beside: Mapping[str, DataFrame] | None = None, after=None) -> int:
        """Fold ``rows`` into the table as ``epoch``, with the tables ``beside`` (rejects,
        counts); all of it becomes visible at once. ``after`` may give further tables once
        the rows are written (counts observed while they were)."""
        folders = {"rows": _fresh(self.root, f"epoch-{epoch}")}
        self._clustered(self.fold(rows)).parquet(folders["rows"])
        tables = dict(beside or {})
        for name in list(tables):
            folders[name] = _fresh(self.root, f"{name}-{epoch}")
            tables[name].write.parquet(folders[name])
        for name, df in (after() if after else {}).items():
            folders[name] = _fresh(self.root, f"{name}-{epoch}")
            df.write.parquet(folders[name])
        state = manifest(self.spark, self.root)
        return commit(self.spark, self.root, {**state, "epochs": {**state["epochs"], str(epoch): folders}})

    def _folded(self, state: dict) -> DataFrame | None:
        """Base and epochs unmerged; epochs that a base holds already keep their side tables only."""
        folders = [e["rows"] for e in state["epochs"].values() if "rows" in e]
        folders = ([state["base"]] if state["base"] else []) + folders
        return self.spark.read.parquet(*folders) if folders else None

    def read(self, version: int | None = None) -> DataFrame:
        folded = self._folded(manifest(self.spark, self.root, version))
        if folded is None:
            raise FileNotFoundError(f"{self.root} has no version yet")
        return self._merged(folded).drop(FIRST, LAST)

    def beside(self, name: str) -> DataFrame:
        """All rows of a side table, with their ``epoch``."""
        parts = [self.spark.read.parquet(e[name]).withColumn("epoch", F.lit(int(k)).cast("long"))
                 for k, e in sorted(manifest(self.spark, self.root)["epochs"].items(), key=lambda kv: int(kv[0])) if name in e]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def lookup(self, keys: Sequence[str]) -> DataFrame:
        """The rows of a short list of keys. Of the base only files whose key range holds
        one of them are read, of those and the epochs' only row groups whose statistics
        and Bloom filters let a key pass."""
        state = manifest(self.spark, self.root)
        folders = [e["rows"] for e in state["epochs"].values() if "rows" in e]
        if state["base"] and state["index"]:
            wanted = F.exists(F.array(*[F.lit(k) for k in keys]), lambda k: k.between(F.col("low"), F.col("high")))
            names = [r.file for r in self.spark.read.parquet(state["index"]).where(wanted).select("file").collect()]
            folders = [f"{state['base']}/{n}" for n in names] + folders
        elif state["base"]:
            folders = [state["base"], *folders]
        if not folders:
            return self.read().limit(0)
        return self._merged(self.spark.read.parquet(*folders).where(F.col(self.key).isin(list(keys)))).drop(FIRST, LAST)

    def compact(self) -> int:
        """Merge base and epochs into a new key-clustered base, then drop folders and
        manifests that the last ``keep_versions`` versions don't name."""
        state = manifest(self.spark, self.root)
        folded = self._folded(state)
        if folded is None:
            return state["version"]
        base, index = _fresh(self.root, "base"), _fresh(self.root, "index")
        self._clustered(self._merged(folded).repartitionByRange(self.files, self.key)).parquet(base)
        (self.spark.read.parquet(base).groupBy(F.col("_metadata.file_name").alias("file"))
         .agg(F.min(self.key).alias("low"), F.max(self.key).alias("high")).coalesce(1).write.parquet(index))
        sides = {e: {n: f for n, f in folders.items() if n != "rows"} for e, folders in state["epochs"].items()}
        version = commit(self.spark, self.root, {**state, "base": base, "index": index, "epochs": {e: f for e, f in sides.items() if f}})
        self._trim()
        return version

    def _trim(self) -> None:
        found = versions(self.spark, self.root)
        kept = found[-self.keep_versions:]
        named = {f.rsplit("/", 1)[-1] for v in kept for f in _folders(manifest(self.spark, self.root, v))}
        fs, at = _files(self.spark, self.root)
        for v in found[:-self.keep_versions]:
            fs.delete(at(f"{self.root}/{MANIFESTS}/v{v:012d}.json"), False)
        for status in fs.listStatus(at(self.root)):
            name = status.getPath().getName()
            if name != MANIFESTS and name not in named:
                fs.delete(status.getPath(), True)


def _folders(state: dict) -> list[str]:
    return [f for f in (state["base"], state["index"]) if f] + [f for e in state["epochs"].values() for f in e.values()]
