"""Shared helpers: intermediate tables, Arrow text access, word hashing, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

MASK = (1 << 64) - 1
_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)


def table(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back: cuts the
    lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(df: DataFrame, column: str = "text"):
    return F.coalesce(df[column].cast("string"), F.lit(""))


def bucket_mod(column, modulus: int):
    """crc32 of the value's text, modulo ``modulus`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def bytes_of(df: DataFrame, column: str = "text") -> int:
    """Total UTF-8 bytes of a text column, for sizing buckets."""
    return int(df.agg(F.sum(F.octet_length(df[column].cast("string")))).first()[0] or 0)


# ---------------------------------------------------------------- Arrow text


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64, count=column.offset + n + 1)[column.offset:]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    raw = np.frombuffer(data, np.uint8, count=int(offsets[-1]))[int(offsets[0]):]
    return raw, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches into row ranges of at most ``limit`` text bytes (a longer
    text stays whole and comes alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = utf8(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """One table per run of equal keys in rows sorted by ``key``; a run may go on
    over several batches."""
    open_: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if open_ and (i or open_[0].column(b.schema.get_field_index(key))[0].as_py() != k[0]):
                yield pa.Table.from_batches(open_)
                open_ = []
            open_.append(b.slice(i, j - i))
    if open_:
        yield pa.Table.from_batches(open_)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: Everything in ASCII but letters and digits separates words.
_NON_WORD = np.ones(256, bool)
_NON_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64)
_SEGMENT = 1 << 20
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _powers or len(_powers["p"]) < n:
        size = max(_SEGMENT, 1 << (n - 1).bit_length())
        for key, base in (("p", _MULT), ("i", _INV)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[key] = np.cumprod(x, dtype=np.uint64)
    return _powers["p"], _powers["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ordered hash of two hash columns."""
    return mix(a * np.uint64(_MULT) + (b ^ np.uint64(0xD6E8FEB86659FD93)))


def word_spans(raw: np.ndarray, offsets: np.ndarray, letters_only: bool = False):
    """Byte spans of the words of every text and the text index of each word."""
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~(_NON_WORD if letters_only else _SPACE)[raw]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, A-Z folded to a-z; memory stays at about
    30 bytes per byte of one segment (a longer word is a segment of its own)."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        end = max(int(np.searchsorted(ends, base + _SEGMENT, side="right")), at + 1)
        part = _LOWER[raw[base:int(ends[end - 1])]]
        p, inv = _power(len(part))
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_VALUES[part] * p[:len(part)], out=sums[1:])
        s, e = starts[at:end] - base, ends[at:end] - base
        out[at:end] = mix((sums[e] - sums[s]) * inv[s] + (e - s).astype(np.uint64))
        at = end
    return out


def words_of(column: pa.Array, letters_only: bool = False):
    """(hash of each word, text index of each word, words per text)."""
    raw, off = utf8(column)
    s, e, doc = word_spans(raw, off, letters_only)
    return hash_spans(raw, s, e), doc, np.bincount(doc, minlength=len(off) - 1)


def one_hash(text: str) -> int:
    b = np.frombuffer(text.encode(), np.uint8)
    return int(hash_spans(b, np.array([0]), np.array([len(b)]))[0])


# ---------------------------------------------------------------- sieve

#: Bits of a sieve (8 MB): so much goes to every task, however many ids there are.
SIEVE_BITS = 1 << 26


def sieved(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``df`` without most of the rows whose ``key`` isn't in ``wanted``.

    A bitmap of hashed keys, in rows of 32768 bits, is broadcast: rows without
    their bit can't join with ``wanted``. Others may not either, so the join
    follows; with many keys the sieve only lets more rows pass.
    """
    place = F.pmod(F.xxhash64(key), F.lit(SIEVE_BITS)) + 1
    bits = (wanted.select(F.bitmap_bucket_number(place).alias("_row"), F.bitmap_bit_position(place).alias("_at"))
            .repartition("_row").groupBy("_row").agg(F.bitmap_construct_agg("_at").alias("_bits")))
    at = F.bitmap_bit_position(place)
    byte = F.substring("_bits", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))
    hit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1
    return df.withColumn("_row", F.bitmap_bucket_number(place)).join(F.broadcast(bits), "_row").where(hit).select(df.columns)


# ---------------------------------------------------------------- components


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) for every end of ``edges(a, b)``; the component is the
    smallest id reachable.

    Contraction: every vertex points to its smallest neighbour, pointers are
    followed twice, both ends of all edges move along, loops and repeats go.
    Each round's pointers are a written table, so that joins read two plain
    exchanges, which adaptive execution can split at a hot vertex.
    """
    e = table(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
              .where("a <> b").distinct(), f"{name}-edges")
    labels = None
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        p = table(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                  .select("id", F.least("id", "m").alias("up")), f"{name}-up")
        up = p.select(F.col("id").alias("up"), F.col("up").alias("up2"))
        for _ in range(2):
            p = table(p.join(up, "up").select("id", F.col("up2").alias("up")), f"{name}-up")
            up = p.select(F.col("id").alias("up"), F.col("up").alias("up2"))
        if labels is None:
            labels = p.select("id", F.col("up").alias("component"))
        else:
            labels = table(labels.join(p.select(F.col("id").alias("component"), "up"), "component", "left")
                           .select("id", F.coalesce("up", "component").alias("component")), f"{name}-labels")
        pa_, pb = (p.select(F.col("id").alias(c), F.col("up").alias(f"{c}2")) for c in "ab")
        e = table(e.join(pa_, "a").select("a2", "b").join(pb, "b")
                  .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
                  .where("a <> b").distinct(), f"{name}-edges")
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).limit(0)
    return labels


def marked(df: DataFrame, wanted: DataFrame, keys: list[str], out: str) -> DataFrame:
    """``df`` with a flag ``out``: false says that no row of ``wanted`` has the same
    ``keys``, true that one probably has (the bitmap of ``sieved``, kept as a column)."""
    place = F.pmod(F.xxhash64(*keys), F.lit(SIEVE_BITS)) + 1
    bits = (wanted.select(F.bitmap_bucket_number(place).alias("_row"), F.bitmap_bit_position(place).alias("_at"))
            .repartition("_row").groupBy("_row").agg(F.bitmap_construct_agg("_at").alias("_bits")))
    at = F.bitmap_bit_position(place)
    byte = F.substring("_bits", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))
    hit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1
    return (df.withColumn("_row", F.bitmap_bucket_number(place)).join(F.broadcast(bits), "_row", "left")
            .select(*df.columns, F.coalesce(hit, F.lit(False)).alias(out)))


#: A group is hot with more than one in so many of all rows; so many groups are hot at most.
HOT_GROUPS = 1000


def with_group(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left join of every row to the one row of its group.

    Groups with over ``total / HOT_GROUPS`` rows (so ``HOT_GROUPS`` of them at most)
    are broadcast; the others are shuffled with the rest of the rows, of which no
    key holds more than that share. A null key is a group like any other.
    """
    k, mine = f"_{key}", [F.col(c).alias(f"_{c}") for c in groups.columns]
    hot = F.broadcast(groups.where(F.col(size) * HOT_GROUPS > total).select(*mine))
    cold = groups.where(F.col(size) * HOT_GROUPS <= total).select(*mine).hint("merge")
    rest = [c for c in groups.columns if c != key]
    found = [F.col(f"_{c}").alias(c) for c in rest]
    first = rows.join(hot, rows[key].eqNullSafe(F.col(k)), "left")
    done = first.where(F.col(f"_{size}").isNotNull()).select(*rows.columns, *found)
    left = first.where(F.col(f"_{size}").isNull()).select(*rows.columns)
    return done.unionByName(left.join(cold, left[key].eqNullSafe(F.col(k)), "left").select(*rows.columns, *found))
