"""Near-duplicate texts by an inverted join of MinHash signature coordinates.

1. Texts with equal shingle sets are one class; one representative goes on.
2. A class's signature has ``COORDINATES`` minima; every (coordinate, value) is a
   posting list. Values that one class alone has are no lists.
3. Two sets of similarity ``THRESHOLD`` agree in far more than ``MATCHES``
   coordinates (binomial; see ``MISS``), so the rest of a pair's coordinates may be
   skipped: with values in order of rareness, two signatures with ``MATCHES``
   common values share one among the first COORDINATES - MATCHES + 1 of each. Only
   these prefixes are posted, and a class with fewer than MATCHES shared values
   posts nothing.
4. Posting lists aren't expanded into pairs. In each of ``HUB_ROUNDS`` rounds every
   list takes a hub and offers the pairs of the hub with members outside its
   component; their collisions over whole signatures are counted, pairs with
   MATCHES or more are confirmed on the full sets, and links merge components.
   The hub leaves its list, as all its pairs there are settled; lists whose
   members share a component are done.
5. Open lists are then merged by the component that most of their members are in.
   Members outside that component are compared with all, members inside only with
   those outside, in blocks of ``BLOCK``, every two blocks a group of their own. One
   pass counts collisions and keeps the members with a partner of MATCHES or more;
   the next compares these on the full sets, passing over pairs that links found
   there already connect. Only those links leave the task. So every pair of a list
   is either tested or inside one component: no link between components is lost.

Collisions are counted on the low 16 bits of every coordinate, which can only add
candidates; full sets are made of the texts whose collisions call for them, and a
sieve of fixed size spares most other texts the shuffle. Joins with sides that grow
with the input are shuffled at every size (``merge``).

Cases: null, empty and blank texts have no set (n_shingles 0) and link with
nothing; fewer words than ``WORDS`` make one shingle of all; repeated rows are
exact copies; rows with a null doc_id have no component and are never kept;
an empty table gives no rows; rows that repeat a doc_id with
other text are compared by their own text; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, mix, runs, sieved, slices, table, words_of

THRESHOLD = 80  # percent
COORDINATES = 80
#: Of 80 coordinates, a pair at similarity 0.8 agrees in 64 on average; it agrees
#: in fewer than 48 with a probability of about ``MISS``.
MATCHES = 48
MISS = 1e-5
HUB_ROUNDS = 1
BLOCK = 256

_rng = np.random.default_rng(77)
_A = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    h, _, per_doc = words_of(column)
    out, at = [], 0
    for n in per_doc.tolist():
        w = h[at:at + n]
        at += n
        k = min(n, words)
        if not n:
            out.append(np.zeros(0, np.uint64))
            continue
        s = np.full(n - k + 1, k, np.uint64)
        for j in range(k):
            s = mix(s * np.uint64(0x9E3779B97F4A7C15) + w[j:n - k + 1 + j])
        out.append(np.unique(s))
    return out


def signature(values: np.ndarray) -> np.ndarray:
    """COORDINATES minima of a set of hashes."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 2048):
        v = values[at:at + 2048]
        np.minimum(low, (_A[:, None] * v + _B[:, None]).min(1), out=low)
    return low


def _digest(values: np.ndarray) -> bytes | None:
    return hashlib.sha256(values.tobytes()).digest()[:16] if len(values) else None


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set and signature (little-endian
    unsigned 64-bit) of every text, with a row number."""

    def run(batches):
        for b in slices(batches, "text", 1 << 20):
            found = shingle_sets(b.column(1), words)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array(map(_digest, found), pa.binary()),
                 pa.array([signature(s).view(np.int64).tolist() if len(s) else None for s in found], pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "digest", "signature"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, n_shingles long, digest binary, signature array<long>")
            .withColumn("row", F.monotonically_increasing_id()))


def shingles_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(rep, shingles) of the representatives in ``wanted`` (rep, doc_id, digest)."""

    def run(batches):
        for b in slices(batches, "text", 1 << 20):
            found = shingle_sets(b.column(2), words)
            keep = pa.array([_digest(s) == d for s, d in zip(found, b.column(1).to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), pa.array([s.tobytes() for s in found], pa.binary()).filter(keep)], ["rep", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # a doc_id with several texts meets all its digests; only the own one stays
    return sieved(texts, wanted, "doc_id").join(wanted.hint("merge"), "doc_id").select("rep", "digest", "text").mapInArrow(run, "rep long, shingles binary")


def postings(sigs: DataFrame) -> DataFrame:
    """(list, rep): the prefixes of all signatures, in lists of two members or more."""
    every = sigs.select("rep", F.posexplode("signature").alias("c", "v")).select("rep", F.xxhash64("c", "v").alias("list"))
    shared = table(every.groupBy("list").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "minhash-lists")
    mine = Window.partitionBy("rep")
    return (every.join(shared.hint("merge"), "list")
            .select("rep", "list", F.count(F.lit(1)).over(mine).alias("present"), F.row_number().over(mine.orderBy("n", "list")).alias("r"))
            .where((F.col("present") >= MATCHES) & (F.col("r") <= F.col("present") - MATCHES + 1)).select("list", "rep"))


def _colliding(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """The pairs (a, b) of fitting sizes with MATCHES equal coordinates or more."""
    one, two = (sigs.select(F.col("rep").alias(c), F.col("n_shingles").alias(f"n{c}"), F.col("bits").alias(f"s{c}")).hint("merge") for c in "ab")
    hits = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x))
    sized = 100 * F.least("na", "nb") >= THRESHOLD * F.greatest("na", "nb")
    return pairs.join(one, "a").join(two, "b").where(sized).where(hits >= MATCHES).select("a", "b")


def _confirmed(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    one, two = (full.select(F.col("rep").alias(c), F.col("shingles").alias(f"x{c}")).hint("merge") for c in "ab")

    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= THRESHOLD * (len(x) + len(y) - both))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])

    return pairs.join(one, "a").join(two, "b").select("a", "b", "xa", "xb").mapInArrow(run, "a long, b long")


def _partners(rows: pa.Table):
    """(i, members that may be similar to it by size and collisions, most first)
    of every member outside the main component; each pair comes once."""
    comps, sizes = rows.column("comp").to_numpy(), rows.column("n_shingles").to_numpy()
    minor = rows.column("minor").to_numpy()
    sigs = np.array(rows.column("bits").combine_chunks().values).reshape(len(comps), -1)
    for i in np.flatnonzero(minor):
        # members outside the main component come once per pair, the others always
        ok = (comps != comps[i]) & (~minor | (np.arange(len(comps)) > i))
        ok &= 100 * np.minimum(sizes, sizes[i]) >= THRESHOLD * np.maximum(sizes, sizes[i])
        at = np.flatnonzero(ok)
        hits = (sigs[at] == sigs[i]).sum(1)
        yield i, at[hits >= MATCHES][np.argsort(-hits[hits >= MATCHES], kind="stable")]


def _live(rows: pa.Table) -> pa.Table:
    """The members of one group that have a partner in it."""
    live = np.zeros(len(rows), bool)
    for i, found in _partners(rows):
        live[found] = True
        live[i] |= len(found) > 0
    return rows.filter(pa.array(live))


def _group(rows: pa.Table):
    """Links that connect the similar members of one group; each merge is one link."""
    reps, comps, sizes = (rows.column(c).to_numpy() for c in ("rep", "comp", "n_shingles"))
    full = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("shingles")]
    up = {int(c): int(c) for c in comps}

    def root(c: int) -> int:
        while up[c] != c:
            up[c] = c = up[up[c]]
        return c

    for i, found in _partners(rows):
        for j in found:
            a, b = root(int(comps[i])), root(int(comps[j]))
            if a == b:
                continue
            both = len(np.intersect1d(full[i], full[j], assume_unique=True))
            if 100 * both >= THRESHOLD * (sizes[i] + sizes[j] - both):
                up[max(a, b)] = min(a, b)
                yield int(min(reps[i], reps[j])), int(max(reps[i], reps[j]))


def _open_links(mine: DataFrame, sigs: DataFrame, sets: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links between members of a list that are in different components."""
    share = mine.groupBy("list", "comp").agg(F.count(F.lit(1)).alias("n"))
    main = share.groupBy("list").agg(F.max(F.struct(F.col("n"), -F.col("comp"))).alias("m")).select("list", (-F.col("m.col2")).alias("main"))
    members = mine.join(table(main, "minhash-main"), "list").select("main", "rep", "comp").distinct()
    members = table(members.withColumn("minor", F.col("comp") != F.col("main")), "minhash-groups")
    parts = members.groupBy("main").agg(F.ceil(F.sum(F.col("minor").cast("int")) / BLOCK).cast("int").alias("minors"),
                                        F.ceil(F.sum((~F.col("minor")).cast("int")) / BLOCK).cast("int").alias("majors"))
    members = members.join(table(parts.where("minors > 0"), "minhash-parts"), "main")
    # blocks of the main component have negative numbers and only meet the others
    h, outside = F.xxhash64("rep", "main"), F.sequence(F.lit(0), F.col("minors") - 1)
    inside = F.when(F.col("majors") > 0, F.sequence(-F.col("majors"), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    block = F.when(F.col("minor"), F.pmod(h, "minors").cast("int")).otherwise((-1 - F.pmod(h, F.col("majors"))).cast("int"))
    members = members.withColumn("block", block).withColumn("with", F.explode(F.when(F.col("minor"), F.concat(outside, inside)).otherwise(outside)))
    own = members.where("minor or block <> with").withColumn("group", F.xxhash64("main", F.least("block", "with"), F.greatest("block", "with")))
    own = own.select("group", "rep", "comp", "minor").join(sigs.hint("merge"), "rep")

    def partnered(batches):
        for rows in runs(batches, "group"):
            yield from _live(rows).to_batches()

    def linked(batches):
        for rows in runs(batches, "group"):
            found = list(_group(rows))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    live = own.repartition("group").sortWithinPartitions("group").mapInArrow(partnered, own.schema)
    live = table(live, "minhash-live")
    full = sets(live.select("rep").distinct())
    return live.join(full.hint("merge"), "rep").repartition("group").sortWithinPartitions("group").mapInArrow(linked, "a long, b long")


def links(sigs: DataFrame, docs: DataFrame, names: DataFrame, words: int) -> DataFrame | None:
    """Confirmed links (a < b) that connect all near-duplicate representatives."""
    lists = table(postings(sigs), "minhash-postings")
    if lists.isEmpty():
        return None
    few = table(lists.select("rep").distinct(), "minhash-posted")
    bits = F.transform("signature", lambda x: F.shiftright(F.shiftleft(x, 48), 48).cast("short"))
    sigs = table(sigs.select("rep", "n_shingles", bits.alias("bits")).join(few.hint("merge"), "rep"), "minhash-candidates")

    def sets(reps: DataFrame) -> DataFrame:
        wanted = table(names.join(reps, "rep"), "minhash-wanted")
        return table(shingles_of(docs, wanted, words), "minhash-shingles")

    found = labels = None
    for turn in range(HUB_ROUNDS + 1):
        mine = lists.withColumn("comp", F.col("rep"))
        if labels is not None:
            mine = (lists.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
                    .select("list", "rep", F.coalesce("component", "rep").alias("comp")))
        key = F.struct("comp", "rep")
        # first the smallest id is the hub; later one of the component with the largest, not of the one most have joined
        hub = F.min(key) if turn == 0 else F.max(key)
        still = mine.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), hub.alias("h"))
        still = table(still.where("lo < hi").select("list", "n", F.col("h.rep").alias("hub"), F.col("h.comp").alias("hub_comp")), "minhash-open")
        if still.isEmpty():
            break
        mine = table(mine.join(still, "list"), "minhash-members")
        if turn == HUB_ROUNDS:
            return found.unionByName(table(_open_links(mine, sigs, sets), "minhash-links"))
        pairs = mine.where("comp <> hub_comp").select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
        close = table(_colliding(pairs, sigs), "minhash-close")
        new = _confirmed(close, sets(close.select(F.explode(F.array("a", "b")).alias("rep")).distinct()))
        found = table(new if found is None else found.unionByName(new), "minhash-links")
        lists = mine.where("rep <> hub").select("list", "rep")
        labels = components(found, "minhash")
    return found


def classes(docs: DataFrame, words: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``."""
    every = table(sketches(docs, words), "minhash-sketches")
    known = every.where("digest is not null and doc_id is not null")
    first = known.groupBy("digest").agg(F.min(F.struct("doc_id", "row")).alias("f"))
    names = table(first.select("digest", F.col("f.doc_id").alias("doc_id"), F.col("f.row").alias("rep")), "minhash-classes")
    sigs = known.select(F.col("row").alias("rep"), "n_shingles", "signature").join(names.select("rep").hint("merge"), "rep")
    sigs = table(sigs, "minhash-signatures")
    found = links(sigs, docs, names, words)
    of_class = names.select("digest", F.col("doc_id").alias("c"))
    if found is not None:
        # components are of row numbers; their name is the smallest doc_id
        linked = table(components(found, "minhash").withColumnRenamed("id", "rep").join(names, "rep"), "minhash-linked")
        least = table(linked.groupBy("component").agg(F.min("doc_id").alias("least")), "minhash-least")
        linked = linked.join(least, "component").select("digest", "least")
        of_class = of_class.join(linked, "digest", "left").select("digest", F.coalesce("least", "c").alias("c"))
    out = every.select("doc_id", "n_shingles", "digest").join(table(of_class, "minhash-named"), "digest", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("c", "doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
