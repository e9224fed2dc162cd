"""Alignment of two tokenizers over a corpus, counted by external spill counting.

Every text is encoded by a byte-level vocabulary (A) and a sentence-piece vocabulary
(B). Byte offsets where tokens of both end cut them into groups, and every pair of an A
and a B token that share bytes is a link. How often an id pair is linked in the whole
corpus, and whether that is the most for its B id, goes back to the documents.

* Runs. A task takes the texts in blocks of ``BLOCK`` bytes. The links of a block
  become (pair, document, times) records, sorted by B id, A id and document, and are
  cut by radix (the low bits of the B id) into runs of zstd blocks: one column has
  the pairs and their counts, another the documents. They are a written table, so
  a lost executor costs the runs it was making, no more.
* Counting. The runs of a radix are dealt to as many groups as their bytes need
  (``GROUP_BYTES``), so the runs of a frequent id are spread. A group is merged by a heap
  with one open block a run, the least last pair on top: everything up to that
  pair is read from all open blocks and summed. Sums of the groups meet in a shuffle.
* Maxima and contributions. The pair counts come in B-major order, which yields each
  B id's highest count as it passes; each run then meets them once more, in the same
  order, and streams back an array of (links with the highest count, sum of counts)
  per document, one array a run and radix. These are added up by run.

No task holds more than one group of runs, one block per open run, or the pairs of
one radix, of which vocabularies allow so many whatever the size of the corpus.

Cases: null and empty texts, and texts whose joined A or B bytes aren't the text with
one space before (B turns U+2581 into a space), have no tokens: zeros and an empty
groups string. Special strings in texts are plain text. Repeated rows count each.
Long texts are encoded whole; one longer than ``BLOCK`` is a block of its own. An
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import byte_letters, has_long_run, rank_encoding
from .common import slices, table

#: Text bytes of one run, records of one zstd block, radix bits.
BLOCK, RECORDS, RADIX_BITS = 2 << 20, 1 << 16, 3
#: Compressed run bytes that one group of the merge holds.
GROUP_BYTES = 64 << 20
#: Bits of an id of each side and of a document's place in its run; with the radix they fill 63.
_A_BITS, _B_BITS, _DOC_BITS = 17, 28, 15


class Aligner:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, a_path: str, pattern: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(a_path)
        self.library.encode_special_tokens = True
        with open(a_path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        unusual = any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                             "fuse_unk", "byte_fallback", "ignore_merges"))
        self.ranks = None if unusual else rank_encoding(a_path, pattern)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        n = self.library.get_vocab_size()
        tokens = [self.library.id_to_token(i) or "" for i in range(n)]
        self.a_bytes = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in tokens]
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        if max(n, len(self.b_bytes)) >= 1 << _A_BITS:
            raise ValueError("a vocabulary with more ids than a pair holds")
        self.a_len, self.b_len = (np.array([len(t) for t in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        a, b = ([b"%d" % i for i in range(len(side))] for side in (self.a_bytes, self.b_bytes))
        #: How an id is written inside its group, last of its group: 1,2|3,4;
        self.written = [s + end for side, last in ((a, b"|"), (b, b";")) for end in (b",", last) for s in side]

    def a_ids(self, text: str) -> np.ndarray:
        if self.ranks is None or has_long_run(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int64)
        return self.ranks.encode_to_numpy(text, disallowed_special=()).astype(np.int64)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides of every text; empty ones where the bytes differ."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            whole = (" " + text).encode()
            a = self.a_ids(" " + text) if text else none[0]
            same = text and b"".join(map(self.a_bytes.__getitem__, a.tolist())) == whole == b"".join(map(self.b_bytes.__getitem__, b))
            out.append((a, np.array(b, np.int64)) if same else none)
        return out

    def align(self, texts: list[str]):
        """Per text (n_a, n_b, n_groups, n_links, digest) and the links (text, A id, B id) of all.

        The texts are laid end to end: both sides end where a text does, so no
        group or link reaches over.
        """
        ids = self.encode(texts)
        n_a, n_b = (np.array([len(p[side]) for p in ids], np.int64) for side in (0, 1))
        a, b = (np.concatenate([p[side] for p in ids] or [np.zeros(0, np.int64)]) for side in (0, 1))
        if not len(a):
            zero = np.zeros(len(texts), np.int64)
            return (n_a, n_b, zero, zero, [""] * len(texts)), (zero[:0],) * 3
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        cut, seen = np.intersect1d(a_end, b_end, assume_unique=True), np.union1d(a_end, b_end)
        text_end = np.cumsum(np.bincount(np.repeat(np.arange(len(texts)), n_a), self.a_len[a], len(texts)).astype(np.int64))
        n_groups, n_links = (np.diff(np.searchsorted(ends, text_end, side="right"), prepend=0) for ends in (cut, seen))
        # the written form: A tokens of a group, then its B tokens
        a_group, b_group = np.searchsorted(cut, a_end), np.searchsorted(cut, b_end)
        a_upto, b_upto = (np.searchsorted(ends, cut, side="right") for ends in (a_end, b_end))
        form = np.empty(len(a) + len(b), np.int64)
        form[np.arange(len(a)) + np.concatenate([[0], b_upto])[a_group]] = a + np.isin(a_end, cut, assume_unique=True) * len(self.a_bytes)
        form[np.arange(len(b)) + a_upto[b_group]] = 2 * len(self.a_bytes) + b + np.isin(b_end, cut, assume_unique=True) * len(self.b_bytes)
        digests, at = [], 0
        for n in (n_a + n_b).tolist():
            raw = b"".join(map(self.written.__getitem__, form[at:at + n].tolist()))[:-1]
            digests.append(hashlib.sha256(raw).hexdigest() if n else "")
            at += n
        links = np.searchsorted(text_end, seen), a[np.searchsorted(a_end, seen)], b[np.searchsorted(b_end, seen)]
        return (n_a, n_b, n_groups, n_links, digests), links


@lru_cache(maxsize=1)
def load(a_path: str, pattern: str, b_path: str) -> Aligner:
    return Aligner(a_path, pattern, b_path)


# ---------------------------------------------------------------- runs


def _starts(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[len(x) > 0], x[1:] != x[:-1]]))


def spill(doc: np.ndarray, a: np.ndarray, b: np.ndarray):
    """(radix, pair blocks, document blocks) of a block's links, pairs in B-major order.

    A pair is ``b << 17 | a``. A pair block holds pairs, documents per pair and links
    per pair; the document block beside it the documents and their links.
    """
    import zstandard

    press = zstandard.ZstdCompressor(level=1).compress
    if not len(doc):
        return
    radix = b & ((1 << RADIX_BITS) - 1)
    record = np.sort(((radix << _B_BITS | b) << _A_BITS | a) << _DOC_BITS | doc)
    first = _starts(record)
    times = np.diff(np.append(first, len(record)))
    record = record[first]
    pair, docs = record >> _DOC_BITS, (record & ((1 << _DOC_BITS) - 1)).astype(np.uint16)
    radix = pair >> (_B_BITS + _A_BITS)
    pair &= (1 << (_B_BITS + _A_BITS)) - 1
    for lo, hi in zip(s := _starts(radix), [*s[1:], len(radix)], strict=True):
        keys, places = [], []
        heads = lo + _starts(pair[lo:hi])
        cuts = heads[::max(1, RECORDS * len(heads) // (hi - lo))]  # blocks of about RECORDS records, whole pairs
        for i, j in zip(cuts, [*cuts[1:], hi], strict=True):
            own = np.append(heads[np.searchsorted(heads, i):np.searchsorted(heads, j)], j)
            total = np.add.reduceat(times[i:j], own[:-1] - i)
            keys.append(press(b"".join(x.tobytes() for x in (np.diff(pair[own[:-1]], prepend=0), np.diff(own).astype(np.int32), total))))
            places.append(press(docs[i:j].tobytes() + times[i:j].astype(np.int32).tobytes()))
        yield int(radix[lo]), keys, places


def _key_block(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(raw)
    n = len(raw) // 20
    return (np.cumsum(np.frombuffer(raw, np.int64, n)), np.frombuffer(raw, np.int32, n, 8 * n), np.frombuffer(raw, np.int64, n, 12 * n))


def _place_block(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(raw)
    n = len(raw) // 6
    return np.frombuffer(raw, np.uint16, n), np.frombuffer(raw, np.int32, n, 2 * n)


def merge(runs: list[list[bytes]]):
    """Pairs of several runs in order with their links summed, part by part."""
    heap, open_ = [], {}

    def advance(run: int, block: int) -> None:
        if block < len(runs[run]):
            pair, _, links = _key_block(runs[run][block])
            open_[run] = (block, pair, links)
            heapq.heappush(heap, (int(pair[-1]), run))
        else:
            del open_[run]

    for run in range(len(runs)):
        open_[run] = None
        advance(run, 0)
    while heap:
        upto = heap[0][0]
        pairs, links = [], []
        for run, (block, pair, n) in open_.items():
            k = int(np.searchsorted(pair, upto, side="right"))
            if k:
                pairs.append(pair[:k])
                links.append(n[:k])
                open_[run] = (block, pair[k:], n[k:])
        while heap and heap[0][0] == upto:
            run = heapq.heappop(heap)[1]
            advance(run, open_[run][0] + 1)
        pairs, links = np.concatenate(pairs), np.concatenate(links)
        order = np.argsort(pairs, kind="stable")
        first = _starts(pairs[order])
        yield pairs[order][first], np.add.reduceat(links[order], first)


def contributions(keys: list[bytes], places: list[bytes], n_docs: int, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> np.ndarray:
    """(2, n_docs): links with the highest count of their B id, and counts summed over links."""
    out = np.zeros((2, n_docs), np.int64)
    for k, p in zip(keys, places, strict=True):
        pair, n, _ = _key_block(k)
        docs, times = _place_block(p)
        at = np.repeat(np.searchsorted(pairs, pair), n)
        np.add.at(out[0], docs, times * best[at])
        np.add.at(out[1], docs, times * counts[at])
    return out


# ---------------------------------------------------------------- operator

_DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_RUN = "radix int, n_docs int, keys array<binary>, places array<binary>"


def _encoded(docs: DataFrame, a_path: str, pattern: str, b_path: str) -> DataFrame:
    """Rows of documents (radix null) and of runs."""
    names = [c.split()[0] for c in f"run long, at int, {_DOC}, {_RUN}".split(", ")]

    def run(batches):
        aligner = load(a_path, pattern, b_path)
        task, no = TaskContext.get().partitionId(), 0
        for batch in (part for s in slices(batches, "text", BLOCK) for part in (s.slice(k, 1 << _DOC_BITS) for k in range(0, s.num_rows, 1 << _DOC_BITS))):
            n, own = batch.num_rows, task << 32 | no
            no += 1
            (n_a, n_b, n_groups, n_links, digests), links = aligner.align([t or "" for t in batch.column(1).to_pylist()])
            cols = {"run": pa.array([own] * n, pa.int64()), "at": pa.array(range(n), pa.int32()), "doc_id": batch.column(0), "n_a": pa.array(n_a),
                    "n_b": pa.array(n_b), "n_groups": pa.array(n_groups), "n_links": pa.array(n_links), "groups_sha256": pa.array(digests, pa.string()),
                    "radix": pa.nulls(n, pa.int32()), "n_docs": pa.nulls(n, pa.int32()), "keys": pa.nulls(n, pa.list_(pa.binary())),
                    "places": pa.nulls(n, pa.list_(pa.binary()))}
            yield pa.RecordBatch.from_arrays([cols[c] for c in names], names)
            for radix, keys, places in spill(*links):
                row = {"run": own, "radix": radix, "n_docs": n, "keys": keys, "places": places}
                yield pa.RecordBatch.from_arrays([pa.array([row.get(c)], cols[c].type) for c in names], names)

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return table(texts.mapInArrow(run, f"run long, at int, {_DOC}, {_RUN}"), "align-runs", "snappy")


def _counted(group: pa.Table) -> pa.Table:
    found = list(merge(group["keys"].to_pylist()))
    pairs, links = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    return pa.table({"radix": pa.array(np.full(len(pairs), group["radix"][0].as_py(), np.int32)), "pair": pairs, "links": links})


def _streamed(runs: pa.Table, counted: pa.Table) -> pa.Table:
    pairs, counts = (counted[c].to_numpy() for c in ("pair", "links"))
    order = np.argsort(pairs)
    pairs, counts = pairs[order], counts[order]
    b = pairs >> _A_BITS
    first = _starts(b)
    best = (counts == np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(b))))).astype(np.int64) if len(b) else counts
    out = [contributions(r["keys"], r["places"], r["n_docs"], pairs, counts, best).tobytes() for r in
           (row for k in range(runs.num_rows) for row in runs.slice(k, 1).to_pylist())]
    return pa.table({"run": runs["run"], "added": pa.array(out, pa.binary())})


def _added(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.int64).reshape(2, -1) for x in group["added"])
    n = total.shape[1]
    return pa.table({"run": pa.array([group["run"][0].as_py()] * n, pa.int64()), "at": pa.array(range(n), pa.int32()),
                     "n_best": total[0], "count_sum": total[1]})


def align(docs: DataFrame, a_path: str, pattern: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256 of every document, and a_id, b_id, links of every linked id pair."""
    spark = docs.sparkSession
    rows = _encoded(docs, a_path, pattern, b_path)
    size = F.expr("aggregate(keys, 0L, (s, x) -> s + octet_length(x)) + aggregate(places, 0L, (s, x) -> s + octet_length(x))")
    runs = rows.where("radix is not null").select("run", "radix", "n_docs", "keys", "places")
    # at most 2^RADIX_BITS numbers: the groups that each radix is dealt to
    groups = {r.radix: max(1, -(-r.bytes // GROUP_BYTES)) for r in runs.groupBy("radix").agg(F.sum(size).alias("bytes")).collect()}
    dealt = F.create_map(*[F.lit(x) for kv in groups.items() for x in kv]) if groups else F.create_map(F.lit(0), F.lit(1))
    runs = runs.withColumn("part", F.pmod(F.xxhash64("run"), dealt[F.col("radix")]))

    partial = runs.select("radix", "part", "keys").groupBy("radix", "part").applyInArrow(_counted, "radix int, pair long, links long")
    pairs = table(partial.groupBy("radix", "pair").agg(F.sum("links").alias("links")), "align-pairs")

    parts = spark.createDataFrame([(r, k) for r, n in groups.items() for k in range(n)], "radix int, part long")
    spread = pairs.join(F.broadcast(parts), "radix").select("radix", "part", "pair", "links")
    added = (runs.groupBy("radix", "part").cogroup(spread.groupBy("radix", "part"))
             .applyInArrow(lambda left, right: _streamed(left, right), "run long, added binary"))
    sums = (table(added, "align-added", "zstd").groupBy("run").applyInArrow(_added, "run long, at int, n_best long, count_sum long"))
    own = rows.where("radix is null").select("run", "at", *[c.split()[0] for c in _DOC.split(", ")])
    out = own.join(sums, ["run", "at"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")
    return out, pairs.select((F.col("pair") % (1 << _A_BITS)).alias("a_id"), F.shiftright("pair", _A_BITS).alias("b_id"), "links")
