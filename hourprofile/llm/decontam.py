"""Benchmark decontamination by rare n-gram seeds and Smith-Waterman alignment.

A text holds a test item, edited or not, if the best local alignment of their words
scores ``THRESHOLD`` or more of the item's score against itself. All such texts are found:

* Seeds. An alignment that good of an item of n words has n (1 - MATCH + THRESHOLD MATCH) - 1
  pairs of neighbouring words (0.2 n - 1) that stand side by side in the text too: each word
  that is changed, put in or left out parts one pair at most, and the score allows only so
  many. Items too short for that (``PAIR_WORDS``) share ``THRESHOLD`` n single words. So
  if t of an item's seeds must be found, its t - 1 most frequent ones can be left out: one
  of the others is always among them. How frequent they are is counted over all texts
  first, so the seeds that join texts to items are the rare ones.
* Candidates. Each seed found says where the item would begin. Around that place
  (``_reach``) the words that the item has too are counted: fewer than ``THRESHOLD`` of
  the item's can't reach the threshold, whatever their order.
* Alignment of what is left, word by word, inside the span looked at.

Items are a query set that goes to the workers in blocks of at most
``BLOCK_BYTES`` of text, one pass each, whatever their number. Words are
runs of letters and digits, A-Z folded; all other ASCII separates.

Cases: null, empty or wordless items match nothing; null and empty texts hold
nothing; repeated rows are reported each; an empty table gives no rows; other columns pass through ``without``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, slices, words_of

MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.6
#: From so many words on, some pair of an item's words survives in every copy.
PAIR_WORDS = int(1 / (1 - MATCH + THRESHOLD * MATCH) + 1e-9) + 1
BLOCK_BYTES = 8 << 20
_FILTER_BITS = 22
#: Places, and words around them, that are held at a time.
_PLACES, _AROUND = 1 << 20, 1 << 22


def seeds_of(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(m, n, np.uint64)
    for j in range(n):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[j:m + j])
    return h


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word sequences, and the first word of the
    text at which an alignment with this score ends."""
    j = np.arange(len(text) + 1) * -GAP
    row, best, end = np.zeros(len(text) + 1, np.int64), 0, 0
    for w in item:
        step = np.zeros_like(row)
        step[1:] = row[:-1] + np.where(text == w, MATCH, MISMATCH)
        np.maximum(step, row + GAP, out=step)
        np.maximum(step, 0, out=step)
        row = np.maximum.accumulate(step + j) - j
        at = int(row.argmax())
        if (-row[at], at) < (-best, end):
            best, end = int(row[at]), at
    return best, end - 1


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of the ranges of ``counts`` from ``starts``, one after the other."""
    return np.arange(int(counts.sum())) + np.repeat(starts - np.cumsum(counts) + counts, counts)


class Items:
    """One block of test items with their seeds: all of them, or with ``counts`` (how often
    each of ``seeds`` stands in the texts) those that every copy has one of."""

    def __init__(self, ids: list, texts: list[str], counts: np.ndarray | None = None):
        h, _, per = words_of(pa.array(texts, pa.string()), letters_only=True)
        ends = np.cumsum(per)
        kept = [(i, h[e - n:e]) for i, n, e in zip(ids, per, ends, strict=True) if n]
        self.ids, self.words = [i for i, _ in kept], [w for _, w in kept]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        long = self.sizes >= PAIR_WORDS
        self.lengths = sorted({1 + int(x) for x in long})
        seeds = [seeds_of(w, 1 + int(x)) for w, x in zip(self.words, long, strict=True)]
        n = np.array([len(x) for x in seeds], np.int64)
        self.seeds, index = np.unique(np.concatenate([np.zeros(0, np.uint64), *seeds]), return_inverse=True)
        item, place = np.repeat(np.arange(len(kept)), n), _ranges(np.zeros(len(kept), np.int64), n)
        if counts is not None:
            must = np.where(long, self.sizes * (1 - MATCH + THRESHOLD * MATCH) - 1, THRESHOLD * self.sizes)
            spare = np.maximum(np.ceil(must - 1e-9), 1).astype(np.int64) - 1
            order = np.lexsort((-counts[index], item))  # the most frequent of each item first
            rank = np.empty(len(index), np.int64)
            rank[order] = place  # both run through the items in turn
            rare = rank >= spare[item]
            index, item, place = index[rare], item[rare], place[rare]
        # (seed, item) of every place, ascending, and the place
        key = index * len(kept) + item
        order = np.argsort(key, kind="stable")
        self.key, self.place = key[order], place[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.seeds[np.unique(index)] >> np.uint64(64 - _FILTER_BITS)] = True
        self.own = np.zeros(1 << _FILTER_BITS, bool)
        for k, w in enumerate(self.words):
            self.own[self._slot(np.full(len(w), k), w)] = True

    def counted(self, column: pa.Array) -> np.ndarray:
        """How often each seed stands in the texts."""
        h, doc, _ = words_of(column, letters_only=True)
        total = np.zeros(len(self.seeds), np.int64)
        for _, k in self.found(h, doc):
            total += np.bincount(k, minlength=len(total))
        return total

    @staticmethod
    def _slot(item: np.ndarray, words: np.ndarray) -> np.ndarray:
        return mix(words + item.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _FILTER_BITS)

    def _reach(self, item: np.ndarray) -> np.ndarray:
        """Words that an alignment at the threshold can have more than the item."""
        return (MATCH * (1 - THRESHOLD) / -GAP * self.sizes[item] + 1e-9).astype(np.int64)

    def _need(self, item):
        """Words that an alignment at the threshold has in common with the item."""
        return np.ceil(THRESHOLD * self.sizes[item] - 1e-9)

    def found(self, h: np.ndarray, doc: np.ndarray):
        """(word position in the block, index of the seed) of every seed occurrence."""
        for n in self.lengths:
            s = seeds_of(h, n)
            at = np.flatnonzero(self.filter[s >> np.uint64(64 - _FILTER_BITS)] & (doc[:len(s)] == doc[n - 1:]))
            k = np.minimum(np.searchsorted(self.seeds, s[at]), len(self.seeds) - 1)
            same = self.seeds[k] == s[at]
            if same.any():
                yield at[same], k[same]

    def places(self, doc: np.ndarray, at: np.ndarray, seed: np.ndarray, low: int = 0, high: int | None = None):
        """(text index, item, where the item would begin), each once and ascending, in
        parts of whole items."""
        high = len(self.ids) if high is None else high
        a, b = (np.searchsorted(self.key, seed * len(self.ids) + x) for x in (low, high))
        if int((b - a).sum()) > _PLACES and high - low > 1:
            for part in ((low, (low + high) // 2), ((low + high) // 2, high)):
                yield from self.places(doc, at, seed, *part)
            return
        p = _ranges(a, b - a)
        at = np.repeat(at, b - a)
        rows = np.stack([doc[at], self.key[p] % len(self.ids), at - self.place[p]])
        rows = rows[:, np.lexsort(rows[::-1])]
        new = np.ones(rows.shape[1], bool)
        new[1:] = (rows[:, 1:] != rows[:, :-1]).any(0)
        yield rows[:, new]

    def spans(self, rows: np.ndarray, first: np.ndarray):
        """Of each place the words [low, high) around it, and the number of the run of
        overlapping spans of the same text and item it is in."""
        d, k, begin = rows
        reach = self._reach(k)
        low = np.maximum(first[d], begin - reach)
        high = np.minimum(first[d + 1], begin + self.sizes[k] + reach)
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1]) | (low[1:] > high[:-1])
        return low, high, np.cumsum(new) - 1, np.flatnonzero(new)

    def likely(self, rows: np.ndarray, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The places with enough of the item's words around."""
        if not rows.shape[1]:
            return rows
        low, high, run, begins = self.spans(rows, first)
        start, size = low[begins], np.maximum.reduceat(high, begins) - low[begins]
        keep = np.zeros(rows.shape[1], bool)
        total, at = np.cumsum(size), 0
        while at < len(begins):
            end = max(int(np.searchsorted(total, total[at] - size[at] + _AROUND, side="right")), at + 1)
            n = size[at:end]
            has = self.own[self._slot(np.repeat(rows[1, begins[at:end]], n), h[_ranges(start[at:end], n)])]
            sums = np.concatenate([[0], np.cumsum(has)])
            own = slice(begins[at], begins[end] if end < len(begins) else None)
            shift = (np.cumsum(n) - n - start[at:end])[run[own] - at]
            keep[own] = sums[high[own] + shift] - sums[low[own] + shift] >= self._need(rows[1, own])
            at = end
        return rows[:, keep]

    def matches(self, column: pa.Array) -> list[tuple]:
        """(text index, item id, similarity, first word, last word, places) of every text that holds an item."""
        h, doc, per = words_of(column, letters_only=True)
        first = np.concatenate([[0], np.cumsum(per)])
        out: dict[tuple[int, int], tuple] = {}
        count: dict[tuple[int, int], int] = {}
        for at, seed in self.found(h, doc):
            for rows in self.places(doc, at, seed):
                rows = self.likely(rows, h, first)
                if not rows.shape[1]:
                    continue
                low, high, run, begins = self.spans(rows, first)
                for (d, k), n, i, j in zip(rows[:2, begins].T.tolist(), np.bincount(run).tolist(), low[begins].tolist(),
                                           np.maximum.reduceat(high, begins).tolist(), strict=True):
                    item, text = self.words[k], h[i:j]
                    count[d, k] = count.get((d, k), 0) + n
                    if np.isin(item, text).sum() < self._need(k):
                        continue
                    score, last = align(item, text)
                    if score >= THRESHOLD * MATCH * len(item) - 1e-9 and score > out.get((d, k), (0,))[0]:
                        _, back = align(item[::-1], text[last::-1])
                        begin = i - int(first[d])
                        out[d, k] = score, begin + last - back, begin + last
        return [(d, self.ids[k], score / (MATCH * len(self.words[k])), a, b, count[d, k])
                for (d, k), (score, a, b) in sorted(out.items())]


def _frequencies(docs: DataFrame, shared, size: int) -> np.ndarray:
    """Occurrences of every seed of a block in all texts: one row a task and seed, summed."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for b in slices(batches, "text", 2 << 20):
            total += shared.value.counted(b.column(0))
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["seed", "n"])

    out = np.zeros(size, np.int64)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    for r in texts.mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).collect():  # a block's seeds at most
        out[r.seed] = r.n
    return out


def blocks(docs: DataFrame, items: DataFrame):
    """Blocks of items with their rare seeds, one at a time, as broadcasts."""
    context = docs.sparkSession.sparkContext
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    size = int(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    n = -(-size // BLOCK_BYTES)
    for k in range(n):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        ids, texts = [r.item_id for r in own], [r.text for r in own]
        every = Items(ids, texts)
        shared = context.broadcast(every)
        counts = _frequencies(docs, shared, len(every.seeds))
        shared.destroy()
        yield context.broadcast(Items(ids, texts, counts))


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, first_word, last_word and n_places of every
    text that holds a test item: the aligned words, counted from 0, and the number
    of places at which seeds put the item with enough of its words around."""
    schema = "doc_id long, item_id long, similarity double, first_word long, last_word long, n_places long"
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for shared in blocks(docs, items):

        def run(batches, shared=shared):
            block = shared.value
            for b in slices(batches, "text", 2 << 20):
                rows = block.matches(b.column(1))
                if rows:
                    ids = b.column(0).to_pylist()
                    cols = zip(*[(ids[r[0]], *r[1:]) for r in rows], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], [x.split()[0] for x in schema.split(", ")])

        out = out.unionByName(texts.mapInArrow(run, schema))
    return out


def without(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a test item."""
    text = docs.columns.index("text")
    for shared in blocks(docs, items):

        def run(batches, shared=shared):
            block = shared.value
            for b in slices(batches, "text", 2 << 20):
                keep = np.ones(b.num_rows, bool)
                keep[[r[0] for r in block.matches(b.column(text))]] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
