"""Language identification by prediction by partial matching over bytes.

Per language, a variable-order context tree over the last ``ORDER`` bytes (A-Z read
as a-z, a start symbol ahead of the text) holds frozen counts from a bounded sample of
labelled texts. A byte's probability is found by escape (method C): seen in the longest
known context, it has count / (total + distinct); otherwise distinct / (total + distinct)
passes to the next shorter context, down to a uniform distribution over the 256 bytes. The
language with the shortest exact code length wins.

The trees are sparse and made one language per task, so any number of languages
can be learned; each has at most ``TREE_GRAMS`` entries an order, contexts with the fewest
sightings go first. Only finished trees come to the driver and are broadcast.

The score is the winner's share under equal priors once the bits by which the others
are longer are weighted with ``a * n ** b / n`` for a text of n bytes. a and b are those with the
least log loss on every fifth text of the sample, which the trees don't learn from: cut into pieces
of 6 to 512 bytes. So the score tells how often the winner is right on texts in one
language; short texts score lower, and mixed ones, where the languages' bits are closer.

Cases: a null text, or one without letters, is ``und`` with score 0; ties go to
the first language in order; with no labelled rows every text is ``und``; null
langs aren't learned from; repeated rows are scored each; very long texts are read
whole, a million bytes at a time; other columns are not read.
"""

from __future__ import annotations

import pickle
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bucket_mod, slices, table, utf8

#: Labelled texts per language that the trees and the score are fitted on, the ones with the smallest hashes.
SAMPLE_TEXTS = 400
#: One text in so many of the sample is kept for the score.
FOLD = 5
#: Longest context, in bytes; contexts of two and more bytes need ``MIN_CONTEXT`` sightings.
ORDER, MIN_CONTEXT = 3, 4
#: Entries of a language's tree per order (12 bytes each).
TREE_GRAMS = 60_000
HELD_OUT = (4, 2)
#: Weights (a, b) that are tried for the score, and the ones taken where no text is kept for it.
WEIGHTS = [(a, b) for b in (0.2, 0.35, 0.5, 0.65, 0.8, 1.0) for a in (0.1, 0.2, 0.35, 0.5, 0.75, 1.0, 1.5, 2.5)]
DEFAULT_WEIGHT = (0.5, 0.65)
#: Bytes of the pieces that the score is fitted on.
PIECES = (6, 8, 12, 16, 24, 32, 64, 128, 512)
#: Share of pieces whose label is taken to be of no use (texts in several languages, codes, numbers);
#: of 0 to 0.02 the one with the least squared error on held-out pieces of 6 to 200 characters.
LAPSES = 0.01
START, SYMBOLS = 256, 257
_SEGMENT = 1 << 20
_FOLDED = np.arange(256, dtype=np.int64)
_FOLDED[65:91] += 32
_LETTER = re.compile(r"[^\W\d_]")


def sample(docs: DataFrame, size: int = SAMPLE_TEXTS, held_out: tuple[int, int] = HELD_OUT) -> DataFrame:
    """(doc_id, lang, kept_out, text) of at most ``size`` labelled texts per language (ids ranked
    without their texts, in salted groups first, so that a frequent language is no single group)."""
    ids = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (bucket_mod(F.col("doc_id"), held_out[0]) != held_out[1]))
           .select(F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", F.lit(7)).alias("h")))
    ids = ids.withColumn("salt", F.pmod("h", F.lit(64)))
    for keys in (["lang", "salt"], ["lang"]):
        ids = ids.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy("h", "doc_id"))).where(F.col("r") <= size)
    ids = ids.groupBy("doc_id", "lang").agg((F.min("r") % FOLD == 0).alias("kept_out"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    # at most `size` ids per language
    return texts.join(F.broadcast(ids), ["doc_id", "lang"])


def codes_of(raw: np.ndarray, offsets: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """For the positions from ``first`` to ``last``: the byte and the ``ORDER`` symbols before it as
    one number in base ``SYMBOLS``; its remainder by SYMBOLS ** (n + 1) has the context of n bytes."""
    last = len(raw) if last is None else last
    at = np.arange(first, last)
    inside = at - offsets[np.searchsorted(offsets, at, side="right") - 1]
    code = _FOLDED[raw[first:last]]
    for back in range(1, ORDER + 1):
        before = np.where(inside >= back, _FOLDED[raw[np.maximum(at - back, 0)]], START)
        code = code + before * SYMBOLS ** back
    return code


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Tree:
    """One language's frozen statistics: per order the sorted grams (context and byte) with their
    bits, and the sorted contexts with the bits of an escape."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, most: int = TREE_GRAMS):
        self.orders = []
        for order in range(ORDER + 1):
            grams, at = np.unique(codes % SYMBOLS ** (order + 1), return_inverse=True)
            n = np.bincount(at, weights=counts, minlength=len(grams))
            contexts, at = np.unique(grams // SYMBOLS, return_inverse=True)
            total, distinct = np.bincount(at, weights=n), np.bincount(at)
            least = MIN_CONTEXT if order > 1 else 1
            by_total = np.argsort(-total, kind="stable")
            over = np.flatnonzero(np.cumsum(distinct[by_total]) > most)
            if len(over) and order:  # order 0 has 256 grams at most
                least = max(least, total[by_total[over[0]]] + 1)
            held = total >= least
            own = held[at]
            bits = -np.log2(n / (total + distinct)[at])[own]
            escape = -np.log2(distinct / (total + distinct))[held]
            self.orders.append((grams[own], bits.astype(np.float32), contexts[held], escape.astype(np.float32)))

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """Exact code length of the byte of each code after its context."""
        out = np.zeros(len(codes))
        left = np.arange(len(codes))
        for order in range(ORDER, -1, -1):
            grams, bits, contexts, escape = self.orders[order]
            own = codes[left] % SYMBOLS ** (order + 1)
            at, hit = _find(grams, own)
            out[left[hit]] += bits[at[hit]]
            left, own = left[~hit], own[~hit]
            at, hit = _find(contexts, own // SYMBOLS)
            out[left[hit]] += escape[at[hit]]
        out[left] += 8.0
        return out


class ContextTrees:
    """The trees of all languages and the weight of the score."""

    def __init__(self, trees: dict[str, Tree], weight: tuple[float, float] = DEFAULT_WEIGHT):
        self.languages = sorted(trees)
        self.trees, self.weight = [trees[x] for x in self.languages], weight

    def code_lengths(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every text under every language; each distinct code of a segment is looked up once."""
        out = np.zeros((len(offsets) - 1, len(self.trees)))
        for first in range(0, len(raw), _SEGMENT):
            last = min(first + _SEGMENT, len(raw))
            codes, place = np.unique(codes_of(raw, offsets, first, last), return_inverse=True)
            low = int(np.searchsorted(offsets, first, side="right")) - 1
            high = int(np.searchsorted(offsets, last, side="left"))
            # a text's part of the segment; empty texts have none
            starts = np.maximum(offsets[low:high], first)
            full = np.flatnonzero(np.minimum(offsets[low + 1:high + 1], last) > starts)
            for j, tree in enumerate(self.trees):
                out[low + full, j] += np.add.reduceat(tree.bits(codes)[place], starts[full] - first)
        return out

    def shares(self, bits: np.ndarray, lengths: np.ndarray, weight: tuple[float, float] | None = None) -> np.ndarray:
        a, b = weight or self.weight
        n = np.maximum(lengths, 1).astype(float)
        e = np.exp2(-(bits - bits.min(1, keepdims=True)) * (a * n ** (b - 1))[:, None])
        return e / e.sum(1, keepdims=True)


def _pieces(texts: list[bytes], langs: list[int]):
    """(bytes, language) that the score is fitted on."""
    for raw, lang in zip(texts, langs, strict=True):
        for j, size in enumerate(PIECES):
            at = j * len(raw) // len(PIECES)
            if raw[at:at + size]:
                yield raw[at:at + size], lang


def fit(docs: DataFrame, size: int = SAMPLE_TEXTS, held_out: tuple[int, int] = HELD_OUT) -> ContextTrees | None:
    """Trees and weight from the labelled sample; Spark sums the counts and makes the trees."""
    texts = table(sample(docs, size, held_out).repartition("doc_id"), "langid-sample")

    def gram_counts(batches):
        for b in slices(batches, "text", 1 << 20):
            langs = np.array(b.column(1).to_pylist(), object)
            raw, off = utf8(b.column(0))
            code, lang_at = codes_of(raw, off), np.repeat(langs, np.diff(off))
            for lang in sorted(set(langs)):
                u, n = np.unique(code[lang_at == lang], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(u), pa.string()), pa.array(u), pa.array(n.astype(np.int64))], ["lang", "code", "n"])

    def plant(key, group):
        tree = Tree(group.column("code").to_numpy(), group.column("n").to_numpy().astype(float))
        return pa.table({"lang": pa.array([key[0].as_py()], pa.string()), "tree": pa.array([pickle.dumps(tree.orders)], pa.binary())})

    counts = (texts.where(~F.col("kept_out")).select("text", "lang").mapInArrow(gram_counts, "lang string, code long, n long")
              .groupBy("lang", "code").agg(F.sum("n").alias("n")))
    trees = {}
    # one row of bounded size per language
    for r in counts.groupBy("lang").applyInArrow(plant, "lang string, tree binary").collect():
        trees[r.lang] = Tree.__new__(Tree)
        trees[r.lang].orders = pickle.loads(r.tree)
    if not trees:
        return None
    model = ContextTrees(trees)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def losses(batches):
        m = shared.value
        place = {x: j for j, x in enumerate(m.languages)}
        for b in slices(batches, "text", 1 << 20):
            rows = [(t.encode(), place[x]) for t, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if x in place]
            pieces = list(_pieces([r[0] for r in rows], [r[1] for r in rows]))
            if not pieces:
                continue
            lengths = np.array([len(x) for x, _ in pieces])
            raw = np.frombuffer(b"".join(x for x, _ in pieces), np.uint8)
            bits = m.code_lengths(raw, np.concatenate([[0], np.cumsum(lengths)]))
            truth = np.arange(len(pieces)), np.array([y for _, y in pieces])
            loss = [float(-np.log((1 - LAPSES) * m.shares(bits, lengths, w)[truth] + LAPSES / len(place)).sum()) for w in WEIGHTS]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(WEIGHTS)), pa.int32()), pa.array(loss, pa.float64())], ["w", "loss"])

    fold = texts.where("kept_out").select("text", "lang")
    best = fold.mapInArrow(losses, "w int, loss double").groupBy("w").agg(F.sum("loss").alias("loss")).orderBy("loss", "w").first()
    shared.destroy()
    return ContextTrees(trees, WEIGHTS[best.w] if best else DEFAULT_WEIGHT)


def identify(docs: DataFrame, trees: ContextTrees | None) -> DataFrame:
    """``docs`` with the columns lang_pred and score added (in place of any of these names)."""
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        model = shared.value
        for b in slices(batches, "text", 1 << 20):
            col = b.column(b.schema.get_field_index("text"))
            texts = col.to_pylist()
            known = np.array([t is not None and bool(_LETTER.search(t)) for t in texts])
            if model is None:
                pred, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            else:
                raw, off = utf8(col)
                bits = model.code_lengths(raw, off)
                pred = np.where(known, np.array(model.languages, object)[bits.argmin(1)], "und")
                score = np.where(known, model.shares(bits, np.diff(off)).max(1), 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred.tolist(), pa.string()), pa.array(score, pa.float64())],
                                             [*b.schema.names, "lang_pred", "score"])

    out = docs.select(*keep).withColumn("text", F.col("text").cast("string"))
    return out.mapInArrow(run, T.StructType([*out.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
