"""Byte context trees against a plain version, the score's calibration, many languages."""

import math

import numpy as np
from pyspark.sql import functions as F

from hourprofile.llm import langid

SF = "/root/testdata/sf0.01"


def _plain_bits(learned, text):
    """Code length of ``text`` by escape, symbol by symbol."""
    def symbols(t):
        return [langid.START] * langid.ORDER + [b + 32 if 65 <= b <= 90 else b for b in t.encode()]

    seen = {}
    for t in learned:
        s = symbols(t)
        for i in range(langid.ORDER, len(s)):
            for order in range(langid.ORDER + 1):
                after = seen.setdefault(tuple(s[i - order:i]), {})
                after[s[i]] = after.get(s[i], 0) + 1
    s, bits = symbols(text), 0.0
    for i in range(langid.ORDER, len(s)):
        for order in range(langid.ORDER, -1, -1):
            after = seen.get(tuple(s[i - order:i]), {})
            total, distinct = sum(after.values()), len(after)
            if total < (langid.MIN_CONTEXT if order > 1 else 1):
                continue
            if s[i] in after:
                bits -= math.log2(after[s[i]] / (total + distinct))
                break
            bits -= math.log2(distinct / (total + distinct))
        else:
            bits += 8
    return bits


def _tree(texts):
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    u, n = np.unique(langid.codes_of(raw, off), return_counts=True)
    return langid.Tree(u, n.astype(float))


def test_code_lengths_equal_the_plain_version(monkeypatch):
    learned = {"a": ["The cat sat on the mat, the cat sat.", "1984 and 2024", ""], "b": ["über die Brücke über", "日本語 日本語 日本語"]}
    trees = langid.ContextTrees({x: _tree(ts) for x, ts in learned.items()})
    texts = ["the cat", "", "Über 1984", "日本", "\x00\x7f~", "the mat sat on the cat over " * 9]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    want = [[_plain_bits(learned[x], t) for x in trees.languages] for t in texts]
    for segment in (1 << 20, 7):
        monkeypatch.setattr(langid, "_SEGMENT", segment)
        np.testing.assert_allclose(trees.code_lengths(raw, off), want, rtol=1e-5)


def test_a_bounded_tree_keeps_the_contexts_seen_most():
    u = np.arange(200_000, dtype=np.int64) * 7919
    tree = langid.Tree(u, np.full(len(u), 5.0), most=1000)
    assert all(len(grams) <= 1000 for grams, *_ in tree.orders) and np.isfinite(tree.bits(u[:50])).all()


def test_scores_tell_how_often_they_are_right(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    trees = langid.fit(docs)
    held = docs.where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    got = []
    for size in (6, 10, 16, 30, 200):
        short = held.select("doc_id", "lang", F.substring("text", 40, size).alias("text"))
        got += [(r.score, r.lang == r.lang_pred) for r in langid.identify(short, trees).collect() if r.lang_pred != "und"]
    score, right = np.array([x for x, _ in got]), np.array([y for _, y in got])
    assert score[~right].mean() < score[right].mean() - 0.1
    assert ((score - right) ** 2).mean() < right.mean() * (1 - right.mean())  # better than one score for all
    for low, high in ((0.0, 0.7), (0.7, 0.9), (0.9, 1.01)):
        own = (score >= low) & (score < high)
        if own.any():  # three standard errors of the bin's own size
            p = score[own].mean()
            assert abs(p - right[own].mean()) < 0.03 + 3 * math.sqrt(p * (1 - p) / own.sum()), (low, p, right[own].mean())


def test_half_of_two_languages_scores_lower(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    trees = langid.fit(docs)
    one, two = trees.languages[:2]
    first, second = (docs.where((F.col("lang") == x) & (F.length("text") > 300)).select(F.substring("text", 1, 200)).first()[0] for x in (one, two))
    rows = spark.createDataFrame([(1, first + second), (2, first + first)], "doc_id long, text string")
    score = {r.doc_id: r.score for r in langid.identify(rows, trees).collect()}
    assert score[1] < score[2]


def test_many_languages(spark):
    rows = [(1000 * k + i, chr(0x4E00 + 3 * k) * 5 + f" word{k} ", f"l{k:03d}") for k in range(250) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trees = langid.fit(docs)
    assert len(trees.languages) >= 245
    got = langid.identify(docs, trees).where(F.col("lang").isin(trees.languages)).collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.95
