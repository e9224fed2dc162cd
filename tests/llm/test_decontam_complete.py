"""Decontamination against full Smith-Waterman over all texts and items."""

import random
import re

import numpy as np
import pandas as pd
import pytest

from hourprofile.llm import decontam

SF = "/root/testdata/sf0.001"


def words(text):
    return [w for w in re.split(r"[^0-9a-z\x80-\U0010ffff]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if w]


def best(item, text):
    """Best local score, cell by cell."""
    row, top = [0] * (len(text) + 1), 0
    for w in item:
        new = [0]
        for j, x in enumerate(text):
            new.append(max(0, row[j] + (2 if w == x else -1), row[j + 1] - 1, new[j] - 1))
        row = new
        top = max(top, max(row))
    return top


def brute(docs, items):
    out = set()
    for i, t in docs:
        w = words(t)
        for k, item in items:
            x = words(item)
            # fewer common words than the threshold asks can't score: an exact shortcut
            if x and sum(y in set(w) for y in x) >= 0.6 * len(x) - 1e-9 and best(x, w) >= 1.2 * len(x) - 1e-9:
                out.add((i, k))
    return out


def found(spark, docs, items):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = decontam.matches(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert all(0.6 <= r.similarity + 1e-9 <= 1 + 2e-9 for r in rows)
    return {(r.doc_id, r.item_id) for r in rows}


def test_whole_tables(spark):
    docs = list(pd.read_parquet(f"{SF}/documents.parquet")[["doc_id", "text"]].itertuples(index=False, name=None))
    items = list(pd.read_parquet(f"{SF}/benchmark.parquet")[["item_id", "text"]].itertuples(index=False, name=None))
    want = brute(docs, items)
    assert found(spark, docs, items) == want and want


@pytest.mark.parametrize("step", [1, 2, 3, 4])
def test_copies_with_words_changed_everywhere(spark, step):
    rng = random.Random(step)
    vocabulary = [f"w{k}" for k in range(300)] + ["the", "of", "and", "to"] * 30
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 4, 5, 6, 7, 11, 20, 45])))) for k in range(25)]
    docs, n = [], 0
    for _, item in items:
        w = item.split()
        other = lambda: rng.choice(["zz", "yy", "the"])
        edits = [[x for k, y in enumerate(w) for x in ([y, other()] if k % step == step - 1 else [y])],
                 [y for k, y in enumerate(w) if k % (step + 1) != step],
                 [other() if k % (step + 1) == step else y for k, y in enumerate(w)],
                 [x for k, y in enumerate(w) for x in ([y, other(), other()] if k % (2 * step) == 0 else [y])], w]
        for e in edits:
            around = [rng.choices(vocabulary, k=rng.randint(0, 30)) for _ in range(2)]
            docs.append((n, " ".join([*around[0], *e, *around[1]])))
            n += 1
    want = brute(docs, items)
    assert found(spark, docs, items) == want and len(want) > len(items)


def test_frequent_seeds_are_left_out_and_nothing_is_lost():
    item = "the of the of the rare one of the words to the last of them and the end of it all in the town"
    every = decontam.Items([1], [item])
    counts = np.arange(len(every.seeds)) * 10
    some = decontam.Items([1], [item], counts)
    n = len(item.split())
    assert len(every.key) == n - 1 and len(every.key) - len(some.key) == int(np.ceil(0.2 * n - 1 - 1e-9)) - 1
    gone = set(every.key.tolist()) - set(some.key.tolist())
    assert gone and min(counts[list(gone)]) >= max(counts[some.key]) - 10 * len(every.key)


def test_cases(spark):
    items = [(1, None), (2, ""), (3, "one two three four five six seven"), (3, "one two three four five six seven"), (None, "eight nine ten eleven twelve thirteen")]
    docs = [(1, None), (2, ""), (3, "x ONE two three, four five six seven y"), (3, "x ONE two three, four five six seven y"), (4, "eight nine ten eleven twelve thirteen")]
    rows = decontam.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id or -1) for r in rows) == [(3, 3)] * 4 + [(4, -1)]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.matches(spark.createDataFrame(docs, "doc_id long, text string"), none).count() == 0
    kept = decontam.without(spark.createDataFrame([(i, t, "e", 1) for i, t in docs], "doc_id long, text string, item_id string, seed int"),
                            spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2] and kept.columns == ["doc_id", "text", "item_id", "seed"]
