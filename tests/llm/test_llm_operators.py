"""Each operator on small fixtures and against brute-force versions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from hourprofile.llm import (byte_bpe, decontam, embed_dedup, html_text, langid, licenses, minhash_dedup, ngram_lm, packing, pii,
                             queries, token_counts)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, rep long"
EDGES = [(1, None, "en", "s", 0, 1.0, 5), (2, "", None, None, None, None, None), (3, " \n\t ", "en", "s", 3, 1.0, 5), (4, "one", "en", "s", 3, 1.0, 5),
         (5, "the quick brown fox jumps over the lazy dog " * 3, "en", "s", 9, 1.0, 5), (5, "the quick brown fox jumps over the lazy dog " * 3, "en", "s", 9, 1.0, 5),
         (6, "The QUICK brown fox jumps over the lazy dog " * 3, "en", "s", 9, 1.0, 5), (None, "le chat et la souris", "fr", "s", 9, 1.0, 5),
         (8, "word " * 30_000, "en", "s", 9, 1.0, 5), (9, "x" * 50_000, "en", "s", 9, 1.0, 5), (10, "12 34 !? 56", "en", "s", 9, 1.0, 5),
         (11, "a <|endoftext|> b  c d", "en", "s", 9, 1.0, 5)]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet")


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if w]


def test_licenses(spark, edges, empty):
    assert licenses.scan(edges).count() == 0 and licenses.scan(empty).count() == 0
    lines = ["Released under the MIT License.", "All rights reserved.", "LICENSED UNDER CC BY-NC 4.0.!!", "Licensed under CC BY 4.0.",
             "x " * 200 + "This work is licensed under the GNU General Public License, version 3. " + "y " * 200, "he was licensed and with permission", None]
    df = spark.createDataFrame([(k, f"first\n{t}\n" if t else t) for k, t in enumerate(lines)] * 2, "doc_id long, text string")
    got = sorted((r.doc_id, r.paragraph, r.family) for r in licenses.scan(df).collect())
    assert got == sorted([(0, 1, "mit"), (2, 1, "cc-by-nc"), (3, 1, "cc-by"), (4, 1, "gpl")] * 2)


def test_wrapped_licenses(spark):
    mit = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software."""
    gpl = """/*
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */
int main() { return 0; }"""
    bsd = """# Redistribution and use in source and binary
# forms, with or without modification, are
# permitted provided that the following
# conditions are met:
# nothing else"""
    apart = "Permission is hereby granted, free of charge,\n\nto any person obtaining a copy\n\nof this software"
    narrow = "\n".join(licenses.TEMPLATES["isc"][1].split())
    other = "the river ran on\n" * 30
    texts = [mit, gpl, bsd, apart, narrow, other + "Released under the\nMIT License.\n" + other, "Released under the MIT License.\nand more\nReleased under the MIT License."]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(0, mit)], "doc_id long, text string")
    rows = licenses.scan(df).collect()
    got = sorted((r.doc_id, r.paragraph, r.family) for r in rows)
    assert {r.similarity for r in rows if r.doc_id in (1, 2, 4, 5, 6)} == {1.0}
    assert got == [(0, 4, "mit"), (0, 4, "mit"), (1, 1, "gpl"), (2, 0, "bsd"), (4, 0, "isc"), (5, 30, "mit"), (6, 0, "mit"), (6, 2, "mit")], got


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for k, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(x) > 255 for x in m[0].split("."))) or (kind == "card" and not (14 <= len(d) <= 19 and pii.luhn(d))) \
                    or (kind == "phone" and not 10 <= len(d) <= 15):
                continue
            out.append((m.start(), k, m.end(), kind))
    return [(s, e, kind) for s, _, e, kind in sorted(out)]


def test_pii(spark, edges, empty, docs):
    import random
    rng = random.Random(4)
    for _ in range(4000):
        t = "".join(rng.choices("0123456789.@a-+ ()_", weights=[3] * 10 + [6, 2, 3, 2, 2, 3, 1, 1, 1], k=rng.randint(1, 60)))
        assert brute_spans(t) == pii.base_spans(t), t
    got = {r.doc_id: r for r in queries.op2_pii(spark, SF).collect()}
    for i, t in zip(docs.doc_id, docs.text):
        base = brute_spans(t)
        assert got[i].base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert got[i].n_email == sum(k == "email" for _, _, k in base) and set(pii.joined(base).split(",")) <= set(got[i].spans.split(","))
    assert pii.find(empty).count() == 0 and pii.find(edges).count() == len(EDGES)
    assert pii.all_spans("call (555) 123-4567 now", pii.model()) == [(5, 19, "phone")]
    df = spark.createDataFrame([(1, "write a.b@c.org or 1.2.3.4", 5), (2, None, None)], "doc_id long, text string, spans long")
    assert [tuple(r) for r in pii.mask(df).orderBy("doc_id").collect()] == [(1, "write [EMAIL] or [IP]", 5), (2, None, None)]


def test_lm_scores(spark, edges, empty, docs, monkeypatch):
    got = {r.doc_id: r for r in queries.op3_lm_scores(spark, SF).collect()}
    toks = {i: words(t) + ["\n"] for i, t in zip(docs.doc_id, docs.text)}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in toks}
    c = Counter(w for i, ws in toks.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    pairs = Counter((a, b) for i, ws in toks.items() if not held[i] for a, b in zip(["\0", *ws], ws))
    off = 0
    for i, ws in toks.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel=1e-9)
        exact = 0.0
        for a, b in zip(["\0", *ws], ws):
            p, h = (c[b] + 1) / (n + v + 1), c["\n"] if a == "\0" else c[a]
            k = pairs[a, b]
            k = math.ceil(ngram_lm.BASE ** math.floor(math.log(k) / math.log(ngram_lm.BASE) + 1e-9) - 1e-9) if k else 0
            exact += math.log10(ngram_lm.SHARE * k / h + (1 - ngram_lm.SHARE) * p if h else p)
        off = max(off, abs(exact - r.score) / len(ws))
    assert off < 0.5  # false positives of the filter are the only difference
    # a filter that isn't broadcast gives the same scores, also in many small buckets
    for size in (ngram_lm.BUCKET_BYTES, 1 << 12):
        monkeypatch.setattr(ngram_lm, "BUCKET_BYTES", size)
        one = {r.doc_id: r for r in queries.op3_lm_scores(spark, SF).collect()}
        with monkeypatch.context() as m:
            m.setattr(ngram_lm, "BROADCAST_BYTES", 0)
            two = {r.doc_id: r for r in queries.op3_lm_scores(spark, SF).collect()}
        assert len(one) == len(two) == len(got)
        for i in one:
            assert one[i][:5] == two[i][:5] == got[i][:5]
            assert one[i].base_score == pytest.approx(got[i].base_score) and two[i][5:] == pytest.approx(one[i][5:])
    monkeypatch.undo()
    rows = ngram_lm.scores(edges).collect()
    assert len(rows) == len(EDGES) and all(r.n_tokens == 1 for r in rows if r.doc_id in (1, 2, 3))
    assert ngram_lm.scores(empty).count() == 0


def test_lm_sums_add_up_whenever_they_are_made(monkeypatch):
    monkeypatch.setattr(ngram_lm.Sums, "LEAST", 50)
    rng, sums, want = np.random.default_rng(5), ngram_lm.Sums(), Counter()
    for _ in range(200):
        keys, n = rng.integers(0, 300, 20).astype(np.uint64), rng.integers(1, 9, 20).astype("<i4")
        sums.add(keys, n)
        for k, c in zip(keys.tolist(), n.tolist()):
            want[k] += c
        assert sums.waiting <= 300
    keys, n = sums.total()
    assert dict(zip(keys.tolist(), n.tolist())) == want
    assert len(ngram_lm.Sums().total()[0]) == 0


def test_packing_round_trip(spark, edges, docs):
    from tokenizers import Tokenizer
    path, pattern = queries.vocabulary()
    t = Tokenizer.from_file(path)
    rows = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), path, pattern).toPandas()
    ids = {i: np.array(e.ids + [1], "<u4") for i, e in zip(docs.doc_id, t.encode_batch(docs.text.tolist(), add_special_tokens=False))}
    for i, g in rows.groupby("doc_id"):
        g = g.sort_values("start")
        assert b"".join(g.ids) == ids[i].tobytes() and (g.doc_tokens == len(ids[i])).all()
        assert [zlib.crc32(x) for x in g.ids] == g.ids_crc32.tolist()
    for _, g in rows.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= packing.CAPACITY
    small = packing.pack(edges, path, pattern, keep_ids=False)
    assert small.where("doc_id in (1, 2)").select("length").collect()[0][0] == 1
    assert small.agg({"length": "sum"}).first()[0] == sum(len(t.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in EDGES)


def test_packing_empty(spark, empty):
    assert packing.pack(empty, *queries.vocabulary()).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 16))
    x = np.concatenate([c + 0.13 * rng.standard_normal((25, 16)) for c in centres] + [np.tile(centres[0], (600, 1)), rng.standard_normal((200, 16))])
    rows = [(int(i), [float(v) for v in r], int(i) % 3 if i % 50 else None) for i, r in enumerate(x)]
    odd = [(5000, None, 1), (5001, [0.0] * 16, 1), (5002, [float("nan")] * 16, 1), (5003, [None] * 16, 1), (5004, [], 1), (5005, [1.0, 2.0], 1), (5006, [2.0, 4.0], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").repartition(4)
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(df).collect()}
    assert len(got) == len(rows) + len(odd)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([-1 - i if r[2] is None else r[2] for i, r in enumerate(rows)])
    near = (u @ u.T >= embed_dedup.THRESHOLD) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    links = np.array([got[i].n_links for i in range(len(rows))])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.99 * near.sum() and (links[label < 0] == 0).all()
    assert [got[i].n_links for i in range(5000, 5005)] == [0] * 5 and got[5006].component_id == 5005 and not got[5006].kept
    assert all(got[i].kept == (got[i].component_id == i) for i in got)
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_token_counts(spark, edges, empty, docs):
    from tokenizers import Tokenizer
    path, pattern = queries.vocabulary()
    t = Tokenizer.from_file(path)
    n = {i: len(e.ids) for i, e in zip(docs.doc_id, t.encode_batch(docs.text.tolist(), add_special_tokens=False))}
    for r in queries.op6_token_counts(spark, SF).collect():
        assert r.n_tokens == n[r.doc_id] and r.over_limit == (n[r.doc_id] > 1024)
    counter = token_counts.load(path, pattern)
    for text in ("a\x1cb \x1d c", "  two  \n\n  spaces   x", "<|endoftext|>" * 3 + " <|endoftext", "don't we'LL I'm", "日本語 ½ ١٢", " a\u0085b", "é" * 300):
        e = t.encode(text, add_special_tokens=False)
        assert counter.count(text) == len(e.ids), text
        assert byte_bpe.load(path, pattern).ids(text).tolist() == e.ids, text
    got = token_counts.token_counts(edges, path, pattern)
    assert sorted(r.n_tokens for r in got.where("doc_id in (1, 2)").collect()) == [0, 0] and got.count() == len(EDGES)
    assert token_counts.token_counts(empty, path, pattern).count() == 0


def brute_components(texts, k):
    sets = {}
    for i, t in texts:
        w = words(t)
        sets.setdefault(i, []).append(frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    flat = [(i, s) for i, ss in sets.items() for s in ss if s]
    for a in range(len(flat)):
        for b in range(a):
            (i, x), (j, y) = flat[a], flat[b]
            both = len(x & y)
            if 100 * both >= 80 * (len(x) + len(y) - both) and root(i) != root(j):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i in sets}, {i: max(map(len, s)) for i, s in sets.items()}


def test_minhash(spark, edges, empty, docs):
    want, sizes = brute_components(zip(docs.doc_id, docs.text), 2)
    for r in queries.op7_minhash_dedup(spark, SF).collect():
        assert (r.component_id, r.n_shingles, r.kept) == (want[r.doc_id], sizes[r.doc_id], want[r.doc_id] == r.doc_id)
    got = {(r.doc_id, r.component_id, r.n_shingles) for r in minhash_dedup.classes(edges).where("doc_id is not null").collect()}
    assert {(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 1), (6, 5, 9), (5, 5, 9)} <= got
    assert minhash_dedup.classes(empty).count() == 0


def test_minhash_groups_of_edited_copies(spark):
    """Copies edited so that many are above and many below the threshold, through blocks."""
    import random
    rng, base = random.Random(2), [f"w{i}" for i in range(120)]
    texts = [(0, " ".join(base))]
    for i in range(1, 330):
        w = list(base)
        for _ in range(rng.choice([1, 4, 7, 10, 14, 20])):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
        texts.append((i, " ".join(w)))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    want, _ = brute_components(texts, 2)
    assert {r.doc_id: r.component_id for r in minhash_dedup.classes(df).collect()} == want


def test_sieve_keeps_every_wanted_row(spark):
    from hourprofile.llm.common import sieved

    rows = spark.range(-5000, 5000).selectExpr("id as doc_id", "'x' as text", "1 as _note")
    rows = rows.unionByName(spark.sql("select cast(null as bigint) as doc_id, 'x' as text, 1 as _note"))
    wanted = spark.range(-5000, 5000, 7).selectExpr("id as doc_id").unionByName(spark.sql("select 3L as doc_id"))
    got = [r.doc_id for r in sieved(rows, wanted, "doc_id").collect()]
    want = {r.doc_id for r in wanted.collect()}
    assert want <= set(got) and len(got) == len(set(got))
    assert len(got) <= len(want) + 20  # few others share a bit
    assert sieved(rows, wanted.limit(0), "doc_id").count() == 0
    assert sieved(rows, wanted, "doc_id").columns == rows.columns


def test_html(spark, empty):
    page = ('<html><head><title>t</title><script>var a="</p><p>no</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>'
            '<div class="ad">Buy now things.</div><article><h1>A  title &amp; more</h1><p>First <b>bold</b>\n text of the story.<br>Second line.</p>'
            '<p>Unclosed paragraph with words &lt;here&gt;, and some more of it.<p>Third paragraph of the story ends it.</article>'
            '<footer>&copy; site. All rights.</footer></body></html>')
    df = spark.createDataFrame([(1, "u", page), (2, "u", None), (3, None, ""), (4, "u", "<"), (1, "u", page)], "page_id long, url string, html string")
    got = html_text.extract(df).orderBy("page_id").collect()
    text = "A title & more\n\nFirst bold text of the story. Second line.\n\nUnclosed paragraph with words <here>, and some more of it.\n\nThird paragraph of the story ends it."
    assert [r.text for r in got][:2] == [text, text] and got[0].n_chars == len(text) and got[2].text == "" and got[3].text == ""
    assert html_text.extract(df.limit(0)).count() == 0
    pages = html_text.training_pages(60, 77)
    wrong = sum((np.asarray(html_text.model().logits(*html_text._padded([html_text.vectors(b)]))[:, 0] > 0) != (y > 0.5)).sum() for b, y in pages)
    assert wrong <= 0.01 * sum(len(y) for _, y in pages)


def test_decontamination(spark, edges, empty):
    item = "the capital of the northern province was moved twice before the old harbour town burned down in winter"
    near = item.replace("northern", "southern").replace("burned", "fell").replace("twice ", "")
    items = spark.createDataFrame([(1, item, 0), (2, None, 0), (3, "", 0), (4, "... !!", 0), (5, "zebra", 0)], "item_id long, text string, doc_id long")
    rows = [(1, "intro words " * 50 + item.upper() + " outro" * 40), (2, f"a b c {near} d e"), (3, "the capital of the world is big and " * 20), (4, None),
            (None, item), (6, "a zebra crossed"), (7, ""), (2, f"a b c {near} d e")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, item_id string").repartition(2)
    got = sorted(((r.doc_id or 0), r.item_id) for r in decontam.matches(df, items).collect())
    assert got == [(0, 1), (1, 1), (2, 1), (2, 1), (6, 5)]
    assert sorted(r.doc_id for r in decontam.without(df, items).collect()) == [3, 4, 7]
    assert decontam.without(df, items).columns == df.columns
    assert decontam.matches(empty, items).count() == 0 and decontam.matches(edges, items.limit(0)).count() == 0


def test_decontamination_of_frequent_copies(spark):
    item = [f"word{k}" for k in range(40)]
    edited = " ".join(f"other{k}" if k % 4 == 3 else w for k, w in enumerate(item))
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = [(k, f"before {edited} after {k}") for k in range(60)] + [(60, " ".join(item)), (61, " ".join(item[:20]))]
    got = {r.doc_id: r for r in decontam.matches(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), items).collect()}
    assert sorted(got) == list(range(61))
    assert got[0].similarity == (30 * 2 - 9) / 80 and (got[0].first_word, got[0].last_word) == (1, 39)
    assert got[60].similarity == 1 and (got[60].first_word, got[60].last_word) == (0, 39)


def test_decontamination_whatever_the_punctuation(spark):
    words = [f"word{k}" for k in range(24)]
    item = " ".join(w + ("," if k % 3 == 0 else "." if k % 3 == 1 else "") for k, w in enumerate(words))
    rows = [(0, " ".join(words)), (1, " ".join(f"**{w}%%%" for w in words)), (2, "|" + "|_".join(words).upper()), (3, '"' + '" - "'.join(words) + '"'), (4, "!!! ,.")]
    df, items = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, item), (2, "...")], "item_id long, text string")
    got = {r.doc_id: (r.item_id, r.similarity) for r in decontam.matches(df, items).collect()}
    assert got == {k: (1, 1.0) for k in range(4)}
    assert [r.doc_id for r in decontam.without(df, items).collect()] == [4]


def test_language_id(spark, edges, empty, docs):
    got = queries.op10_language_id(spark, SF).toPandas().merge(docs[["doc_id", "lang"]])
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert (got.lang == got.lang_pred)[got.held_out].mean() > 0.97 and got.score.between(0, 1).all()
    rows = langid.identify(edges, langid.fit(edges)).collect()
    assert len(rows) == len(EDGES) and {r.lang_pred for r in rows if r.doc_id in (1, 2, 3, 10)} == {"und"}
    assert langid.fit(empty) is None and langid.identify(edges, None).where("lang_pred <> 'und'").count() == 0
    for tree in langid.fit(edges).trees:  # escape passes no more than it has
        for context in (0, 1, 12345):
            assert np.exp2(-tree.bits(context * langid.SYMBOLS + np.arange(256))).sum() < 1 + 1e-3


def test_pipeline(spark, docs):
    import corpus_pipeline as cp
    df, seen = spark.read.parquet(f"{SF}/documents.parquet"), [len(docs)]
    for name, stage in cp.STAGES[:-1]:
        df = stage(spark, df, SF)
        assert df.columns == list(docs.columns), name
        seen.append(df.count())
    want, _ = brute_components(zip(docs.doc_id, docs.text), 5)
    assert seen[1] == len(docs) and seen[2] == sum(i == r for i, r in want.items()) and seen[3] <= seen[2] and seen[4] == seen[3]
    packed = cp.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in df.select("doc_id").collect()}


def test_pipeline_writes_the_packed_ids(spark, docs):
    from hourprofile.llm import stages
    df = spark.createDataFrame([(int(i), t) for i, t in docs[["doc_id", "text"]].head(20).itertuples(index=False)], "doc_id long, text string")
    rows = stages.pack(spark, df, SF).collect()
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows) and len({r.doc_id for r in rows}) == 20
    got = queries.op4_packing(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and "crc32(ids" in got._jdf.queryExecution().analyzed().toString()
