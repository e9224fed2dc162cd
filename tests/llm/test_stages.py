"""Every pipeline stage on odd tables and against a plain version of its own."""

import pytest
from pyspark.sql import functions as F

from hourprofile.llm import langid, packing, pii, queries, stages

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row int, seed string"
EDGES = [(1, None, "en", "s", 0, 1, "a"), (2, "", None, None, None, 2, None), (3, "12 34 !?", "en", "s", 3, 3, "b"), (4, "one", None, "s", 3, 4, "c"),
         (5, "the quick brown fox jumps over the lazy dog " * 3, "en", "s", 9, 5, "d"), (5, "the quick brown fox jumps over the lazy dog " * 3, "en", "s", 9, 5, "d"),
         (6, "word " * 30_000, "en", "s", 9, 6, "e"), (None, "le chat et la souris", "fr", "s", 9, 7, "f")]
KEEPING = [stages.language, stages.near_dedup, stages.decontaminate, stages.mask_pii]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, COLUMNS)


@pytest.mark.parametrize("stage", KEEPING)
def test_odd_rows_keep_their_columns(spark, edges, stage):
    out = stage(spark, edges, SF)
    assert out.columns == edges.columns and out.schema.simpleString() == edges.schema.simpleString()
    rows = {(r.doc_id, r.row, r.seed) for r in out.collect()}
    assert {(6, 6, "e"), (None, 7, "f"), (5, 5, "d"), (4, 4, "c")} <= rows <= {(r[0], r[5], r[6]) for r in EDGES}


@pytest.mark.parametrize("stage", [*KEEPING, stages.pack])
def test_empty_table(spark, edges, stage):
    assert stage(spark, edges.limit(0), SF).count() == 0


def test_language_keeps_exactly_the_texts_with_letters(spark, docs, edges):
    for df in (docs, edges, edges.withColumn("lang", F.lit(None).cast("string"))):
        kept = sorted((r.doc_id or -1) for r in stages.language(spark, df, SF).collect())
        assert kept == sorted((r.doc_id or -1) for r in df.collect() if r.text and langid._LETTER.search(r.text))


def shingles(text):
    w = (text or "").translate({i: i + 32 for i in range(65, 91)}).split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_near_dedup_keeps_the_smallest_of_each_group(spark, docs):
    rows = {r.doc_id: shingles(r.text) for r in docs.collect()}
    up = {i: i for i in rows}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(rows)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            a, b = rows[i], rows[j]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((top(i), top(j)))
                up[y] = x
    got = sorted(r.doc_id for r in stages.near_dedup(spark, docs, SF).select("doc_id").collect())
    assert got == [i for i in ids if top(i) == i] and len(got) < len(ids)


def test_masked_texts(spark, docs):
    crf = pii.model()
    got = {r.doc_id: (r.text, r.n_chars) for r in stages.mask_pii(spark, docs, SF).collect()}
    for r in docs.collect():
        text = pii._masked(r.text, pii.all_spans(r.text, crf))
        assert got[r.doc_id] == (text, len(text))


def test_packed_ids(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary()[0])
    pieces = {}
    for r in stages.pack(spark, docs, SF).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
        assert r.offset + r.length <= packing.LENGTH if hasattr(packing, "LENGTH") else True
    for r in docs.collect():
        want = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1]
        raw = b"".join(x for _, x in sorted(pieces[r.doc_id]))
        assert raw == b"".join(i.to_bytes(4, "little") for i in want)
