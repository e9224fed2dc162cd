"""Exact duplicates, token alignment and vector codes against brute force and SQL."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from oracle_compare import compare, duck

from hourprofile.llm import ball_kmeans, exact_dedup, queries, token_align
from hourprofile.llm.byte_bpe import byte_letters

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, digest string, bytes long, label int"
A, B = queries.vocabulary(), public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op13_vector_codes"])
def test_query_matches_sql(spark, name):
    r = compare(spark, duck(SF), name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF)
    assert r["cols_match"] and r["exact"] and r["spark_rows"] == r["duck_rows"] > 0, r


# ---------------------------------------------------------------- exact duplicates

TEXTS = [(1, "a b c"), (2, "abc"), (3, "a  b\tc\n"), (4, "a bc"), (5, None), (6, ""), (7, " \r\n\x0b\x0c"), (8, "ab c"), (8, "ab c"),
         (None, "abc"), (9, "é" * 70 + "x"), (10, "é " * 70 + "x"), (11, "é" * 70 + "y"), (12, "z" * 200_000), (13, "z " * 200_000), (14, "alone"),
         (15, "  twice"), (15, "  twice"), (None, None)]


def brute_groups(rows):
    groups = defaultdict(list)
    for n, (i, t) in enumerate(rows):
        plain = re.sub("[\x20\x09-\x0d]", "", t or "")
        groups[plain].append((-len(t or ""), i is None, i if i is not None else 0, n))
    out = Counter()
    for plain, members in groups.items():
        keep = min(m[:3] for m in members)
        keep_id = None if keep[1] else keep[2]
        kept = 1
        for m in sorted(members):
            out[(None if m[1] else m[2], keep_id, len(members), bool(kept), hashlib.sha256(plain.encode()).hexdigest())] += 1
            kept = 0
    return out


@pytest.mark.parametrize("hot", [1000, 3])
def test_exact_duplicates(spark, monkeypatch, hot):
    from hourprofile.llm import common

    monkeypatch.setattr(common, "HOT_GROUPS", hot)  # groups over a third of the rows are broadcast, then all
    df = spark.createDataFrame([(i, t, "d", 5, 1) for i, t in TEXTS], SCHEMA).repartition(4)
    rows = exact_dedup.duplicates(df, every_digest=True).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in rows) == brute_groups(TEXTS)
    plain = exact_dedup.duplicates(df).collect()
    assert Counter(r[:4] for r in plain) == Counter(r[:4] for r in rows)
    assert all(r.digest is not None for r in plain if r.group_size > 1)
    assert exact_dedup.duplicates(df.limit(0)).count() == 0


def test_exact_duplicates_of_hot_groups(spark):
    """A third of all rows are one text; every row comes back once."""
    n = 3000
    df = spark.range(n).selectExpr("id as doc_id", "case when id % 3 = 0 then concat('same', repeat(' ', int(id % 7))) else concat('t', id div 2) end as text")
    rows = exact_dedup.duplicates(df).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == n
    same = [r for r in rows if r.doc_id % 3 == 0]
    assert {(r.keep_id, r.group_size) for r in same} == {(6, 1000)} and sum(r.kept for r in same) == 1


def test_no_python_workers_for_exact_duplicates(spark):
    plan = exact_dedup.duplicates(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---------------------------------------------------------------- token alignment


def brute_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(A[0])
    a_side.encode_special_tokens = True
    b_side, letters = sentencepiece.SentencePieceProcessor(model_file=B), byte_letters()
    per, count = [], Counter()
    for t in texts:
        whole = (" " + (t or "")).encode()
        a, b = (a_side.encode(" " + t, add_special_tokens=False).ids, b_side.encode(t)) if t else ([], [])
        a_raw = [bytes(letters[c] for c in a_side.id_to_token(i)) for i in a]
        pieces = [b_side.id_to_piece(i) for i in b]
        b_raw = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in pieces]
        if b"".join(a_raw) != whole or b"".join(b_raw) != whole:
            per.append(None)
            continue
        spans = []
        for raw in (a_raw, b_raw):
            ends = np.cumsum([len(x) for x in raw]).tolist()
            spans.append(list(zip([0, *ends], ends)))
        links = [(a[i], b[j]) for i, (s, e) in enumerate(spans[0]) for j, (s2, e2) in enumerate(spans[1]) if s < e2 and s2 < e]
        groups, at = [], 0
        for cut in sorted({e for _, e in spans[0]} & {e for _, e in spans[1]}):
            groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, sp) if at <= s and e <= cut) for ids, sp in zip((a, b), spans)))
            at = cut
        count.update(links)
        per.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    return [(0, 0, 0, 0, 0, 0, "") if p is None else (*p[:3], len(p[3]), sum(count[x] == most[x[1]] for x in p[3]), sum(count[x] for x in p[3]), p[4])
            for p in per], count


ODD = [None, "", " ", "  two  spaces ", "a", "<|endoftext|> and <s> <unk>", "tabs\tand\nlines\r\n", "naïve café 漢字 😀 ▁ here", "漢字 😀 ok",
       "x" * 3000, "word " * 2000, "\x00\x01 control", "twice the same", "twice the same", "<0x41>"]


@pytest.mark.parametrize("small", [False, True])
def test_alignment(spark, monkeypatch, small):
    if small:  # many runs, blocks and groups
        for name, value in (("BLOCK", 2000), ("RECORDS", 16), ("GROUP_BYTES", 2000)):
            monkeypatch.setattr(token_align, name, value)
    texts = [t for t in pd.read_parquet(f"{SF}/documents.parquet")["text"].tolist() if len(t) < 3000][:60] + ODD
    df = spark.createDataFrame([(k, t, "d", 1, 2) for k, t in enumerate(texts)], SCHEMA).repartition(3)
    documents, pairs = token_align.align(df, *A, B)
    want, count = brute_alignment(texts)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(tuple(r[c] for c in names) for r in documents.collect()) == [(k, *w) for k, w in enumerate(want)]
    assert {(r.a_id, r.b_id): r.links for r in pairs.collect()} == count


def test_alignment_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_align.align(empty, *A, B)[0].count() == 0
    blank = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert sorted(r.n_links for r in token_align.align(blank, *A, B)[0].collect()) == [0, 0]


def test_merge_is_a_count(monkeypatch):
    monkeypatch.setattr(token_align, "RECORDS", 8)
    rng = np.random.default_rng(1)
    runs, want = [], Counter()
    for _ in range(7):
        n = int(rng.integers(1, 400))
        doc, a, b = np.sort(rng.integers(0, 20, n)), rng.integers(0, 9, n), rng.integers(0, 5, n) * 8  # one radix
        (radix, keys, _), = token_align.spill(doc, a, b)
        assert radix == 0 and (n < 100 or len(keys) > 1)
        runs.append(keys)
        want.update(zip(a.tolist(), b.tolist()))
    parts = list(token_align.merge(runs))
    pairs, links = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    assert (np.diff(pairs) > 0).all()
    assert {(int(p) % (1 << 17), int(p) >> 17): int(n) for p, n in zip(pairs, links)} == want


# ---------------------------------------------------------------- vector codes


def brute_codes(rows, parts=16, entries=64, rounds=2):
    """rows: (vec_id, vector, label), ids in order; every part against every entry."""
    x = np.floor(np.array([r[1] for r in rows], float) * 256).astype(np.int64).reshape(len(rows), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def nearest():
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
        return d.argmin(2), d.min(2)

    for _ in range(rounds):
        code, _ = nearest()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[code[:, p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(0) // len(mine)
    code, d = nearest()
    return code, d.sum(1), books


def check_codes(spark, rows, extra=()):
    df = spark.createDataFrame([*rows, *extra], "vec_id long, embedding array<double>, label int").repartition(3)
    codes, books = ball_kmeans.compress(df)
    code, error, want = brute_codes(rows)
    assert (books == want).all()
    by_label = Counter()
    for r, e in zip(rows, error.tolist()):
        by_label[r[2]] += e
    assert sorted((r.vec_id, bytes(r.code), r.error, r.label_error) for r in codes.collect()) == \
        sorted((r[0], bytes(c.tolist()), e, by_label[r[2]]) for r, c, e in zip(rows, code, error.tolist()))


def test_codes_with_ties_and_bad_rows(spark):
    rng = np.random.default_rng(3)
    # few distinct values: equal entries, ties and midpoints everywhere
    rows = [(k, (rng.integers(-3, 4, 32) / 256).tolist(), [None, 1, 2][k % 3]) for k in range(300)]
    bad = [(400, None, 1), (401, [], 1), (402, [float("nan")] * 32, 1), (403, [0.0] * 31 + [float("inf")], 2), (404, [None] + [0.0] * 31, 2),
           (405, [0.0] * 16, 1)]
    check_codes(spark, rows, bad)


def test_codes_of_clusters_and_few_rows(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 48))
    check_codes(spark, [(k, (centres[k % 12] + rng.normal(size=48) * 0.05).tolist(), k % 4) for k in range(500)])
    check_codes(spark, [(k, rng.normal(size=16).tolist(), 0) for k in range(5)])


def test_codes_edge_cases(spark):
    schema = "vec_id long, embedding array<float>, label int, code string, error long"
    assert ball_kmeans.compress(spark.createDataFrame([], schema)).codes.count() == 0
    rows = [(None, [0.5] * 16, None, "c", 1), (1, [0.25] * 16, None, "c", 1), (1, [0.25] * 16, None, "c", 1)]
    codes, books = ball_kmeans.compress(spark.createDataFrame(rows, schema))
    assert books.shape == (16, 3, 1) and books[0, :, 0].tolist() == [64, 64, 128]
    assert sorted((bytes(r.code), r.label_error) for r in codes.collect()) == [(b"\0" * 16, 0), (b"\0" * 16, 0), (b"\2" * 16, 0)]
    with pytest.raises(ValueError, match="equal parts"):
        ball_kmeans.compress(spark.createDataFrame([(1, [1.0] * 15, 0, "c", 1)], schema))


def test_rings_leave_out_only_what_cannot_win():
    rng = np.random.default_rng(5)
    for _ in range(50):
        m, width = int(rng.integers(1, 40)), int(rng.integers(1, 5))
        book, x = rng.integers(-20, 20, (m, width)), rng.integers(-25, 25, (200, width))
        d = ((x[:, None] - book) ** 2).sum(2)
        code, dist = ball_kmeans.Rings(book).assign(x, rng.integers(0, m, 200))
        assert (code == d.argmin(1)).all() and (dist == d.min(1)).all()
