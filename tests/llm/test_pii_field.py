"""The field of personal data on generated held-out sentences, clean formats and hostile texts."""

import random
import time
from collections import Counter

import pytest

from hourprofile.llm import pii


@pytest.fixture(scope="module")
def crf():
    return pii.model()


def test_recall_of_every_kind(crf):
    total, hit, extra = Counter(), Counter(), 0
    for text, gold in pii._sentences(600, seed=99):
        got = pii.all_spans(text, crf)
        for s, e, y in gold:
            total[pii.KINDS[y - 1]] += 1
            hit[pii.KINDS[y - 1]] += (s, e, pii.KINDS[y - 1]) in got
        extra += sum(not any(a < e and s < b for s, e, _ in gold) for a, b, _ in got)
    assert set(total) == set(pii.KINDS) and all(hit[k] >= 0.9 * total[k] for k in total), (hit, total)
    assert extra <= 0.02 * sum(total.values())


def test_spelled_out_addresses(crf):
    for text, found in (("please write john [at] example [dot] com today", "john [at] example [dot] com"),
                        ("mail jane.doe at mail dot example dot org now", "jane.doe at mail dot example dot org"),
                        ("ask bob(at)host.example.net for it", "bob(at)host.example.net")):
        assert [(text[s:e], k) for s, e, k in pii.all_spans(text, crf)] == [(found, "email")]


def test_clean_formats_stay(crf):
    rng = random.Random(5)
    num = lambda k: "".join(rng.choices("0123456789", k=k))
    word = lambda: "".join(rng.choices("ba de ki lo mu ra te vi so na".split(), k=3))
    pair = lambda: f"{rng.randint(0, 30)}-{rng.randint(0, 30)}"
    makers = {
        "date": lambda: f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d} {rng.randint(0, 23):02d}:{num(2)}:{num(2)}",
        "isbn": lambda: f"ISBN 978-{num(1)}-{num(2)}-{num(6)}-{num(1)}", "version": lambda: f"{num(1)}.{num(2)}.{num(1)}-{num(4)}{num(2)}",
        "score": lambda: f"{pair()} {pair()} {pair()}", "decimal": lambda: f"{num(1)}.{num(5)} {num(5)} {num(5)}",
        "number": lambda: f"{num(3)}.{num(8)}"}
    for name, make in makers.items():
        texts = [f"{word()} {word()} {make()} {word()}." for _ in range(200)]
        wrong = [t for t in texts if set(pii.all_spans(t, crf)) - set(pii.base_spans(t))]
        assert len(wrong) <= 4, (name, wrong[:3])
    for text in ("on 2024-01-02 10:22:33 the", "ISBN 978-3-16-148410-0 is", "pi is 3.14159 26535 89793 and", "won 21-19 25-23 15-12 there",
                 "the number 4111-1111-1111-1112 fails"):
        assert pii.all_spans(text, crf) == [] and pii._masked(text, pii.all_spans(text, crf)) == text


def test_what_arithmetic_decides(crf):
    for text in ("card 4111.1111.1111.1112 is", "ip 256 . 1 . 2 . 3 is"):
        assert not {k for _, _, k in pii.all_spans(text, crf)} & {"card", "ip"}
    assert ("card 4111.1111.1111.1111 is"[5:24], "card") in [("card 4111.1111.1111.1111 is"[s:e], k) for s, e, k in pii.all_spans("card 4111.1111.1111.1111 is", crf)]


@pytest.mark.parametrize("unit", ["1234567890.", "a@b", "x1234567", "4111-1111-", "+1 (555) 0", "1.2.3.4"])
def test_time_grows_with_the_text(crf, unit):
    """Texts without white space too: windows don't reach back to the start."""
    spent = []
    for size in (20_000, 80_000):
        text = unit * (size // len(unit))
        start = time.perf_counter()
        pii.all_spans(text, crf)
        spent.append(time.perf_counter() - start)
    assert spent[1] < 8 * spent[0] + 0.3, spent


def test_windows_lie_apart_and_whole_texts_are_covered(crf):
    text = "x" * 300 + "555-123-4567" + "y" * 30 + " call 555-987-6543 " + "z" * 500 + "(555) 222-3333"
    spans = [(lo, lo + len(part)) for lo, part in pii._windows(text, [])]
    assert all(a < b for _, a in spans for b in [len(text) + 200]) and all(e <= s for (_, e), (s, _) in zip(spans, spans[1:]))
    for number in ("555-123-4567", "555-987-6543", "(555) 222-3333"):
        at = text.index(number)
        assert any(s <= at and at + len(number) <= e for s, e in spans)
