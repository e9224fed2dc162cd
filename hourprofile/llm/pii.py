"""Personal data in whole texts: fixed patterns, and a semi-Markov CRF for the rest.

Base spans follow fixed patterns (see ``base_spans``). Around every digit group
and every sign of a spelled-out address, a semi-Markov conditional random field
labels segments of up to ``MAX_TOKENS`` tokens: features describe a candidate as a
whole (digit groups, separators, check digit, what surrounds it), and dynamic
programming over ends, kinds and bounded lengths chooses boundaries and kinds
together. Its weights are learned by gradient ascent on the likelihood of
generated sentences, whose formats are this module's; no rows are learned from.
Its segments that touch no base span are added; base spans always stay.

Cases: null and empty texts have no spans; offsets are code points, ends
exclusive; repeated rows are scanned each; an empty table gives no rows; other
columns pass through ``mask``.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 24
MARGIN = 48
#: A segment joins the spans if its probability given the window is at least this.
LEAST_PROBABILITY = 0.6

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_REGION = re.compile(r"[0-9](?:[\x20().0-9-]*[0-9])?")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and not overlapping per
    kind, in order of start and kind; every position is visited a bounded number of times.

    email: the run of local characters before an ``@`` (as far as the last match
    allows) and a dotted domain; ip: the first four parts, then the next four, of
    a dotted chain of digits; card and phone: runs within one group of digits and
    separators, a phone right behind a plus.
    """
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        seg = text[free:at]
        local = len(seg) - len(seg.rstrip(_LOCAL))
        free = at + 1
        if local and (m := _DOMAIN.match(text, at + 1)):
            out.append((at - local, m.end(), 0))
            free = m.end()
        at = text.find("@", at + 1)
    for region in _REGION.finditer(text):
        s, e = region.span()
        if e - s < 3:
            continue
        part = text[s:e]
        if part.count(".") >= 3:
            for m in _DOTTED.finditer(part):
                parts, k = m[0].split("."), m.start()
                for i in range(0, len(parts) - 3, 4):
                    four = parts[i:i + 4]
                    n = sum(map(len, four)) + 3
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                        out.append((s + k, s + k + n, 1))
                    k += n + 1
        if e - s >= 14:
            for m in _CARD.finditer(part):
                digits = _NOT_DIGIT.sub("", m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((s + m.start(), s + m.end(), 2))
        if s and text[s - 1] == "+" and 10 <= len(_NOT_DIGIT.sub("", part)) <= 15:
            out.append((s - 1, e, 3))
    out.sort(key=lambda x: (x[0], x[2]))
    return [(s, e, KINDS[k]) for s, e, k in out]


# ------------------------------------------------------------ semi-Markov CRF

_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)
_SPELLED = re.compile(r"[\[({<]\s?(?:at|dot|punkt|arroba|@|\.)\s?[\])}>]", re.I)
_GOES_ON = re.compile(r"\s?[\[({<]\s?(?:dot|punkt|\.)\s?[\])}>]|\s(?:dot|punkt)\s|\.\w", re.I)
_LATER_DOT = re.compile(r"\.\w|[\[({<]\s?\.|\b(?:dot|punkt|punto|point)\b", re.I)
_WORD_AT, _WORD_DOT = {"at", "arroba"}, {"dot", "punkt", "punto", "point"}
_SIGNS = _WORD_AT | _WORD_DOT
_CUES = {"phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "cell", "text", "telefon", "tél", "teléfono"},
         "email": {"mail", "email", "contact", "write", "address", "reach", "e"},
         "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "karte", "carte", "tarjeta"},
         "ip": {"ip", "host", "server", "addr", "address", "ping"}}


class Window:
    """Tokens of a piece of text with what segments need at hand."""

    def __init__(self, text: str):
        self.text = text
        self.tokens = [(m[0], m.start(), m.end()) for m in _TOKEN.finditer(text)]
        low = [t[0].lower() for t in self.tokens]
        self.digits, self.marks, self.words, self.loose = [0], [0], [0], [0]
        for k, t in enumerate(low):
            self.digits.append(self.digits[-1] + (len(t) if t[0].isdigit() and t.isascii() else 0))
            self.marks.append(self.marks[-1] + self._mark(low, k))
            self.words.append(self.words[-1] + t[0].isalpha())
            self.loose.append(self.loose[-1] + self._loose(low, k))
        self.low = low

    @staticmethod
    def _mark(low: list[str], k: int) -> int:
        """An at sign, bracketed or between the words of a spelled-out address."""
        if low[k] == "@":
            return 1
        if low[k] not in _WORD_AT:
            return 0
        bracketed = any(t in "[({<" for t in low[max(0, k - 2):k] if not t.isspace())
        return int(bracketed or any(t in _WORD_DOT for t in low[k + 1:k + 12]))

    @staticmethod
    def _loose(low: list[str], k: int) -> int:
        """White space between two words neither of which is a sign of an address."""
        if not low[k].isspace() or not 0 < k < len(low) - 1:
            return 0
        sides = low[k - 1], low[k + 1]
        return int(all(t[0].isalnum() and t not in _SIGNS for t in sides))

    def segments(self):
        """(first token, end token, kinds) of the candidates.

        An address holds one at sign, written or spelled, inside, and no loose words;
        the others hold no letter. What arithmetic decides is decided here: a card has a right
        check digit, separators of one kind and no single digits, and an ip four parts of at
        most 255 with dots between.
        """
        n = len(self.tokens)
        for i in range(n):
            t = self.low[i]
            if t.isspace() or not (t[0].isalnum() or t in "+("):
                continue
            most = min(n, i + MAX_TOKENS)
            if t[0].isalpha() and self.marks[most] == self.marks[i]:
                continue
            for j in range(i + 1, most + 1):
                last = self.low[j - 1]
                marks = self.marks[j] - self.marks[i]
                if "\n" in last or marks > 1:
                    break
                if not last[0].isalnum():
                    continue
                if marks:
                    if self.loose[j] > self.loose[i]:
                        break
                    if t[0].isalnum() and self.marks[i + 1] == self.marks[i] and self.marks[j - 1] > self.marks[i]:
                        yield i, j, (1,)
                elif self.words[j] == self.words[i] and 4 <= (d := self.digits[j] - self.digits[i]) <= 19 and j - i > 1:
                    if kinds := self._digit_kinds(i, j, d):
                        yield i, j, kinds

    def _digit_kinds(self, i: int, j: int, digits: int) -> tuple[int, ...]:
        own = self.low[i:j]
        kinds = []
        if digits <= 12:
            parts = [t for t in own if t[0].isdigit()]
            between = "".join("d" if t[0].isdigit() else t for t in own).split("d")[1:-1]
            if len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) and all("." in b for b in between):
                kinds.append(2)
        if ":" not in own:
            groups = [t for t in own if t[0].isdigit()]
            between = "".join("d" if t[0].isdigit() else t for t in own).split("d")[1:-1]
            alike = len(set(between)) == 1
            if digits >= 14 and alike and min(map(len, groups)) >= 2 and luhn("".join(groups)):
                kinds.append(3)
            if 7 <= digits <= 15:
                kinds.append(4)
        return tuple(kinds)

    def features(self, i: int, j: int) -> list[str]:
        """What a candidate looks like as a whole and what is around it."""
        s, e = self.tokens[i][1], self.tokens[j - 1][2]
        own = self.low[i:j]
        groups = [len(t) for t in own if t[0].isdigit()]
        seps = sorted({"_" if t.isspace() else t for t in own if not t[0].isalnum()})
        before = [t for t in self.low[max(0, i - 6):i] if t[0].isalpha()]
        out = ["first:" + ("9" if own[0][0].isdigit() else "a" if own[0][0].isalpha() else own[0]), "tokens:%d" % min(len(own) // 3, 6)]
        left, right = self.text[s - 1:s], self.text[e:e + 1]
        out += ["left:" + ("word" if left.isalnum() or left in "_@" and left else "sep" if left and left in ".-/+:" else "out"),
                "right:" + ("word" if right.isalnum() or right in "_@" and right else "sep" if right and right in "-/+:" and self.text[e + 1:e + 2].isalnum() else "out")]
        if self.marks[j] > self.marks[i]:
            dots = sum(t in _WORD_DOT or t == "." for t in own)
            out += ["at:" + ("sign" if "@" in own else "word"), "dots:%d" % min(dots, 3), "last:%d" % min(len(own[-1]), 7), "gaps:%d" % min(sum(t.isspace() for t in own), 5)]
            out.append("more:%d" % bool(_GOES_ON.match(self.text, e)))
            out.append("ends:%d" % any(t in _WORD_DOT or t == "." for t in own[-4:-1]))
            k = next(x for x, t in enumerate(own) if t == "@" or t in _WORD_AT)
            out += ["local:%d" % min(sum(t[0].isalnum() for t in own[:k]), 4), "bracket:%d" % any(t in "[({<" for t in own)]
        else:
            digits = "".join(t for t in own if t[0].isdigit())
            shape = "-".join(map(str, groups))
            out += ["n:%d" % len(digits), "shape:" + shape, "groups:%d" % min(len(groups), 6), "seps:" + "".join(seps), "single:%d" % (len(groups) == 1)]
            out += ["four:%d" % (len(groups) == 4 and all(int(t) <= 255 for t in own if t[0].isdigit())), "luhn:%d" % (len(digits) >= 13 and luhn(digits)),
                    "even:%d" % (len(set(groups[:-1])) <= 1 and len(groups) > 2)]
        for kind, cues in _CUES.items():
            if cues & set(before):
                out.append("cue:" + kind)
        return out


class SemiCrf:
    """Labels 0 (other, one token) and 1.. (KINDS); weights by (label, feature) and label pairs."""

    def __init__(self):
        self.w: dict[tuple[int, str], float] = {}
        self.t = [[0.0] * 5 for _ in range(5)]

    def lattice(self, win: Window):
        """By end: (first token, label, score, features)."""
        ends: list[list] = [[] for _ in range(len(win.tokens) + 1)]
        for k in range(len(win.tokens)):
            ends[k + 1].append((k, 0, 0.0, ()))
        for i, j, kinds in win.segments():
            f = win.features(i, j)
            for y in kinds:
                ends[j].append((i, y, sum(self.w.get((y, x), 0.0) for x in f) + self.w.get((y, "bias"), -2.0), f))
        return ends

    def forward(self, ends):
        neg, a = -1e30, [[0.0] + [-1e30] * 4]
        for arcs in ends[1:]:
            row: list[list[float]] = [[] for _ in range(5)]
            for i, y, s, _ in arcs:
                p = a[i]
                m = max(p[x] + self.t[x][y] for x in range(5))
                row[y].append(s + m + math.log(sum(math.exp(p[x] + self.t[x][y] - m) for x in range(5))))
            a.append([neg if not r else max(r) + math.log(sum(math.exp(v - max(r)) for v in r)) for r in row])
        return a

    def backward(self, ends):
        n = len(ends) - 1
        b = [[-1e30] * 5 for _ in range(n)] + [[0.0] * 5]
        starts: list[list] = [[] for _ in range(n + 1)]
        for j, arcs in enumerate(ends):
            for i, y, s, _ in arcs:
                starts[i].append((j, y, s))
        for i in range(n - 1, -1, -1):
            for x in range(5):
                v = [self.t[x][y] + s + b[j][y] for j, y, s in starts[i]]
                m = max(v)
                b[i][x] = m + math.log(sum(math.exp(u - m) for u in v))
        return b

    def marginals(self, ends):
        """(first, end, label, features, probability) of all arcs, and their joint with the label before."""
        a, b = self.forward(ends), self.backward(ends)
        m = max(a[-1])
        z = m + math.log(sum(math.exp(v - m) for v in a[-1]))
        for j, arcs in enumerate(ends):
            for i, y, s, f in arcs:
                joint = [math.exp(min(0.0, a[i][x] + self.t[x][y] + s + b[j][y] - z)) for x in range(5)]
                yield i, j, y, f, sum(joint), joint

    def fit(self, data: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = 6, rate: float = 0.4, shrink: float = 1e-3) -> SemiCrf:
        grown: dict = {}
        for _ in range(rounds):
            for text, gold in data:
                win = Window(text)
                by_start = {s: k for k, (_, s, _) in enumerate(win.tokens)}
                by_end = {e: k + 1 for k, (_, _, e) in enumerate(win.tokens)}
                want = {(by_start[s], by_end[e], y) for s, e, y in gold}
                path, at, prev = set(want), 0, 0
                grad: dict = {}
                inside = {i: (j, y) for i, j, y in want}
                while at < len(win.tokens):
                    j, y = inside.get(at, (at + 1, 0))
                    grad["t", prev, y] = grad.get(("t", prev, y), 0.0) + 1
                    at, prev = j, y
                ends = self.lattice(win)
                for i, j, y, f, p, joint in self.marginals(ends):
                    for x in range(5):
                        if joint[x] > 1e-6:
                            grad["t", x, y] = grad.get(("t", x, y), 0.0) - joint[x]
                    g = ((i, j, y) in path) - p
                    if y and abs(g) > 1e-6:
                        for x in (*f, "bias"):
                            grad[y, x] = grad.get((y, x), 0.0) + g
                for k, g in grad.items():
                    own = self.t[k[1]][k[2]] if k[0] == "t" else self.w.get(k, -2.0 if k[1] == "bias" else 0.0)
                    g -= shrink * own
                    grown[k] = grown.get(k, 1e-6) + g * g
                    own += rate * g / math.sqrt(grown[k])
                    if k[0] == "t":
                        self.t[k[1]][k[2]] = own
                    else:
                        self.w[k] = own
        return self

    def decode(self, text: str) -> list[tuple[int, int, str]]:
        """The best segmentation's entities that are probable enough."""
        win = Window(text)
        ends = self.lattice(win)
        if not any(y for arcs in ends for _, y, _, _ in arcs):
            return []
        best, back = [[0.0] + [-1e30] * 4], [[None] * 5]
        for arcs in ends[1:]:
            row, came = [-1e30] * 5, [None] * 5
            for i, y, s, _ in arcs:
                x = max(range(5), key=lambda x: best[i][x] + self.t[x][y])
                if (v := best[i][x] + self.t[x][y] + s) > row[y]:
                    row[y], came[y] = v, (i, x)
            best.append(row)
            back.append(came)
        j, y, out = len(ends) - 1, max(range(5), key=lambda y: best[-1][y]), []
        while j:
            i, x = back[j][y]
            if y:
                out.append((i, j, y))
            j, y = i, x
        if not out:
            return []
        sure = {(i, j, y) for i, j, y, _, p, _ in self.marginals(ends) if y and p >= LEAST_PROBABILITY}
        return [(win.tokens[i][1], win.tokens[j - 1][2], KINDS[y - 1]) for i, j, y in reversed(out) if (i, j, y) in sure]


def _sentences(n: int, seed: int = 11) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Generated sentences with their entities' (start, end, label)."""
    rng = random.Random(seed)
    parts = "ba de ki lo mu ra te vi so na er th on st ing an en le".split()
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 4)))
    num = lambda k: "".join(rng.choices("0123456789", k=k))

    def email():
        at = rng.choice([" (at) ", " [at] ", "(at)", "[at]", " at ", " @ ", " {at} ", "@"])
        dot = " dot " if at == " at " else rng.choice([" (dot) ", " [dot] ", ".", "[.]", "(dot)", " dot "]) if at != "@" else "."
        return word() + rng.choice(["", "." + word(), num(2)]) + at + dot.join([word() for _ in range(rng.choice([1, 1, 2]))] + [rng.choice(["com", "org", "net", "de", "example"])])

    def phone():
        sep = rng.choice("-. /")
        return rng.choice([f"({num(3)}) {num(3)}-{num(4)}", sep.join([num(3), num(3), num(4)]), sep.join(["1", num(3), num(3), num(4)]),
                           f"0{num(3)} {num(3)} {num(4)}", f"00{num(2)} {num(3)} {num(3)} {num(3)}", f"+{num(1)}-{num(3)}-{num(3)}-{num(4)}", f"+1 ({num(3)}) 555-{num(4)}"])

    def card():
        while True:
            d = rng.choice("3456") + num(15)
            if luhn(d):
                return rng.choice([" ", "-", ".", "/"]).join(d[k:k + 4] for k in range(0, 16, 4))

    def ip():
        return rng.choice([".", ".", "[.]", " . "]).join(str(rng.randint(0, 255)) for _ in range(4))

    def other():
        d = num(16)
        day, time = f"{num(4)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", f"{rng.randint(0, 23):02d}:{num(2)}"
        ean, year = f"97{rng.choice('89')}", 1990 + int(num(2)) % 40
        stated = f"{year}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
        scores = " ".join(f"{rng.randint(0, 30)}-{rng.randint(0, 30)}" for _ in range(rng.randint(2, 5)))
        decimals = f"{num(1)}.{num(5)} {num(5)} {num(5)}", f"{num(1)}.{num(rng.randint(6, 14))}", f"{num(2)}.{num(4)}, {num(3)}.{num(4)}"
        version = ".".join(num(rng.randint(1, 2)) for _ in range(3)) + rng.choice([f"-{num(4)}{num(2)}", f".{num(4)}", f"-{num(2)}.{num(4)}", f" {num(4)}"])
        if rng.random() < 0.4:
            return rng.choice([scores, scores, *decimals, version, f"{stated} {time}:{num(2)}", f"{stated} {num(4)}", f"{stated} {stated}", f"{stated} - {stated}", f"{year}-{year + 4} {num(3)}",
                               f"ISBN {ean}-{num(1)}-{num(2)}-{num(6)}-{num(1)}", f"isbn {num(1)}-{num(3)}-{num(5)}-{num(1)}", f"{ean}-{num(1)}-{num(4)}-{num(4)}-{num(1)}",
                               f"{num(3)}.{num(3)}.{num(3)},{num(2)}", f"{num(1)},{num(3)},{num(3)}.{num(2)}", f"({num(4)}) {num(2)}-{num(2)}", f"pp. {num(3)}-{num(3)}, {num(4)}"])
        return rng.choice([num(rng.randint(4, 18)), f"{day} {time}", f"{day}T{time}:{num(2)}", f"{rng.randint(1, 12)}/{rng.randint(1, 28)}/{num(4)} {time}", f"{num(4)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", f"{rng.randint(0, 23)}:{num(2)}:{num(2)}",
                           f"{rng.randint(1, 30)}.{rng.randint(1, 12)}.{num(4)}", f"{num(1)}.{num(2)}.{num(1)}", f"{num(2)},{num(3)},{num(3)}", f"{num(3)} of {num(4)}",
                           " ".join(num(rng.randint(1, 5)) for _ in range(rng.randint(2, 6))), f"{word()}{num(6)}{word()}{num(5)}", f"{num(5)}-{num(4)}-{num(2)}",
                           word() + " at " + word(), f"{300 + int(num(2))}.{num(3)}.{num(3)}.{num(3)}", f"{d[:4]} {d[4:8]} {d[8:12]} {d[12:]}" if not luhn(d) else num(9),
                           f"{num(3)}-{num(2)}-{num(4)}", f"{num(4)}.{num(2)}", f"{num(1)} {num(1)} {num(1)} {num(4)} {num(2)}"])

    makers = ((1, email), (2, ip), (3, card), (4, phone))
    cue = {1: "email", 2: "ip", 3: "card", 4: "phone"}
    out = []
    for _ in range(n):
        text, gold = word() + " ", []
        for _ in range(rng.randint(1, 2)):
            text += " ".join(word() for _ in range(rng.randint(1, 4))) + " "
            if rng.random() < 0.5:
                y, make = rng.choice(makers)
                if rng.random() < 0.4:
                    text += rng.choice(sorted(_CUES[cue[y]])) + rng.choice([": ", " "])
                s = text + make()
                gold.append((len(text), len(s), y))
                text = s
            else:
                text += other()
            text += rng.choice([" ", ". ", ", ", "; "])
        out.append((text + word(), gold))
    return out


@lru_cache(maxsize=1)
def model() -> SemiCrf:
    return SemiCrf().fit(_sentences(1200))


def _windows(text: str, base: list[tuple[int, int, str]]):
    """Pieces around whatever may be an entity, cut at white space, in order and apart."""
    spots = [(m.start(), m.end()) for m in _REGION.finditer(text) if m.end() - m.start() >= 7]
    spots += [(m.start(), m.end()) for m in _SPELLED.finditer(text)]
    for sign in ("@", " dot ", " punkt "):
        at = text.find(sign)
        while at >= 0:
            if sign != "@" or _LATER_DOT.search(text, at, at + MARGIN):
                spots.append((at, at + len(sign)))
            at = text.find(sign, at + 1)
    taken = sorted(base)
    spots = sorted(s for s in spots if not any(a <= s[0] and s[1] <= b for a, b, _ in _near(taken, s[0])))
    k, done = 0, 0
    while k < len(spots):
        lo, hi = spots[k][0] - MARGIN, spots[k][1] + MARGIN
        while k < len(spots) and spots[k][0] - MARGIN <= hi:
            hi = max(hi, spots[k][1] + MARGIN)
            k += 1
        least = max(done, lo - 3 * MARGIN, 0)
        lo = max(lo, done, 0)
        while lo > least and not text[lo - 1].isspace():
            lo -= 1
        yield lo, text[lo:hi]
        done = hi


def _near(spans: list[tuple[int, int, str]], at: int):
    k = bisect.bisect_right(spans, (at, 1 << 62, "")) - 1
    return spans[max(0, k - 3):k + 1]


def all_spans(text: str, crf: SemiCrf, base: list[tuple[int, int, str]] | None = None) -> list[tuple[int, int, str]]:
    """Base spans and the field's spans that touch none of them."""
    base = base_spans(text) if base is None else base
    found = list(base)
    starts, reach = [a for a, _, _ in base], []
    for _, b, _ in base:
        reach.append(max(b, reach[-1] if reach else 0))
    for lo, part in _windows(text, base):
        for s, e, kind in crf.decode(part):
            s, e = s + lo, e + lo
            k = bisect.bisect_left(starts, e)  # spans that start before the end
            if not (k and reach[k - 1] > s):
                found.append((s, e, kind))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def _masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for s, e, kind in spans:
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
            at = e
        elif e > at:  # spans of two kinds that overlap become one
            at = e
    return "".join([*out, text[at:]])


def find(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans per kind, digest of the base spans, all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model())
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches):
        crf = shared.value
        for b in slices(batches, "text", 2 << 20):
            rows = []
            for text in b.column(1).to_pylist():
                base = base_spans(text or "")
                kinds = [k for _, _, k in base]
                rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(all_spans(text or "", crf, base))))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()), pa.array(cols[5], pa.string())], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets."""
    shared = docs.sparkSession.sparkContext.broadcast(model())
    at = docs.columns.index("text")

    def run(batches):
        crf = shared.value
        for b in slices(batches, "text", 2 << 20):
            texts = [t and _masked(t, all_spans(t, crf)) for t in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
