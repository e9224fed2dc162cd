"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks: runs of text between block-level tags, with
the path of open elements, their class and id words. Scripts, styles and other
markup that is never shown hold no blocks. Every block becomes a vector of hashed
path parts, hashed words and a few plain figures; a bidirectional LSTM in numpy
reads the page's sequence both ways and labels every block with the whole page as
context. Blocks labelled as article text are kept in page order. Markup is read in one
forward scan, every byte of it a bounded number of times, at any depth.

The network is trained when first used, on generated pages of many layouts whose
blocks are labelled by construction; it is the same in every run.

Cases: null and empty pages, and pages without article blocks, give an empty
text; broken markup is read as far as it goes; repeated rows are extracted each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

PATH_DIM, WORD_DIM, HIDDEN = 96, 24, 24
#: Block steps (pages times longest page) per batch of the network.
BATCH_STEPS = 20_000
TRAINING_PAGES, EPOCHS = 1200, 8

#: What follows a tag's name up to its end; it can't run past the next "<", so a failure is cheap.
_REST = re.compile(r"(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+>")
_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
#: Elements whose content is never shown; of those that aren't closed only these two run to the end.
_HIDDEN = frozenset("script style noscript template svg iframe object textarea select canvas math".split())
_RAW = frozenset(("script", "style"))
_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in _HIDDEN}
_ATTR = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[a-z]+|[0-9]+")
#: Elements that don't end a block.
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSED_BY_BLOCK = frozenset({"p"})
_SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "option": ("select",)}


class Node:
    """An open element: its path is its parent's and its own tag and names."""

    __slots__ = ("parent", "tag", "items", "sum")

    def __init__(self, parent, tag: str, names: tuple[str, ...]):
        self.parent, self.tag, self.sum = parent, tag, None
        self.items = (tag, *("." + y for y in names)) if tag else ()

    def path_sum(self) -> np.ndarray:
        """Signed hashes of the whole path added up; every element is added once."""
        todo, node = [], self
        while node.sum is None and node.parent is not None:
            todo.append(node)
            node = node.parent
        total = np.zeros(PATH_DIM, np.float32) if node.sum is None else node.sum
        for node in reversed(todo):
            total = total.copy()
            for x in node.items:
                _add(total, x)
            if node is self or len(todo) < 3:  # long chains without text keep no sums between
                node.sum = total
        return total

    def nearest(self, n: int) -> tuple[str, ...]:
        out, node = (), self
        while node is not None and len(out) < n:
            out = node.items + out
            node = node.parent
        return out[-n:]


class Block:
    __slots__ = ("node", "text", "linked", "label")

    def __init__(self, node, text, linked):
        self.node, self.text, self.linked, self.label = node, text, linked, 0

    @property
    def path(self) -> tuple[str, ...]:
        return self.node.nearest(1 << 62)


def _tags(page: str):
    """(start, end, name, closing, attributes) of the markup in one forward scan; the name
    is empty for what holds no element and ends a block where ``closing`` says so.

    A tag's name ends at white space, ``/`` or ``>``. A ``<`` that starts no tag, and all
    after the last ``>``, is text.
    """
    at, gt, ends = 0, -1, {}
    while (s := page.find("<", at)) >= 0:
        if gt < s and (gt := page.find(">", s)) < 0:
            return
        if page.startswith("<!--", s):
            e = page.find("-->", s + 2)
            at = len(page) if e < 0 else e + 3
            yield s, at, "", False, ""
            continue
        name = _NAME.match(page, s + 1)
        if name is None:
            if page[s + 1:s + 2] in ("!", "?"):
                at = gt + 1
                yield s, at, "", False, ""
            else:
                at = s + 1
            continue
        rest = _REST.match(page, name.end())
        e = rest.end() if rest else gt + 1
        tag, attrs = name[0].lower(), page[name.end():e - 1]
        if tag[0] == "/":
            yield s, e, tag[1:], True, attrs
        elif tag in _HIDDEN and not (tag in ("svg", "math") and attrs.endswith("/")):
            if ends.get(tag, -1) is not None and ends.get(tag, -1) < e:
                found = _END[tag].search(page, e)
                ends[tag] = found.start() if found else None
            if ends[tag] is not None:
                last = page.find(">", ends[tag])
                e = len(page) if last < 0 else last + 1
            elif tag in _RAW:
                e = len(page)
            yield s, e, "", True, attrs
        elif tag in _HIDDEN:
            yield s, e, "", True, attrs
        else:
            yield s, e, tag, False, attrs
        at = e


def _unescape(s: str) -> str:
    if "&" not in s:
        return s
    if "\0" in s:
        return html.unescape(s)
    return html.unescape(s.replace("&amp;", "\0")).replace("\0", "&")


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order, white space inside each made one space."""
    out: list[Block] = []
    root = Node(None, "", ())
    stack: list[Node] = []
    open_: Counter[str] = Counter()
    text: list[str] = []
    links = linked = 0

    def flush():
        nonlocal linked
        if text:
            s = " ".join(_unescape("".join(text)).split())
            if s:
                out.append(Block(stack[-1] if stack else root, s, min(1.0, linked / len(s))))
            text.clear()
        linked = 0

    def close(k: int):
        for node in stack[k:]:
            open_[node.tag] -= 1
        del stack[k:]

    at = 0
    for s, e, tag, closing, attrs in _tags(page):
        if s > at:
            text.append(page[at:s])
            if links:
                linked += s - at
        at = e
        if not tag:
            if closing:
                flush()
            continue
        if tag in _INLINE:
            if tag == "a":
                links = 0 if closing else 1
            elif tag == "br":
                text.append(" ")
            continue
        flush()
        if closing:
            if open_[tag]:
                close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == tag))
        elif tag not in _VOID:
            if stack and stack[-1].tag in _CLOSED_BY_BLOCK:
                close(len(stack) - 1)
            holders = _SIBLINGS.get(tag)
            if holders and open_[tag]:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag == tag:
                        close(k)
                        break
                    if stack[k].tag in holders:
                        break
            names = ()
            if "=" in attrs:
                names = tuple(p for a in _ATTR.findall(attrs) for p in _PARTS.findall("".join(a).lower()))
            stack.append(Node(stack[-1] if stack else root, tag, names))
            open_[tag] += 1
        links = 0
    if at < len(page):
        text.append(page[at:])
    flush()
    return out


@lru_cache(maxsize=20_000)
def _path_slot(x: str) -> tuple[int, float]:
    h = zlib.crc32(x.encode())
    return h % PATH_DIM, 1.0 if h & 0x10000 else -1.0


def _add(v: np.ndarray, x: str) -> None:
    k, sign = _path_slot(x)
    v[k] += sign


@lru_cache(maxsize=100_000)
def _word_slot(w: str) -> int:
    h = zlib.crc32(w.lower().encode())
    return h % WORD_DIM if h & 0x10000 else -1 - h % WORD_DIM


#: Up to so many words each word counts in full; more words share the same weight.
_FULL_WORDS = 12


def vectors(page: list[Block]) -> np.ndarray:
    """One row per block: path, all its words, figures."""
    n = len(page)
    x = np.zeros((n, PATH_DIM + WORD_DIM + 10), np.float32)
    words = [b.text.split(" ") for b in page]
    sizes = np.array([len(w) for w in words], np.int64)
    slots = np.array([_word_slot(y) for w in words for y in w], np.int64)
    cell = np.repeat(np.arange(n), sizes) * WORD_DIM + np.where(slots < 0, -1 - slots, slots)
    hashed = np.bincount(cell, np.where(slots < 0, -0.3, 0.3), n * WORD_DIM).reshape(n, WORD_DIM)
    x[:, PATH_DIM:PATH_DIM + WORD_DIM] = hashed * np.sqrt(np.minimum(1.0, _FULL_WORDS / sizes))[:, None]
    for k, b in enumerate(page):
        own = x[k, :PATH_DIM]
        own += b.node.path_sum()
        near = b.node.nearest(2)
        for y in near:  # the nearest elements once more, as such
            _add(own, "last " + y)
        t = b.text
        size = len(t)
        x[k, -10:] = (np.log1p(size) / 6, b.linked, k / n, (n - k) / n, size < 40, t[-1] in ".!?…:\"”", t.count(",") / (1 + size / 50),
                      bool(near) and near[-1] in ("h1", "h2", "h3", "h4"), any(c in t for c in "©|»·"), min(n, 60) / 60)
    x[:, :PATH_DIM] = np.tanh(x[:, :PATH_DIM])
    return x


class BiLstm:
    """Two LSTMs over the blocks of a page, one per direction, and a logistic output."""

    def __init__(self, dim: int, hidden: int = HIDDEN, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.p = {}
        for d in "fb":
            w = rng.standard_normal((dim + hidden + 1, 4 * hidden)) * 0.15
            w[-1, hidden:2 * hidden] = 1.0  # forget gates start open
            self.p["w" + d] = w.astype(np.float32)
        self.p["o"] = (rng.standard_normal(2 * hidden + 1) * 0.1).astype(np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, w: np.ndarray, keep: list | None = None) -> np.ndarray:
        t, n, d = x.shape
        h, c = np.zeros((n, self.h), np.float32), np.zeros((n, self.h), np.float32)
        out = np.empty((t, n, self.h), np.float32)
        z_x = x.reshape(t * n, d) @ w[:d] + w[-1]
        z_x = z_x.reshape(t, n, -1)
        k = self.h
        for i in range(t):
            z = z_x[i] + h @ w[d:-1]
            g = 1 / (1 + np.exp(-z[:, :3 * k]))
            a = np.tanh(z[:, 3 * k:])
            new = g[:, k:2 * k] * c + g[:, :k] * a
            tc = np.tanh(new)
            m = mask[i][:, None]
            if keep is not None:
                keep.append((h, c, g, a, tc, m))
            c = np.where(m, new, c)
            h = np.where(m, g[:, 2 * k:] * tc, h)
            out[i] = h
        return out

    def _grad(self, x, w, keep, d_out):
        t, n, d = x.shape
        k, gw = self.h, np.zeros_like(w)
        dh, dc = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
        for i in range(t - 1, -1, -1):
            h0, c0, g, a, tc, m = keep[i]
            dh = dh + d_out[i]
            dhm, dcm = np.where(m, dh, 0), np.where(m, dc, 0)
            dnew = dcm + dhm * g[:, 2 * k:] * (1 - tc * tc)
            dz = np.concatenate([dnew * a, dnew * c0, dhm * tc], 1) * g * (1 - g)
            dz = np.concatenate([dz, dnew * g[:, :k] * (1 - a * a)], 1)
            gw[:d] += x[i].T @ dz
            gw[d:-1] += h0.T @ dz
            gw[-1] += dz.sum(0)
            dh = np.where(m, 0, dh) + dz @ w[d:-1].T
            dc = np.where(m, 0, dc) + dnew * g[:, k:2 * k]
        return gw

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """x: (steps, pages, features); padded steps come last and are masked."""
        kf, kb = ([], []) if keep is not None else (None, None)
        f = self._run(x, mask, self.p["wf"], kf)
        b = self._run(x[::-1], mask[::-1], self.p["wb"], kb)[::-1]
        both = np.concatenate([f, b], 2)
        if keep is not None:
            keep.update(f=kf, b=kb, both=both)
        return both @ self.p["o"][:-1] + self.p["o"][-1]

    def step(self, x, mask, y):
        keep: dict = {}
        z = self.logits(x, mask, keep)
        d = np.where(mask, 1 / (1 + np.exp(-z)) - y, 0).astype(np.float32) / mask.sum()
        d_both = d[:, :, None] * self.p["o"][:-1]
        k = self.h
        return {"o": np.append((keep["both"] * d[:, :, None]).sum((0, 1)), d.sum()).astype(np.float32),
                "wf": self._grad(x, self.p["wf"], keep["f"], d_both[:, :, :k]),
                "wb": self._grad(x[::-1], self.p["wb"], keep["b"], d_both[::-1][:, :, k:])}


def _padded(pages: list[np.ndarray]):
    t = max(len(p) for p in pages)
    x = np.zeros((t, len(pages), pages[0].shape[1]), np.float32)
    mask = np.zeros((t, len(pages)), bool)
    for k, p in enumerate(pages):
        x[:len(p), k] = p
        mask[:len(p), k] = True
    return x, mask


# ------------------------------------------------------------ generated pages


def generated_page(rng: random.Random) -> tuple[str, list[bool]]:
    """A page and, per block in order, whether it is article text."""
    parts = "the re an ou in er le ti on st en sch ung ción mente eau ly ed wh nt".split()
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 4)))
    some = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    glue = rng.choice([" ", " ", " ", " ", " | ", "!! ", "&amp;&amp; ", " - "])
    sentence = lambda a=1, b=25: some(a, b).capitalize().replace(" ", glue if b > 20 else " ") + rng.choice([".", ".", ".", "!", "?", "&amp;", "***", ""])
    labels: list[bool] = []
    named = rng.random() < 0.6  # else elements speak for themselves

    def block(tag, text, main, attrs=""):
        labels.append(main)
        return f"<{tag}{attrs}>{text}</{tag}>" if tag not in ("p", "li") or rng.random() < 0.85 else f"<{tag}{attrs}>{text}"

    def wrap(inner, semantic, *classes):
        if classes and (named or not semantic) and rng.random() < 0.85:
            attrs = f' {rng.choice(["class", "class", "id"])}="{rng.choice(classes)}{rng.choice(["", "", " wide", "-box", " col-3"])}"'
        else:
            attrs = ""
        tag = semantic if semantic and rng.random() < 0.7 else "div"
        if tag == "div" and not attrs:
            attrs = f' class="{rng.choice(classes)}"'
        return f"<{tag}{attrs}>{inner}</{tag}>"

    def links(n):
        return "<ul>" + "".join(block("li", f'<a href="/{word()}">{some(1, 3)}</a>', False) for _ in range(n)) + "</ul>"

    def paragraphs(n, main):
        out = ""
        for _ in range(n):
            text = " ".join(sentence() if rng.random() < 0.9 else sentence(1, 2) for _ in range(rng.choice([1, 1, 2, 3, 6])))
            text = text.upper() if glue == "!! " and "&" not in text else text
            if rng.random() < 0.15:
                text = f"<b>{text}</b>" if rng.random() < 0.5 else f"<b>{text}<br>"
            elif rng.random() < 0.15:
                text += f' <a href="#">{some(1, 3)}</a> {sentence(2, 6)}'
            out += block("p", text, main)
        return out

    def article():
        out = block("h1", some(3, 12), True) if rng.random() < 0.85 else ""
        for _ in range(rng.randint(1, 4)):
            out += paragraphs(rng.choice([1, 2, 3, 5, 9]), True)
            x = rng.random()
            if x < 0.12:
                out += block("h2", some(2, 6), True)
            elif x < 0.2:
                out += "<ul>" + "".join(block("li", sentence(3, 12), True) for _ in range(rng.randint(2, 5))) + "</ul>"
            elif x < 0.26:
                out += block("blockquote", sentence(), True)
            elif x < 0.3:
                out += block("pre", some(3, 12), True)
            elif x < 0.34:
                out += "<table><tr>" + block("td", some(1, 4), True) + block("td", some(1, 4), True) + "</tr></table>"
            elif x < 0.44:
                out += notice()
            elif x < 0.5:
                out += wrap(links(rng.randint(2, 4)), "aside", "related", "share", "social")
        return wrap(out, "article", "article", "content", "post", "entry", "story", "main-content", "article-body") if rng.random() < 0.9 else wrap(out, "main", "main", "content")

    def notice():
        return rng.choice([
            lambda: wrap(rng.choice([lambda: block("p", sentence(3, 14), False), plain])(), "", "ad", "ads", "advert", "advertisement", "sponsored", "banner", "promo"),
            lambda: wrap(block("p", sentence(4, 16), False) + block("button", some(1, 2), False), "", "cookie-notice", "cookie", "consent", "notice", "popup", "modal", "gdpr"),
            lambda: wrap(plain(), "", "ad", "ad-slot", "advert", "sponsor")])()

    def plain():
        labels.append(False)
        return " ".join(sentence(2, 14) for _ in range(rng.randint(1, 3)))

    def form():
        inner = block("p", some(2, 8), False) + f'<input name="q"><label>{some(1, 2)}</label>'
        labels.append(False)
        inner = f"<form>{inner}<button>{some(1, 2)}</button></form>"
        labels.append(False)
        # the label's text is a block of its own before the button's
        return wrap(inner, "", "search", "newsletter", "subscribe", "signup", "login")

    def comments():
        out = block("h3", some(1, 3), False) if rng.random() < 0.6 else ""
        for _ in range(rng.randint(1, 5)):
            out += wrap(paragraphs(rng.randint(1, 2), False), "", "comment", "reply", "comment-body")
        return wrap(out, "section", "comments", "comment-list", "discussion", "responses")

    def sidebar():
        out = block("h3", some(1, 3), False) + links(rng.randint(2, 6))
        if rng.random() < 0.4:
            out += paragraphs(rng.randint(1, 2), False)
        return wrap(out, "aside", "sidebar", "widget", "side", "related", "popular")

    def top():
        out = ""
        if rng.random() < 0.5:
            inner = block("div", some(1, 4), False) + (block("p", sentence(2, 8), False) if rng.random() < 0.4 else "")
            out += wrap(inner, "header", "header", "masthead", "site-header", "top", "branding")
        if rng.random() < 0.85:
            out += wrap(links(rng.randint(2, 9)), "nav", "nav", "menu", "navbar", "navigation", "breadcrumb", "main-menu")
        return out

    def bottom():
        inner = ""
        if rng.random() < 0.4:
            inner += links(rng.randint(2, 6))
        if rng.random() < 0.7 or not inner:
            labels.append(False)
            inner += f"&copy; {word()}.example.com &middot; " + sentence(2, 14)
        else:
            inner += paragraphs(1, False)
        return wrap(inner, "footer", "footer", "site-footer", "bottom", "legal", "copyright")

    head = ""
    if rng.random() < 0.9:
        labels.append(False)
        head = f"<title>{some(2, 9)}</title>"
    page = f"<!DOCTYPE html><html><head>{head}<style>p{{}}</style><script>var t='</p>';</script></head><body>" + top()
    if rng.random() < 0.5:
        page += notice()
    if rng.random() < 0.2:
        page += form()
    if rng.random() < 0.2:
        page += sidebar()
    page += article()
    for part, share in ((comments, 0.35), (form, 0.2), (sidebar, 0.35), (notice, 0.25)):
        if rng.random() < share:
            page += part()
    if rng.random() < 0.85:
        page += bottom()
    return page + "</body></html>", labels


def training_pages(n: int, seed: int):
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        page, labels = generated_page(rng)
        found = blocks(page)
        if len(found) == len(labels):
            out.append((found, np.array(labels, np.float32)))
    return out


@lru_cache(maxsize=1)
def model() -> BiLstm:
    """The trained labeller."""
    data = [(vectors(p), y) for p, y in training_pages(TRAINING_PAGES, 1)]
    data.sort(key=lambda d: len(d[0]))
    batches = []
    for k in range(0, len(data), 30):
        x, mask = _padded([d[0] for d in data[k:k + 30]])
        y = np.zeros(mask.shape, np.float32)
        for j, d in enumerate(data[k:k + 30]):
            y[:len(d[1]), j] = d[1]
        batches.append((x, mask, y))
    net = BiLstm(data[0][0].shape[1])
    rng, m, v, t = np.random.default_rng(4), {}, {}, 0
    for epoch in range(EPOCHS):
        for k in rng.permutation(len(batches)):
            x, mask, y = batches[k]
            # parts of the path are hidden now and then, so that no name alone decides
            x = x.copy()
            x[:, :, :PATH_DIM] *= rng.random((1, x.shape[1], PATH_DIM)) > 0.1
            t += 1
            for name, g in net.step(x, mask, y).items():
                m[name] = 0.9 * m.get(name, 0) + 0.1 * g
                v[name] = 0.99 * v.get(name, 0) + 0.01 * g * g
                rate = 0.01 if epoch < EPOCHS - 3 else 0.003
                net.p[name] = (net.p[name] - rate * (m[name] / (1 - 0.9 ** t)) / (np.sqrt(v[name] / (1 - 0.99 ** t)) + 1e-7)).astype(np.float32)
    return net


def main_texts(pages: list[str], net: BiLstm) -> list[str]:
    found = [blocks(p) if p else [] for p in pages]
    order = sorted((k for k in range(len(pages)) if found[k]), key=lambda k: len(found[k]))
    out, at = [""] * len(pages), 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end - at + 1) * len(found[order[end]]) <= BATCH_STEPS:
            end += 1
        own = order[at:end]
        x, mask = _padded([vectors(found[k]) for k in own])
        main = net.logits(x, mask) > 0
        for j, k in enumerate(own):
            out[k] = "\n\n".join(b.text for b, y in zip(found[k], main[:len(found[k]), j], strict=True) if y)
        at = end
    return out


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model())

    def run(batches):
        net = shared.value
        for b in slices(batches, "html", 4 << 20):
            texts = main_texts(b.column(2).to_pylist(), net)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
