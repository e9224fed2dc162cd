"""Block cutting against html.parser, odd markup, deep nesting and hostile pages."""

import time
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pytest

from hourprofile.llm import html_text as H

PAGE = ('<html><body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><article><h1>A title of it</h1>'
        "<p>First paragraph of the story is here.</p>{}<p>Second paragraph of the story is longer than that.</p>"
        "<p>And the third one ends the whole of it, surely.</p></article><footer>&copy; site. All rights.</footer></body></html>")


class Cutter(HTMLParser):
    """Texts between tags that end a block, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.text, self.hidden = [], "", []

    def flush(self):
        if s := " ".join(self.text.split()):
            self.out.append(s)
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag in H._HIDDEN:
            self.hidden.append(tag)
        if tag == "br":
            self.text += " "
        elif tag not in H._INLINE:
            self.flush()

    def handle_endtag(self, tag):
        if tag in self.hidden:
            self.hidden.remove(tag)
        if tag not in H._INLINE:
            self.flush()

    def handle_data(self, data):
        if not self.hidden:
            self.text += data


@pytest.mark.parametrize("source", ["tables", "generated"])
def test_blocks_are_those_of_the_standard_parser(source):
    if source == "tables":
        pages = [p for p in pd.read_parquet("/root/testdata/sf0.01/pages.parquet")["html"] if p]
    else:
        import random
        pages = [H.generated_page(random.Random(k))[0] for k in range(150)]
    for page in pages:
        cutter = Cutter()
        cutter.feed(page)
        cutter.close()
        cutter.flush()
        assert [b.text for b in H.blocks(page)] == cutter.out, page


@pytest.mark.parametrize("odd", ["<svg-icon></svg-icon>", '<svg width="1" />', "<math/>", "<select-menu></select-menu>", "<template-x>..</template-x>",
                                 "<canvas id=c>", "<object data=x>", '<img alt="x <y>">', "<!-->", "<svg><svg><path/></svg>", "<SCRIPT>var a = '</p>';</SCRIPT >"])
def test_odd_tags_lose_no_text(odd):
    want = H.main_texts([PAGE.format("")], H.model())[0].split("\n\n")
    assert len(want) == 4
    got = H.main_texts([PAGE.format(odd)], H.model())[0].split("\n\n")
    assert [t for t in got if t in want] == want


def test_every_word_counts():
    page = "<p>" + "one two three four five six seven eight nine ten eleven twelve {}</p>"
    a, b = (H.vectors(H.blocks(page.format(x)))[0, H.PATH_DIM:H.PATH_DIM + H.WORD_DIM] for x in ("river boats", "harbour town"))
    assert not np.allclose(a, b)


def test_paths_at_any_depth():
    inner = ('<div class="menu"><ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul></div><div class="article"><h1>A title of it</h1>'
             "<p>First paragraph of the story is here, and goes on for a while.</p><p>Second paragraph of the story is longer than that, and so on.</p></div>"
             '<div class="comments"><div class="comment"><p>I like this very much.</p></div><div class="comment"><p>Me too, thanks.</p></div></div>')
    for depth in (0, 1000):
        page = "<html><body>" + "<div>" * depth + inner
        assert H.main_texts([page], H.model())[0].split("\n\n") == ["A title of it", "First paragraph of the story is here, and goes on for a while.",
                                                                    "Second paragraph of the story is longer than that, and so on."]
    found = H.blocks("<main>a<section id='x'>b</section>c</main>")
    assert [b.path for b in found] == [("main",), ("main", "section", ".x"), ("main",)]


@pytest.mark.parametrize("unit", ["<script ", "<div class='", "<a ", "<div>", "</x>", "<!--", "<", "<svg>", "<li>", "<p", '"<a b="', "&amp;", "<ul><li>", "<div>x", "<td>z",
                                  "<canvas>x", "<script></script>", "<svg></svg>"])
def test_hostile_pages_take_linear_time(unit):
    spent = []
    for size in (100_000, 400_000):
        page = unit * (size // len(unit))
        start = time.perf_counter()
        H.blocks(page)
        spent.append(time.perf_counter() - start)
    assert spent[1] < 8 * spent[0] + 0.5 and spent[1] < 4, spent
