"""Rendering of pages: what browsers show, and a second, naive reading of the given pages."""

import re
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest

from pagelake.llm import html_layout
from tests.conftest import SF

CASES = [
    ("<style>@media print{.a{display:none}}</style><p class=a>x", "x"),
    ("<style media=print>p{display:none}</style><p>q", "q"),
    ("<style>@media screen{.a{display:none}}</style><p class=a>x<p>y", "y"),
    ("<style>.x{display:none}.x{display:block}</style><p class=x>y", "y"),
    ("<style>p{display:none !important}p{display:block}</style><p style='display:block'>q<div>r", "r"),
    ("<style>#a{display:none}p.b{display:block}</style><p id=a class=b>q<div>r", "r"),
    ("<style>.x{display:none}</style><div class=x>no<p style='display:block'>no</div>z", "z"),
    ("<style>/* .y{ } */ [data-k=v]{display:none}</style><p data-k=v>a<p data-k=w>b", "b"),
    ("<div style='visibility:hidden'>a<span style='visibility:visible'>b</span></div>", "b"),
    ("<style>p.ad, div .b{display:none}</style><p class=ad>1<p>2<div><i class=b>3</i>4</div>", "2\n\n4"),
    ("<style>#k .m > b{display:none}</style><div id=k><p class=m><b>1</b><i><b>2</b></i></div>", "2"),
    ("<style>p:hover{display:none}a::after{visibility:hidden}</style><p>s", "s"),
    ("<p hidden>q", ""),
    ("<p hidden style='display:block'>q", "q"),
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C</table>", "A  B\n   C"),
    ("<table><tr><td rowspan=0>A<td>B<tr><td>C<tr><td>D<tbody><tr><td>E</table>", "A  B\n   C\n   D\nE"),
    ("<table><tr><td colspan=2>ab<td>c<tr><td>1<td>2<td>3</table>", "ab    c\n1  2  3"),
    ("<div>" * 250 + "<div hidden>secret</div>seen", "seen"),
    ("<div>" * 20_000 + "<p hidden>secret</p>seen", "seen"),
    ("<head><title>t</title>text", "text"),
    ("<p>a <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> b<svg><title>t</title><text>lab</text><path/></svg>", "a x=1 b lab"),
]


@pytest.mark.parametrize("page, expected", CASES)
def test_what_shows(page, expected):
    assert html_layout.visible_text(page) == expected


class Naive(HTMLParser):
    """All text outside of elements that never show or that simple rules hide, word by word, with no layout."""

    def __init__(self, hidden):
        super().__init__()
        self.hidden, self.stack, self.words = hidden, [], []

    def handle_starttag(self, tag, attrs):
        if tag in html_layout.VOID:
            return
        a = dict(attrs)
        names = {tag, f"#{a.get('id')}", *(f".{c}" for c in (a.get("class") or "").split())}
        gone = tag in html_layout.UNSEEN or "hidden" in a or bool(re.search("display: *none|visibility: *hidden", a.get("style") or "")) or bool(names & self.hidden)
        self.stack.append((tag, gone))

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break

    def handle_data(self, data):
        if not any(gone for _, gone in self.stack):
            self.words.append(data)


def test_given_pages_by_a_naive_reading():
    pages = pq.read_table(f"{SF}/pages.parquet")["html"].to_pylist()
    for page in pages:
        hidden = {s.strip() for body in re.findall("(?is)<style[^>]*>(.*?)</style>", page or "") for rule in re.findall(r"([^{}]+)\{([^{}]*)\}", body) if re.search("display: *none|visibility: *hidden", rule[1]) for s in rule[0].split(",")}
        naive = Naive(hidden)
        naive.feed(page or "")
        naive.close()
        plain = re.findall(r"\w+", " ".join(naive.words))
        mine = re.findall(r"\w+", re.sub(r"(?m)^\s*\d+\. ", "", html_layout.visible_text(page)))
        assert "".join(plain) == "".join(mine)
    assert len(pages) >= 50


def test_many_rules_cost_what_their_nodes_do():
    import time

    rules = "".join(f".a{i} .b{{display:none}}" for i in range(2000))
    page = f"<style>{rules}</style>" + "<div class=b>" * 400 + "deep" + "</div>" * 400
    began = time.process_time()
    assert html_layout.visible_text(page) == "deep"
    page = f"<style>{rules}</style><div class=a7>" + "<div class=b>" * 400 + "deep" + "</div>" * 401 + "<p class=b>seen</p>"
    assert html_layout.visible_text(page) == "seen"
    assert time.process_time() - began < 5


def test_rules_by_ancestors_are_those_of_every_rule_tried():
    import random

    rng = random.Random(5)
    for _ in range(60):
        part = lambda: rng.choice(["div", "p", "*", ".x", ".y", "#i", "div.x", "p.y#i", "[t]"])
        rules = html_layout.rules_of("".join(f"{rng.choice([' ', ' > ']).join(part() for _ in range(rng.randrange(1, 4)))}{{display:none}}" for _ in range(12)))
        sheet, path = html_layout.Sheet(rules), []
        for _ in range(9):
            path.append(html_layout.Node(rng.choice(["div", "p", "b"]), {k: v for k, v in (("class", rng.choice(["", "x", "x y"])), ("id", rng.choice(["", "i"])), ("t", "1")) if rng.random() < 0.6}))
            assert sorted(map(id, sheet.fitting(path))) == sorted(id(r) for r in rules if r.fits(path))


def test_marks_numbers_buttons_and_wide_cells():
    see = html_layout.visible_text
    assert see("<style><!-- .a{display:none} --></style><p class=a>no<p>yes") == "yes"
    assert see("<ol><li>a<li value=5>b<li>c</ol>") == "1. a\n5. b\n6. c"
    assert see("<ol reversed><li>a<li>b<li value=9>c<li>d</ol>") == "4. a\n3. b\n9. c\n8. d"
    assert see("<ol reversed start=7><li>a<li hidden>b<li>c</ol>") == "7. a\n6. c"
    assert see("<p>Go <input type=submit value='Search now'> <input type=text value=secret><input type=reset></p>") == "Go Search now Reset"
    assert see("<table><tr><td>漢字<td>a<tr><td>abc<td>b<tr><td>é<td>c</table>") == "漢字  a\nabc   b\né     c"
