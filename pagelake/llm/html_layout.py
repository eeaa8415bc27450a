"""HTML extraction by layout-aware rendering.

A tree builder supplies implied tags and closes what a start tag ends; a cascade of the page's own rules, by weight and
order, says what is displayed and what is visible; a renderer then emits all visible text, with blank lines around spaced blocks, list marks and indents, preformatted
text as it stands, and table cells padded to columns.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_left
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import col, sealed, unsealed

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template title noscript iframe object audio video canvas datalist param source track noembed noframes meta link base".split())
#: Of a drawing only its texts show; what a formula says in another notation does not.
DRAWN, UNDRAWN = frozenset("text tspan textpath foreignobject".split()), frozenset("desc metadata title defs symbol annotation annotation-xml".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir blockquote pre table figure fieldset hr xmp".split())
#: What the start of a block, an item, a row or a cell closes, and the elements that such a search may not leave.
ENDS_P = BLOCKS - {"body", "html", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend"}
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
}
FENCES = frozenset({"table", "td", "th", "caption", "button", "object", "template", "html"})
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([\w-]+)([^;]*)", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*([\w-]+)([^;]*)", re.I)
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
#: One compound selector: a tag or *, then classes, ids and attributes; anything else makes a rule one that is left out.
_COMPOUND = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+|\[[\w-]+(?:=\"?[^\]\"]*\"?)?\])*)")
_PART = re.compile(r"([.#])([\w-]+)|\[([\w-]+)(?:=\"?([^\]\"]*)\"?)?\]")
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_BREAK = "\x00"


class Node:
    __slots__ = ("tag", "attributes", "children", "shown", "unseen", "inside")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None):
        self.tag, self.attributes, self.children = tag, attributes or {}, []
        self.shown, self.unseen = True, False  # by display; by visibility, which children may take back
        self.inside: frozenset = frozenset()  # what rules ask of ancestors, as far as this node and those above it have it

    def keys(self) -> set[tuple[str, str]]:
        """What selectors may find this node by."""
        a = self.attributes
        return {("", self.tag), ("#", a.get("id", "")), *((".", c) for c in a.get("class", "").split())}


class Rule:
    """One selector of a style sheet with what it says of display and visibility; later and closer ones win."""

    __slots__ = ("parts", "weight", "display", "visibility")

    def __init__(self, selector: str, order: int, display: tuple[str, bool] | None, visibility: tuple[str, bool] | None):
        self.parts, self.display, self.visibility = [], display, visibility
        ids = classes = tags = 0
        steps = re.split(r"\s*(>)\s*|\s+", selector.strip())
        child = False
        for step in steps:
            if step in (None, "", ">"):
                child |= step == ">"
                continue
            m = _COMPOUND.fullmatch(step)
            if not m:
                raise ValueError(step)
            tag = None if m[1] in (None, "*") else m[1].lower()
            wanted = [(x[1] or "[", x[2] or x[3].lower(), x[4]) for x in _PART.finditer(m[2])]
            ids += sum(k == "#" for k, _, _ in wanted)
            classes += sum(k != "#" for k, _, _ in wanted)
            tags += tag is not None
            self.parts.append((child, tag, wanted))
            child = False
        if not self.parts or child:
            raise ValueError(selector)
        self.weight = (ids, classes, tags, order)

    @staticmethod
    def _fits(node: Node, tag: str | None, wanted: list) -> bool:
        a = node.attributes
        if tag and node.tag != tag:
            return False
        for kind, name, value in wanted:
            if kind == "#" and a.get("id") != name or kind == "." and name not in a.get("class", "").split():
                return False
            if kind == "[" and (name not in a or value is not None and a[name] != value):
                return False
        return True

    def fits(self, path: list[Node]) -> bool:
        """Whether the last node of a path from the root is one that the selector means."""
        child, tag, wanted = self.parts[-1]
        if not self._fits(path[-1], tag, wanted):
            return False
        return self._above(path, len(path) - 2, len(self.parts) - 2, child)

    def _above(self, path: list[Node], at: int, k: int, child: bool) -> bool:
        # The nearest fitting ancestor is the best one for what stands left of it, unless a child step asks for another.
        if k < 0:
            return True
        up, tag, wanted = self.parts[k]
        while at >= 0:
            if self._fits(path[at], tag, wanted) and self._above(path, at - 1, k - 1, up):
                return True
            if child:
                return False
            at -= 1
        return False


def _said(style: str, pattern: re.Pattern) -> tuple[str, bool] | None:
    """The last declaration of a property, and whether it is important."""
    found = [(m[1].lower(), "important" in m[2].lower()) for m in pattern.finditer(style)]
    return next((x for x in reversed(found) if x[1]), found[-1]) if found else None


def rules_of(sheet: str, order: int = 0) -> list[Rule]:
    """The rules of a style sheet that say something of display or visibility. Those of other media than screens, and of
    conditions that cannot be judged here, are left out; so are selectors with other parts than Rule knows."""
    sheet, at, out = _COMMENT.sub(" ", sheet).replace("<!--", " ").replace("-->", " "), 0, []
    while (brace := sheet.find("{", at)) >= 0:
        head = sheet[at:brace].rpartition(";")[2].strip()
        depth, end = 1, brace + 1
        while depth and (m := re.compile("[{}]").search(sheet, end)):
            depth += 1 if m[0] == "{" else -1
            end = m.end()
        body = sheet[brace + 1 : end - 1 if not depth else len(sheet)]
        at = end if not depth else len(sheet)
        if head.startswith("@"):
            medium = head.lower()
            if re.match(r"@media\s+(?:only\s+)?(?:all|screen)\s*$", medium) or medium.startswith(("@layer", "@supports")) and "not" not in medium:
                out += rules_of(body, order + len(out))
            continue
        said = _said(body, _DISPLAY), _said(body, _VISIBILITY)
        if any(said):
            for selector in head.split(","):
                try:
                    out.append(Rule(selector, order + len(out), *said))
                except ValueError:
                    continue
    return out


def _key(tag: str | None, wanted: list) -> tuple[str, str]:
    """What a node has at least for a part of a selector to mean it."""
    return next(((k, n) for k, n, _ in wanted if k in "#."), ("", tag or "*"))


class Sheet:
    """The rules by what their last part has to be, then by what some ancestor has to be, so that a node is held against
    few of them: its own, and of those that ask for ancestors the ones whose ancestor it has."""

    def __init__(self, rules: list[Rule]):
        self.by: dict[tuple[str, str], dict[tuple[str, str] | None, list[Rule]]] = {}
        self.asked: set[tuple[str, str]] = set()
        for rule in rules:
            above = [_key(tag, wanted) for _, tag, wanted in rule.parts[:-1]]
            need = next((k for k in above if k[0]), next((k for k in above if k[1] != "*"), None))
            self.asked |= {need} - {None}
            self.by.setdefault(_key(*rule.parts[-1][1:]), {}).setdefault(need, []).append(rule)

    def fitting(self, path: list[Node]) -> list[Rule]:
        node = path[-1]
        keys = node.keys()
        above = path[-2].inside if len(path) > 1 else frozenset()
        node.inside = above if (own := keys & self.asked) <= above else above | own
        out = []
        for key in (("", "*"), *keys):
            if under := self.by.get(key):
                needs = [n for n in under if n is None or n in above] if len(under) < len(above) else [n for n in (None, *above) if n in under]
                out += [r for n in needs for r in under[n] if r.fits(path)]
        return out


def parse(html: str) -> tuple[Node, list[Rule]]:
    """The tree of a page and the rules of its style sheets."""
    root = Node("html")
    stack, rules, at, end = [root], [], 0, len(html)
    inside: dict[str, int] = {}  # how many of each tag are open, so that a search up the stack ends where there is none

    def cut(i: int) -> None:
        for node in stack[i:]:
            inside[node.tag] -= 1
        del stack[i:]

    def text(raw: str) -> None:
        if raw:
            if stack[-1].tag == "head" and raw.strip():  # text ends a head that nothing else has ended
                cut(len(stack) - 1)
            if stack[-1].tag in ("table", "tbody", "thead", "tfoot", "tr") and raw.strip():
                start_tag("td", {}) if stack[-1].tag == "tr" else start_tag("tr", {}) or start_tag("td", {})
            stack[-1].children.append(unescape(raw).replace(_BREAK, "�"))

    def close(tags: set[str] | frozenset[str], fences: set[str] | frozenset[str]) -> None:
        if not any(inside.get(t) for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in fences:
                break
            if stack[i].tag in tags:
                cut(i)
                if not any(inside.get(t) for t in tags):
                    break

    def start_tag(tag: str, attributes: dict[str, str]) -> None:
        if tag in ("html", "body"):
            while len(stack) > 1 and stack[-1].tag != "body" and tag == "body":
                cut(len(stack) - 1)
            stack[-1].attributes |= {k: v for k, v in attributes.items() if k not in stack[-1].attributes and tag == "body"}
            return
        if stack[-1].tag == "head" and tag not in UNSEEN:
            cut(len(stack) - 1)
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in ENDS_P and inside.get("p"):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in FENCES:
                    break
                if stack[i].tag == "p":
                    cut(i)
                    break
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            start_tag("tr", {})
        if tag == "input":
            kind = attributes.get("type", "").lower()
            if kind not in ("submit", "reset", "button"):
                return
            # A button shows its value, and says what it does where it has none.
            tag, said = "button", attributes.get("value", {"submit": "Submit", "reset": "Reset"}.get(kind, ""))
            node = Node(tag, attributes)
            node.children.append(said.replace(_BREAK, "\ufffd"))
            stack[-1].children.append(node)
            return
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag not in VOID:
            stack.append(node)
            inside[tag] = inside.get(tag, 0) + 1

    while at < end:
        m = _TOKEN.search(html, at)
        if not m:
            text(html[at:])
            break
        text(html[at : m.start()])
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag in ("body", "html"):
                continue
            if tag == "br":
                stack[-1].children.append(Node("br"))
            for i in range(len(stack) - 1, 0, -1) if inside.get(tag) else ():
                if stack[i].tag == tag:
                    cut(i)
                    break
                if stack[i].tag in FENCES and tag not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th"):
                    break
        elif m[2]:
            tag = m[2].lower()
            attributes: dict[str, str] = {}
            for a in _ATTRIBUTE.finditer(m[3] or ""):
                attributes.setdefault(a[1].lower(), unescape(a[2] or a[3] or a[4] or ""))
            start_tag(tag, attributes)
            if tag in RAW:
                stop = re.compile(f"</{tag}(?=[\\s/>]|\\Z)", re.I).search(html, at)
                body = html[at : stop.start() if stop else end]
                if tag == "style":
                    if re.fullmatch(r"\s*(?:all|screen)?\s*", attributes.get("media", ""), re.I):
                        rules += rules_of(body, len(rules))
                elif tag in ("textarea", "xmp"):
                    stack[-1].children.append((unescape(body) if tag == "textarea" else body).replace(_BREAK, "�"))
                if stack[-1].tag == tag:
                    cut(len(stack) - 1)
                at = html.find(">", stop.start()) + 1 if stop and html.find(">", stop.start()) >= 0 else end
    return root, rules


def styled(root: Node, rules: list[Rule]) -> int:
    """Set shown and unseen of every node, by attributes, rules and what a browser never shows; how deep the tree is."""
    sheet, deepest = Sheet(rules) if rules else None, 0
    path: list[Node] = []
    todo: list[tuple[Node, int, bool, bool]] = [(root, 0, False, False)]
    while todo:
        node, depth, unseen, drawing = todo.pop()
        deepest = max(deepest, depth)
        del path[depth:]
        path.append(node)
        a, tag = node.attributes, node.tag
        shown = not (tag in UNSEEN or "hidden" in a or tag == "dialog" and "open" not in a or drawing and tag in UNDRAWN)
        fitting = sheet.fitting(path) if sheet else []
        for pattern, name in ((_DISPLAY, "display"), (_VISIBILITY, "visibility")):
            said = [((v[1], 0, *r.weight), v[0]) for r in fitting if (v := getattr(r, name))]
            if (own := _said(a["style"], pattern) if "style" in a else None) is not None:
                said.append(((own[1], 1, 0, 0, 0, 0), own[0]))
            if said:
                value = max(said)[1]
                if name == "display":
                    # A rule may show what the hidden attribute hides, but not what has no place on a page at all.
                    shown = value != "none" and tag not in UNSEEN and not (drawing and tag in UNDRAWN)
                elif value in ("hidden", "collapse", "visible"):
                    unseen = value != "visible"
        node.shown, node.unseen = shown, unseen
        if shown:
            drawing = drawing or tag in ("svg", "math")
            todo += [(c, depth + 1, unseen, drawing) for c in reversed(node.children) if isinstance(c, Node)]
    return deepest


class Renderer:
    """Lines of text from a styled tree."""

    def lines(self, node: Node) -> list[str]:
        """The lines of a block's content; an empty string is a blank line that spacing asks for."""
        out: list[str] = []
        run: list[str] = []

        def flush() -> None:
            if run:
                words = _BLANKS.sub(" ", "".join(run))
                run.clear()
                out.extend(x for x in (y.strip(" ") for y in words.split(_BREAK)) if x)

        def block(tag: str, own: list[str]) -> None:
            if own:
                if tag in SPACED and out and out[-1]:
                    out.append("")
                out.extend(own)
                if tag in SPACED:
                    out.append("")

        def walk(parent: Node) -> None:
            for child in parent.children:
                if isinstance(child, str):
                    if not parent.unseen:
                        run.append(child)
                elif not child.shown:
                    continue
                elif child.tag == "svg":
                    run.extend(f" {x} " for x in drawn(child))
                elif child.tag == "br":
                    run.append(_BREAK)
                elif child.tag not in BLOCKS and child.tag not in ("textarea", "xmp"):
                    walk(child)
                else:
                    flush()
                    block(child.tag, self.block(child))

        walk(node)
        flush()
        while out and not out[-1]:
            out.pop()
        return out

    def block(self, node: Node) -> list[str]:
        tag = node.tag
        if tag == "hr":
            return [] if node.unseen else ["---"]
        if tag in ("pre", "textarea", "xmp"):
            return [x.rstrip("\r") for x in self.raw(node).removeprefix("\n").rstrip("\n").split("\n")]
        if tag in ("ul", "ol", "menu", "dir"):
            return self.items(node)
        if tag == "table":
            return self.table(node)
        if tag == "dd" or tag == "blockquote":
            return ["  " + x if x else x for x in self.lines(node)]
        if tag == "details" and "open" not in node.attributes:
            first = [c for c in node.children if isinstance(c, Node) and c.tag == "summary" and c.shown]
            return self.lines(first[0]) if first else []
        return self.lines(node)

    def raw(self, node: Node) -> str:
        out: list[str] = []
        todo: list[tuple[Node, Node | str]] = [(node, c) for c in reversed(node.children)]
        while todo:
            parent, c = todo.pop()
            if isinstance(c, str):
                out += [] if parent.unseen else [c]
            elif c.tag == "br":
                out.append("\n")
            elif c.shown:
                todo += [(c, x) for x in reversed(c.children)]
        return "".join(out)

    def items(self, node: Node) -> list[str]:
        out: list[str] = []
        step = -1 if node.tag == "ol" and "reversed" in node.attributes else 1
        shown = sum(isinstance(c, Node) and c.tag == "li" and c.shown for c in node.children)
        number = _whole(node.attributes.get("start"), shown if step < 0 else 1)
        for child in node.children:
            if isinstance(child, str) or child.tag != "li":
                loose = Node("div")
                loose.children = [child]
                out += self.lines(loose)
            elif child.shown:
                number = _whole(child.attributes.get("value"), number)
                mark = f"{number}. " if node.tag == "ol" else "- "
                number += step
                own = [x for x in self.lines(child) if x] or [""]
                out += [(mark if i == 0 else " " * len(mark)) + x for i, x in enumerate(own)]
        return out

    def table(self, node: Node) -> list[str]:
        above: list[str] = []
        rows: list[list[tuple[list[str], int, int]]] = []
        groups: list[int] = []  # the group of each row, which a rowspan does not leave

        def collect(parent: Node, group: int) -> None:
            for child in parent.children:
                if isinstance(child, str) or not child.shown:
                    continue
                if child.tag == "caption":
                    above.extend(self.lines(child))
                elif child.tag == "tr":
                    cells = []
                    for cell in child.children:
                        if isinstance(cell, Node) and cell.tag in ("td", "th") and cell.shown:
                            cells.append(([x for x in self.lines(cell) if x], min(_span(cell, "colspan"), 1000) or 1, _span(cell, "rowspan")))
                    rows.append(cells)
                    groups.append(group)
                elif child.tag in ("tbody", "thead", "tfoot"):
                    collect(child, id(child))
                else:
                    above.extend(self.lines(_wrap(child)))

        collect(node, 0)
        # Each cell's first column: the next that no cell above still covers. A cell of no rows goes on to its group's end.
        placed: list[list[tuple[int, int, list[str]]]] = []
        covered: dict[int, int] = {}
        for r, cells in enumerate(rows):
            if r and groups[r] != groups[r - 1]:
                covered = {}
            at, line = 0, []
            taken = covered
            covered = {c: n - 1 for c, n in taken.items() if n > 1}
            for own, span, down in cells:
                while at in taken:
                    at += 1
                line.append((at, span, own))
                if down != 1:
                    covered.update(dict.fromkeys(range(at, at + span), len(rows) if down == 0 else down - 1))
                at += span
            placed.append(line)
        widths: dict[int, int] = {}
        for line in placed:
            for at, span, own in line:
                if span == 1 and own:
                    widths[at] = max(widths.get(at, 0), max(map(columns_of, own)))
        columns = sorted(widths)
        before = [0]
        for c in columns:
            before.append(before[-1] + widths[c])

        def left(at: int) -> int:
            """Where a column begins: the widths before it, and two blanks for each column."""
            return before[bisect_left(columns, at)] + 2 * at

        out = above
        for line in placed:
            for i in range(max([len(own) for _, _, own in line], default=0)):
                text = ""
                for at, _, own in line:
                    if i < len(own):
                        gap = left(at) - columns_of(text)
                        text += " " * (gap if gap >= 0 else 2) + own[i]
                out.append(text.rstrip())
        return out


def columns_of(text: str) -> int:
    """The columns that a text takes up: two for wide characters, none for those that combine."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) or unicodedata.category(c) in ("Mn", "Me", "Cf") else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _whole(value: str | None, default: int) -> int:
    """An attribute's whole number."""
    return int(value) if value is not None and re.fullmatch(r"\s*[+-]?\d{1,9}\s*", value) else default


def _span(cell: Node, name: str) -> int:
    """A cell's colspan or rowspan, as far as the standard lets it reach; 1 where there is none."""
    value = cell.attributes.get(name, "1")
    return min(int(value), 65_534) if re.fullmatch(r"\d{1,9}", value) else 1


def drawn(svg: Node) -> list[str]:
    """The texts of a drawing that show, in order."""
    out: list[str] = []
    todo: list[tuple[Node, bool]] = [(svg, False)]
    while todo:
        node, inside = todo.pop()
        inside = inside or node.tag in DRAWN
        own = [c for c in node.children if isinstance(c, str)] if inside and not node.unseen else []
        out += [x for c in own if (x := c.strip())]
        todo += [(c, inside) for c in reversed(node.children) if isinstance(c, Node) and c.shown]
    return out


def _wrap(child: Node) -> Node:
    node = Node("div")
    node.children = [child]
    return node


def visible_text(html: str | None) -> str:
    """All visible text of a page, laid out; a null or empty page gives an empty text."""
    root, rules = parse(html or "")
    deepest = styled(root, rules)
    before = sys.getrecursionlimit()
    sys.setrecursionlimit(max(before, 6 * deepest + 1000))  # the renderer calls itself some times for each level
    try:
        out = Renderer().lines(root)
    finally:
        sys.setrecursionlimit(before)
    return "\n".join(x for i, x in enumerate(out) if x or (i and out[i - 1]))


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages with visible_text and n_lines (0 for an empty text).

    Null pages give empty texts; a broken or unended tag ends the page at worst; elements may be nested to any depth. Pages
    are read whole. Input columns named like an output give way to it; an empty table gives
    an empty table.
    """

    @F.arrow_udf("string")
    def text_of(html: pa.Array) -> pa.Array:
        return pa.array([visible_text(x) for x in html.to_pylist()], pa.string())

    rows = sealed(pages, html=col(html_col)).withColumn("out", text_of("html"))
    n = F.when(F.col("out") == "", 0).otherwise(F.length("out") - F.length(F.replace("out", F.lit("\n"), F.lit(""))) + 1)
    return unsealed(rows, pages.columns, visible_text=F.col("out"), n_lines=n.cast("long"))
