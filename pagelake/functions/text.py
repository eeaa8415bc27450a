"""Text, Markdown and HTML scalar functions as column expressions."""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space at the ends of a text.
BLANKS = " \t\n\r\f\v\x1c\x1d\x1e\x1f\x85\xa0"
# Media types by file suffix.
MIME = {".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".tif": "image/tiff", ".tiff": "image/tiff", ".webp": "image/webp"}
# Names of media resolutions.
RESOLUTIONS = ["low", "medium", "high", "ultra_high"]
EMPTY_BODY = "*(empty transcription — model returned no text)*"
# How a line that is only a page number looks.
PAGE_NUMBER = r"(?imd)^\s*(?:page|seite|pg|p\.?)\s*[:.\-]?\s*(\d+)\s*$"


def strip(text: Column) -> Column:
    """Without white space at both ends; Spark's own trim takes blanks only."""
    return F.btrim(text, F.lit(BLANKS))


def lines(text: Column) -> Column:
    """The lines of a text; a last line feed ends a line and begins none."""
    each = F.split(text, "\r\n|\n|\r", -1)
    return F.when(text == "", F.array().cast("array<string>")).when(F.element_at(each, -1) == "", F.slice(each, 1, F.size(each) - 1)).otherwise(each)


def lookup(values: dict[str, str], key: Column, default: str | None = None) -> Column:
    table = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    found = F.try_element_at(table, key)
    return found if default is None else F.coalesce(found, F.lit(default))


def mime_of(suffix: Column) -> Column:
    return lookup(MIME, F.lower(suffix), "image/png")


def resolution_of(level: Column) -> Column:
    """The full name of a media resolution given short or full; null (the service's default) for anything else."""
    return F.when(F.regexp_replace(level, "^media_resolution_", "").isin(RESOLUTIONS), F.concat(F.lit("media_resolution_"), F.regexp_replace(level, "^media_resolution_", "")))


def natural_key(name: Column) -> Column:
    """Sort key that compares runs of digits as numbers and the rest in lower case, piece by piece."""
    pieces = F.split(F.regexp_replace(name, r"(\d+)", "\x00$1\x00"), "\x00", -1)
    return F.transform(pieces, lambda p, i: F.struct(F.when(i % 2 == 0, F.lower(p)).otherwise("").alias("s"), F.when(i % 2 == 1, p.cast("decimal(38,0)")).otherwise(F.lit(0).cast("decimal(38,0)")).alias("n")))


def page_id(stem: Column, side: Column) -> Column:
    """A page's id: the scan's stem, and its side where it has one."""
    return F.concat_ws("_", stem, side)


def stem_of(name: Column) -> Column:
    return F.regexp_replace(name, r"(?<=[^/])\.[^.]*$", "")


def suffix_of(name: Column) -> Column:
    return F.regexp_extract(name, r"(?<=[^/])(\.[^./]*)$", 1)


def html_escape(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def slug(text: Column) -> Column:
    return F.coalesce(F.nullif(F.btrim(F.regexp_replace(text, "[^a-zA-Z0-9_-]+", "-"), F.lit("-")), F.lit("")), F.lit("page"))


def fence_table(text: Column) -> Column:
    """A bare HTML table in a fence; what is fenced or is no table stays, without white space at its ends."""
    bare = strip(text)
    return F.when(bare.startswith("```"), bare).when(F.lower(bare).startswith("<table"), F.concat(F.lit("```html\n"), bare, F.lit("\n```"))).otherwise(bare)


def close_table(block: Column) -> Column:
    opened = F.contains(block, F.lit("<table")) & ~F.contains(block, F.lit("</table>"))
    return F.when(opened, F.concat(F.rtrim(block, F.lit(BLANKS)), F.lit("\n</table>"))).otherwise(block)


def odd_fences(text: Column) -> Column:
    return F.regexp_count(text, F.lit("(?m)^```")) % 2 == 1


def wrap_tables(html: Column) -> Column:
    """Each table, up to its first end tag, in a container of its own that can scroll."""
    pieces = F.split(html, "(?<=</table>)", -1)
    at = lambda p: F.regexp_instr(p, F.lit("<table\\b"))
    inside = lambda p: F.concat(F.substring(p, F.lit(1), at(p) - 1), F.lit('<div class="table-wrap">'), F.substring(p, at(p), F.length(p)), F.lit("</div>"))
    return F.array_join(F.transform(pieces, lambda p: F.when(p.endswith("</table>") & (at(p) > 0), inside(p)).otherwise(p)), "")


def begins_block(line: Column) -> Column:
    """Whether a line, with its line feed if it has one, plainly begins a block of Markdown: a quote, a rule of dashes, or a
    heading, bullet or number with white space after it."""
    first = F.substring(line, 1, 1)
    blank_first = lambda rest: F.substring(rest, 1, 1).isin(list(BLANKS))
    below_hashes, below_digits = F.ltrim(line, F.lit("#")), F.ltrim(line, F.lit("0123456789"))
    heading = (F.length(line) - F.length(below_hashes)).between(1, 6) & blank_first(below_hashes)
    bullet = first.isin("-", "*") & blank_first(F.substring(line, 2, 2))
    number = first.rlike("[0-9]") & below_digits.startswith(".") & blank_first(F.substring(below_digits, 2, 2))
    return (first == ">") | line.startswith("---") | heading | bullet | number


def close_fence(text: Column) -> Column:
    """A text with an odd number of fences gets the missing one: if an html fence is the one left open, before the first
    blank line that a block of Markdown follows; else at the end."""
    at_end = F.concat(F.rtrim(text, F.lit(BLANKS)), F.lit("\n```\n"))
    # Up to the last fence's line; a lambda takes its elements only, as what else it names is worked out for each of them.
    head = F.regexp_extract(text, "(?smd)\\A(.*^```[^\n]*\n)", 1)
    open_html = F.regexp_extract(head, "(?d)([^\n]*)\n\\z", 1).startswith("```html")
    rest = F.split(F.substring(text, F.length(head) + 1, F.length(text)), "(?<=\n)", -1)
    ends = F.array_position(F.zip_with(rest, F.slice(rest, F.lit(2), F.size(rest)), lambda x, y: (strip(x) == "") & F.coalesce(begins_block(y), F.lit(False))), F.lit(True)).cast("int")
    inserted = F.concat(head, F.array_join(F.slice(rest, F.lit(1), ends - 1), ""), F.lit("```\n"), F.array_join(F.slice(rest, ends, F.size(rest)), ""))
    return F.when(~odd_fences(text), text).when(open_html & (ends > 0), inserted).otherwise(at_end)


#: An html fence with its body, up to the next line that begins with a fence.
_FENCED = r"(?smd)^```html[^\S\n]*\n%s^```"


def unwrap_fences(text: Column) -> Column:
    """Fenced HTML without its fence, with open tables closed; what stands behind the closing fence begins a line. A fence
    that nothing ends is no fence. One pass finds the bodies and one cuts at them."""
    bodies = F.regexp_extract_all(text, F.lit(_FENCED % "(.*?)"), F.lit(1))

    def put(body: Column, after: Column) -> Column:
        table = close_table(F.substring(body, F.lit(1), F.length(body) - 1))  # less the line feed before the fence
        return F.concat(table, F.when((after == "") | after.startswith("\n"), after).otherwise(F.concat(F.lit("\n"), after)))

    around = F.split(text, _FENCED % ".*?", -1)
    return F.concat(F.get(around, F.lit(0)), F.array_join(F.zip_with(bodies, F.slice(around, F.lit(2), F.size(around)), put), ""))


def blank_before_tables(text: Column) -> Column:
    """A blank line between a line of prose and the pipe table right under it.

    Prose begins with none of the marks of Markdown and has more than one character. A table's head stands between two bars;
    the line under it begins with bars around blanks, colons and dashes.
    """

    def prose(row: Column) -> Column:
        numbered = F.substring(row, 1, 1).rlike("[0-9]") & F.ltrim(row, F.lit("0123456789")).startswith(".")
        return (strip(F.substring(row, 2, 2147483647)) != "") & ~F.substring(row, 1, 1).isin("|", "#", ">", "-", "*") & ~numbered

    def head(row: Column) -> Column:
        return row.startswith("|") & strip(row).endswith("|") & (F.length(strip(row)) > 1)

    def rule(row: Column) -> Column:
        inside = F.substring(row, 2, 2147483647)
        marks = F.substring(inside, F.lit(1), F.length(inside) - F.length(F.ltrim(inside, F.lit(BLANKS + ":|-"))))
        return row.startswith("|") & F.contains(F.substring(marks, 2, 2147483647), F.lit("|"))

    rows = F.split(text, "\n", -1)
    near = F.arrays_zip(F.concat(F.array(F.lit("")), rows), rows, F.concat(F.slice(rows, F.lit(2), F.size(rows)), F.array(F.lit(""))))
    under = lambda x: head(x["1"]) & rule(x["2"]) & prose(x["0"])
    spaced = F.transform(near, lambda x: F.when(under(x), F.concat(F.lit("\n"), x["1"])).otherwise(x["1"]))
    return F.array_join(F.slice(spaced, F.lit(1), F.size(rows)), "\n")


def page_number_in(text: Column) -> Column:
    return F.regexp_extract(text, PAGE_NUMBER, 1)


def front_matter(text: Column) -> Column:
    """The map of the key: value lines at a text's head; the last of a repeated key stays."""
    head = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---\n?", 1)
    pairs = F.transform(F.filter(lines(head), lambda x: F.contains(x, F.lit(":"))), lambda x: F.split(x, ":", 2))
    entries = F.transform(pairs, lambda p: F.struct(strip(p[0]).alias("key"), F.btrim(F.btrim(strip(p[1]), F.lit('"')), F.lit("'")).alias("value")))
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    last = F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1))
    return F.map_from_entries(last)


def body_of(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\A---\n(.*?)\n---\n?", "")


def clean_json(text: Column) -> Column:
    """The JSON object in a noisy answer: fences off; else from the first brace to the last that closes it."""
    bare = strip(text)
    opened = F.substring(bare, 4, 2147483647)
    opened = F.when(opened.startswith("json"), F.substring(opened, 5, 2147483647)).otherwise(opened)
    bare = F.when(bare.startswith("```"), F.ltrim(opened, F.lit(BLANKS))).otherwise(bare)
    bare = F.when(bare.endswith("```"), strip(F.substring(bare, F.lit(1), F.length(bare) - 3))).otherwise(strip(bare))
    at = F.position(F.lit("{"), bare)
    tail = F.substring(bare, at, F.length(bare))
    pieces = F.split(tail, "(?<=[{}])")
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("end"))

    def step(acc: Column, p: Column) -> Column:
        depth = acc["depth"] + F.when(p.endswith("{"), 1).when(p.endswith("}"), -1).otherwise(0)
        at = acc["at"] + F.length(p)
        return F.struct(at.alias("at"), depth.alias("depth"), F.when(p.endswith("}") & (depth == 0), at).otherwise(acc["end"]).alias("end"))

    end = F.aggregate(pieces, start, step)["end"]
    whole = bare.startswith("{") & bare.endswith("}")
    return F.when(whole | (at == 0) | (end == 0), bare).otherwise(F.substring(tail, F.lit(1), end))


def object_text(text: str) -> str:
    """clean_json for one text, where the answer is: the last brace at which as many have closed as opened ends the object."""
    bare = text.strip(BLANKS)
    if bare.startswith("```"):
        bare = bare[3:].removeprefix("json").lstrip(BLANKS)
    bare = bare.removesuffix("```").strip(BLANKS)
    if bare[:1] == "{" and bare[-1:] == "}":
        return bare
    braces = [(i, 1 if c == "{" else -1) for i, c in enumerate(bare) if c in "{}"]
    braces = braces[next((k for k, (_, step) in enumerate(braces) if step > 0), len(braces)) :]
    ends = [i for (i, step), depth in zip(braces, accumulate(step for _, step in braces), strict=True) if step < 0 and not depth]
    return bare[braces[0][0] : ends[-1] + 1] if ends else bare


def parsed_answer(text: str) -> object:
    """What the JSON object in a noisy answer holds; ValueError if it does not parse."""
    return json.loads(object_text(text))
