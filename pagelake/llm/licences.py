"""Licence scans: an Aho-Corasick automaton for tags and notices, a shunting-yard parser for and/or/with expressions.

A text's words are joined by single blanks, and one pass of the automaton names every place of every phrase, overlapping
ones too; phrases begin and end with a blank, so they are whole words. Two kinds of expression are evaluated:

* what follows an identifier tag up to the end of its line, read from the text as it is: identifiers, parentheses and the
  operators `and`, `or`, `with` (binding: with, and, or);
* notices in a row with nothing between them but operators and filler words ("the MIT license or the Apache license").

A licence has a restriction from 0 (do as you like, with a notice) to 1 (all rights reserved). Of alternatives the reader
takes the least restricting one, joint licences restrict as much as the most restricting one, and an exception takes back a
step of copyleft. A document restricts as much as its most restricting expression. The score is the evidence that the
document states a licence at all: each place leaves so much doubt, and doubts multiply.

Cases: a null or empty text has no words, no places and score 0; an expression that does not parse (two operands in a row
end one; an operand or a parenthesis is missing) has a null restriction, and its identifiers still count as labels; unknown
identifiers are labels of their own and restrict wholly; repeated rows are treated alike; an empty table gives an empty
table; other columns stay, and one named like an output gives its place to it. Texts are read whole.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import col, sealed, unsealed
from pagelake.llm.resampling import words_of

#: The phrases that every scan counts, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices as words, and the identifier that each stands for.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache license": "apache-2.0",
    "apache license version 2 0": "apache-2.0",
    "apache 2 0": "apache-2.0",
    "bsd license": "bsd-3-clause",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "redistribution and use in source and binary forms": "bsd-3-clause",
    "isc license": "isc",
    "zlib license": "zlib",
    "boost software license": "bsl-1.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "public domain": "public-domain",
    "mozilla public license": "mpl-2.0",
    "eclipse public license": "epl-2.0",
    "lesser general public license": "lgpl",
    "lesser general public license version 2 1": "lgpl-2.1",
    "lesser general public license version 3": "lgpl-3.0",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "affero general public license": "agpl-3.0",
    "gpl v2": "gpl-2.0",
    "gpl v3": "gpl-3.0",
    "cc0": "cc0-1.0",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "proprietary and confidential": "proprietary",
    "classpath exception": "classpath-exception",
    "linking exception": "linking-exception",
}
TAGS = ("spdx license identifier", "license expression")
#: Beginnings of identifiers, and how much a licence of the family restricts, in fifths.
FAMILIES = {
    "0bsd": 0, "agpl": 3, "apache": 0, "artistic": 1, "bsd": 0, "bsl": 0, "cc-by": 0, "cc-by-nc": 4, "cc-by-nd": 4, "cc-by-sa": 2, "cc0": 0, "cddl": 1, "epl": 1,
    "eupl": 2, "gpl": 2, "isc": 0, "lgpl": 1, "mit": 0, "mpl": 1, "public-domain": 0, "python": 0, "unlicense": 0, "zlib": 0,
}
BINDING = {"or": 1, "and": 2, "with": 3}
FILLERS = frozenset("the a either both under terms of gnu license licenses version v1 v2 v3 0 1 2 3 4 and or with".split())
#: How much doubt a place of its kind leaves that the document states a licence.
DOUBT = {"tag": 0.01, "notice": 0.1, "base": 0.3}
_TOKEN = re.compile(rb"[ \t]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+:-]*))")


def restriction(identifier: str) -> int:
    """Fifths, by the longest family that the identifier begins with; 5 for others."""
    parts = identifier.rstrip("+").split("-")
    return next((FAMILIES[f] for k in range(len(parts), 0, -1) if (f := "-".join(parts[:k])) in FAMILIES), 5)


def postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard; None where operators, operands and parentheses do not fit together."""
    out: list[str] = []
    waiting: list[str] = []
    operand_next = True
    for token in tokens:
        if token == "(":
            if not operand_next:
                return None
            waiting.append(token)
        elif token == ")":
            if operand_next:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif token in BINDING:
            if operand_next:
                return None
            while waiting and waiting[-1] != "(" and BINDING[waiting[-1]] >= BINDING[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand_next = True
        else:
            if not operand_next:
                return None
            out.append(token)
            operand_next = False
    if operand_next or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluated(order: list[str]) -> int:
    """The restriction of an expression in postfix order, in fifths."""
    held: list[int] = []
    for token in order:
        if token in BINDING:
            b, a = held.pop(), held.pop()
            held.append(min(a, b) if token == "or" else max(a, b) if token == "and" else a - 1 if 1 <= a <= 3 else a)
        else:
            held.append(restriction(token))
    return held[0]


def tagged_tokens(line: bytes) -> tuple[list[str], int]:
    """The tokens of an expression at the beginning of a line, up to what is no token or a second operand in a row; its end."""
    out: list[str] = []
    at, operand_next, depth = 0, True, 0
    while m := _TOKEN.match(line, at):
        token = (m[1] or m[2]).decode().lower()
        operator = token in BINDING
        if token == ")" and not depth or not operand_next and token != ")" and not operator:
            break
        depth += (token == "(") - (token == ")")
        if token not in "()":
            token = token.rstrip(".:-") or token
            operand_next = operator
        out.append(token)
        at = m.end()
    return out, at


@functools.lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Every phrase with its kinds: (kind, label, number of words)."""
    found: dict[str, list[tuple[str, str, int]]] = {}
    for kind, phrases in (("base", BASE), ("notice", NOTICES), ("tag", dict.fromkeys(TAGS, ""))):
        for phrase, label in phrases.items():
            found.setdefault(phrase, []).append((kind, label, phrase.count(" ") + 1))
    out = ahocorasick.Automaton()
    for phrase, kinds in found.items():
        out.add_word(f" {phrase} ", kinds)
    out.make_automaton()
    return out


@dataclass
class Scan:
    """What a text holds: places (kind, label, first word, words) and expressions (first word, written, restriction)."""

    n_words: int
    places: list[tuple[str, str, int, int]]
    expressions: list[tuple[int, str, int | None]]
    labels: set[str]


def scanned(text: bytes) -> Scan:
    words = words_of(text)
    joined = b" ".join([b"", *words, b""])
    hits = list(automaton().iter(joined.decode("latin-1")))
    out = Scan(len(words), [], [], set())
    if not hits:
        return out
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    for last, kinds in hits:
        end = int(np.searchsorted(blanks, last))
        out.places += [(kind, label, end - n, n) for kind, label, n in kinds]
    out.places.sort(key=lambda p: (p[2], p[3], p[0]))
    out.labels |= {label for _, label, _, _ in out.places if label}
    tags = [p for p in out.places if p[0] == "tag"]
    _notice_expressions(words, _tag_expressions(text, words, tags, out) if tags else set(), out)
    return out


def _tag_expressions(text: bytes, words: list[bytes], tags: list[tuple[str, str, int, int]], out: Scan) -> set[int]:
    """What stands behind each tag, in the text as it is; the words that are taken by it."""
    taken: set[int] = set()
    need = {first + n - 1 for _, _, first, n in tags}
    ends, at, low = {}, 0, text.translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))
    for i, w in enumerate(words):
        at = low.index(w, at) + len(w)
        if i in need:
            ends[i] = at
    for _, _, first, n in tags:
        begin = ends[first + n - 1]
        end = text.find(b"\n", begin)
        line = text[begin : end if end >= 0 else len(text)].lstrip(b" \t:=\"'*")
        tokens, size = tagged_tokens(line)
        if not tokens:
            continue
        taken |= set(range(first, first + n + len(words_of(line[:size]))))
        order = postfix(tokens)
        out.labels |= {t for t in tokens if t not in BINDING and t not in "()"}
        out.expressions.append((first, " ".join(tokens), None if order is None else evaluated(order)))
    return taken


def _notice_expressions(words: list[bytes], taken: set[int], out: Scan) -> None:
    """Notices that only operators and fillers stand between; of overlapping ones the leftmost longest counts.

    An exception alone, with no licence before it, is no expression.
    """
    chosen: list[tuple[str, int, int]] = []
    for kind, label, first, n in sorted(out.places, key=lambda p: (p[2], -p[3], p[0] == "base")):
        if kind != "tag" and first not in taken and (not chosen or first >= chosen[-1][2]):
            chosen.append((label, first, first + n))
    group: list[str] = []
    start = 0

    def close() -> None:
        if group:
            order = postfix(group)
            out.expressions.append((start, " ".join(group), None if order is None else evaluated(order)))

    for k, (label, first, _) in enumerate(chosen):
        between = words[chosen[k - 1][2] : first] if k else []
        operators = [w.decode() for w in between if w in (b"and", b"or", b"with")]
        if group and len(between) <= 8 and len(operators) == 1 and all(w.decode("latin-1") in FILLERS for w in between):
            group += [operators[0], label]
        else:
            close()
            group, start = ([] if label.endswith("-exception") else [label]), first
    close()
    out.expressions.sort()


def score(scan: Scan) -> float:
    doubt = 1.0
    for kind, _, _, _ in scan.places:
        doubt *= DOUBT[kind]
    return 1.0 - doubt


_STRUCT = "struct<n_words bigint, places array<struct<kind string, label string, word bigint, words bigint>>, expressions array<struct<word bigint, written string, restriction double>>, labels array<string>, score double>"


def _scans(text: Column) -> Column:
    @F.arrow_udf(_STRUCT)
    def scan(text: pa.Array) -> pa.Array:
        found = [scanned(t or b"") for t in text.to_pylist()]

        def nested(each: list[list[tuple]], names: list[str], kinds: list[pa.DataType]) -> pa.ListArray:
            flat = [x for rows in each for x in rows]
            columns = [pa.array([x[i] for x in flat], kind) for i, kind in enumerate(kinds)]
            return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, each)]), pa.int32()), pa.StructArray.from_arrays(columns, names))

        long, double, string = pa.int64(), pa.float64(), pa.string()
        return pa.StructArray.from_arrays(
            [
                pa.array([s.n_words for s in found], long),
                nested([s.places for s in found], ["kind", "label", "word", "words"], [string, string, long, long]),
                nested([[(w, t, None if r is None else r / 5) for w, t, r in s.expressions] for s in found], ["word", "written", "restriction"], [long, string, double]),
                pa.array([sorted(s.labels) for s in found], pa.list_(string)),
                pa.array([score(s) for s in found], double),
            ],
            ["n_words", "places", "expressions", "labels", "score"],
        )

    return scan(text.cast("binary"))


def scan_licences(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, places, expressions, labels, score and restriction (null without an expression that parses).

    No shuffle: a text is scanned where it is read.
    """
    out = sealed(docs, found=_scans(col(text)))
    names = ("n_words", "places", "expressions", "labels", "score")
    worst = F.array_max(F.transform("found.expressions", lambda e: e["restriction"]))
    return unsealed(out, docs.columns, **{c: F.col(f"found.{c}") for c in names}, restriction=worst)


def base_places(places: Column) -> Column:
    return F.filter(places, lambda p: p["kind"] == "base")
