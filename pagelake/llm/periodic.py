"""Periodic runs of words: every maximal stretch that repeats with some period, found by seeds and diagonals.

A run of smallest period q and length of at least max(12, 2q) agrees with itself, moved by q, over at least
max(12 - q, q) words, so over six at least. Lags are taken in classes [k, 2k) for k = 6, 12, 24, ...; for a class the seeds
are the k-grams that occur twice in a document, which is the overlap that its runs are sure to have. Two occurrences name a
diagonal (a lag); it is extended to both sides once, and a table by lag of how far it is covered skips the seeds inside.

Not every pair of occurrences is needed. Occurrences at steps of up to k/2 form chains of one step, the seed's own
period, so a chain lies in a run of that period. Let a diagonal of a class begin at a, and take its seeds there: were
neither seed the first of its chain, both runs around them would go on to the left, and so would the diagonal. Hence a
pair of the first of a chain and a seed of another chain lies on every diagonal that counts (within a chain lags are
multiples of the smaller period), and in the first class the next occurrence serves all lags up to six. Such pairs are
linear in the words for each class, whatever repeats: a text of one word over and over has one chain.

All documents of a batch are searched together; words between them that occur nowhere else keep diagonals apart.

Cases: a null or empty text has no words and no runs; rows that repeat are treated alike; an empty table gives an empty
table; other columns stay, and one named like an output gives its place to it. Whole texts are read, however long; a task
holds one batch of up to half a million words or one document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import col, sealed, unsealed

#: Words in a seed of the first class, and shortest length of a run: its double.
SEED = 6
_TOGETHER = 1 << 19


def _ids(pairs: np.ndarray) -> np.ndarray:
    return np.unique(pairs, return_inverse=True)[1].astype(np.int64)


def _repeated(ids: np.ndarray) -> np.ndarray:
    return np.bincount(ids)[ids] > 1 if len(ids) else np.zeros(0, bool)


def _first_seeds(x: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of six words that occur again in their document, ascending, and what they are, numbered for each document.

    A hash finds them; the numbers come from the words.
    """
    n = len(x) - SEED + 1
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spread = np.random.default_rng(SEED).integers(1, 1 << 62, int(max(x.max(), doc.max())) + 1, dtype=np.int64).view(np.uint64)
    h = spread[doc[:n]].copy()
    for k in range(SEED):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + spread[x[k : n + k]]
    order = np.argsort(h)
    h = h[order]
    same = h[1:] == h[:-1]
    at = np.sort(order[np.concatenate([same, [False]]) | np.concatenate([[False], same])])
    ids = doc[at]
    for k in range(SEED):
        ids = _ids(ids * (int(x.max()) + 1) + x[at + k])
    keep = _repeated(ids)
    return at[keep], ids[keep]


def _longer(at: np.ndarray, ids: np.ndarray, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The seeds of 2k words from those of k."""
    place = np.full(n + k, -1, np.int64)
    place[at] = np.arange(len(at))
    rest = place[at + k]
    there = rest >= 0
    at, ids = at[there], _ids(ids[there] * len(place) + ids[rest[there]])
    keep = _repeated(ids)
    return at[keep], ids[keep]


def _spans(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every index of the ranges low..high-1, and which range it is of."""
    n = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(n)), n)
    return low[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n), which


def _pairs(at: np.ndarray, ids: np.ndarray, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) of the pairs of occurrences that the lags of a class need."""
    order = np.argsort(ids, kind="stable")
    at, ids = at[order], ids[order]
    step = np.diff(at)
    joined = ids[1:] == ids[:-1]
    key = ids * (n + 4 * k) + at
    first = np.flatnonzero(np.concatenate([[True], ~(joined & (step <= k // 2))]))
    other = np.append(first[1:], len(at))
    later, a = _spans(np.maximum(np.searchsorted(key, key[first] + k), other), np.searchsorted(key, key[first] + 2 * k))
    sooner, b = _spans(np.searchsorted(key, key[first] - 2 * k, side="right"), np.searchsorted(key, key[first] - k, side="right"))
    lag, place = [at[later] - at[first[a]], at[first[b]] - at[sooner]], [at[first[a]], at[sooner]]
    if k == SEED:
        near = np.flatnonzero(joined & (step < 2 * k))
        lag.append(step[near])
        place.append(at[near])
    return np.concatenate(lag), np.concatenate(place)


def _agree(x: np.ndarray, i: int, q: int, way: int) -> int:
    """How many words from i on agree with those q further on; way -1: to the left of i."""
    n, block = 0, 32
    while True:
        lo, hi = (i + n, min(i + n + block, len(x) - q)) if way > 0 else (max(i - n - block, 0), i - n)
        if lo >= hi:
            return n
        differ = np.flatnonzero(x[lo:hi] != x[lo + q : hi + q])
        if len(differ):
            return n + int(differ[0] if way > 0 else hi - lo - 1 - differ[-1])
        n, block = n + hi - lo, block * 2


def _diagonals(x: np.ndarray, lag: np.ndarray, place: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, lag) of the repetitions on the diagonals of the pairs."""
    if not len(lag):
        return
    order = np.lexsort((place, lag))
    lag, place = lag[order], place[order]
    head = np.flatnonzero(np.concatenate([[True], (lag[1:] != lag[:-1]) | (np.diff(place) > k)]))
    tail = np.append(head[1:], len(lag)) - 1
    now, covered = -1, 0
    for q, i, last in zip(lag[head].tolist(), place[head].tolist(), place[tail].tolist(), strict=True):
        if q != now:
            now, covered = q, 0
        if i < covered:
            continue
        covered = last + k + _agree(x, last + k, q, 1)
        start = i - _agree(x, i, q, -1)
        if covered - start >= max(2 * SEED - q, q):
            yield start, covered - start + q, q


def runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For each document's word numbers (from 0 up, alike in all documents) the rows (start, length, period) of its runs.

    They are ordered by start, then period. A stretch that two lags agree on counts for the smaller.
    """
    top = max((int(t.max()) for t in texts if len(t)), default=-1) + 1
    size = np.array([len(t) for t in texts], np.int64)
    start = np.cumsum(size + 1) - size
    x = np.full(int(start[-1] + size[-1]) + 1 if len(texts) else 1, -1, np.int64)
    for s, t in zip(start.tolist(), texts, strict=True):
        x[s : s + len(t)] = t
    gaps = np.flatnonzero(x < 0)
    x[gaps] = top + np.arange(len(gaps))
    doc = np.searchsorted(start, np.arange(len(x)), side="right")
    at, ids = _first_seeds(x, doc)
    found: list[tuple[int, int, int]] = []
    k = SEED
    while len(at):
        found += _diagonals(x, *_pairs(at, ids, k, len(x)), k)
        at, ids = _longer(at, ids, k, len(x))
        k *= 2
    rows = np.array(sorted(found), np.int64).reshape(-1, 3)
    least = np.ones(len(rows), bool)
    least[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[least]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    cuts = np.searchsorted(rows[:, 0], np.append(start, len(x)))
    return [rows[a:b] - np.array([s, 0, 0]) for a, b, s in zip(cuts, cuts[1:], start, strict=False)]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one blank."""
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(compress(words, (np.cumsum(edge[:-1]) == 0).tolist()))


def searched(text: Column) -> Column:
    """struct(runs, collapsed) of a text."""

    @F.arrow_udf("struct<runs array<struct<start bigint, length bigint, period bigint>>, collapsed binary>")
    def search(text: pa.Array) -> pa.Array:
        data = [t or b"" for t in text.to_pylist()]
        found: list[np.ndarray] = []
        held: list[np.ndarray] = []
        number: dict[bytes, int] = {}
        n = 0
        for t in data:
            words = t.split()
            held.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
            if (n := n + len(words)) >= _TOGETHER:
                found += runs_of(held)
                held, number, n = [], {}, 0
        found += runs_of(held)
        kept = [collapsed(t.split(), runs) if len(runs) else b" ".join(t.split()) for t, runs in zip(data, found, strict=True)]
        rows = np.concatenate([*found, np.zeros((0, 3), np.int64)])
        each = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], ["start", "length", "period"])
        runs = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), each)
        return pa.StructArray.from_arrays([runs, pa.array(kept, pa.binary())], ["runs", "collapsed"])

    return search(text.cast("binary"))


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with runs (array of start, length, period, in words from 0) and collapsed, the text without what they repeat.

    No shuffle: a document is searched where it is read.
    """
    out = sealed(docs, found=searched(col(text)))
    return unsealed(out, docs.columns, runs=F.col("found.runs"), collapsed=F.col("found.collapsed").cast("string"))


def planted(words: list[bytes], h: int) -> list[bytes]:
    """Words whose end repeats: from a place on they are the same few words again and again, both by h."""
    g = h // 10
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(len(words) - a) // p))[: len(words) - a]


def with_planted_run(text: Column, key: Column) -> Column:
    """The text, whose end repeats where crc32 of the id as text ends in 0; a null id plants nothing."""

    @F.arrow_udf("binary")
    def plant(text: pa.Array, key: pa.Array) -> pa.Array:
        out = text.to_pylist()
        for i, k in enumerate(key.to_pylist()):
            if k is not None and (h := zlib.crc32(str(k).encode())) % 10 == 0 and (words := (out[i] or b"").split()):
                out[i] = b" ".join(planted(words, h))
        return pa.array(out, pa.binary())

    return plant(text.cast("binary"), key).cast("string")


def longest(runs: Column) -> Column:
    """The run of greatest length; of those the first, then the one of the smallest period."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period"))


def written(runs: Column) -> Column:
    """start,length,period of every run, a line each."""
    return F.concat_ws("", F.transform(runs, lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))))
