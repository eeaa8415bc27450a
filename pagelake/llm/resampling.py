"""Target-distribution importance resampling: hashed n-gram weights, and an exact draw by weighted median-of-medians.

Every run of one to three words falls into one of 10,000 buckets. A bucket's gain is the log-ratio of its share of the
target's features to its share of the documents'; a document's weight is the sum of its features' gains, looked up in one
array. A Gumbel term by a hash of the id turns the highest scores into a sample without replacement.

The draw never sorts what it does not keep. Each task names the median key that it still holds; the median of those,
weighted by how many keys each stands for, has at least a quarter of all open keys on either side, so each round decides a
quarter at least and about half as a rule. It ends at the exact cutoff key, and the winners alone are sorted.

What crosses the driver: the buckets (their number is a parameter) and one row for each partition of a round.

Cases: a null text has no features (weight 0) and too few words to be drawn; rows with a null id take part in the counts
and get a weight, but no score and no rank; repeated rows are rows of their own, and of rows alike in score and id those
with more features go first; an empty table gives an empty table, and an empty target gives gains all the same (its share
of each bucket is then even). Other columns stay; one named like an output gives its place to it. Texts of any length are
read whole, a slice at a time.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import col, discard, materialize, sealed, unsealed

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_BLANK = zlib.crc32(b" ")
#: Words that are hashed at once, and bytes of a text that are split at once.
_AT_ONCE, _SLICE = 1 << 17, 1 << 20


@functools.lru_cache(maxsize=1)
def _bytewise() -> np.ndarray:
    """What the register of CRC-32 turns a low byte into."""
    return np.array([zlib.crc32(bytes([255 ^ b])) ^ zlib.crc32(b"\xff") for b in range(256)], np.uint32)


@functools.lru_cache(maxsize=2048)
def _shift(n: int) -> np.ndarray:
    """The linear map of n more zero bytes, as a table for each of a register's four bytes."""

    def through(columns: np.ndarray, v: np.ndarray) -> np.ndarray:
        bits = (v[:, None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)
        return np.bitwise_xor.reduce(bits * columns, axis=1)

    unit = np.uint32(1) << np.arange(32, dtype=np.uint32)
    step, out = _bytewise()[unit & 255] ^ (unit >> np.uint32(8)), unit
    while n:
        if n & 1:
            out = through(step, out)
        step, n = through(step, step), n >> 1
    return np.concatenate([through(out, np.arange(256, dtype=np.uint32) << np.uint32(8 * k)) for k in range(4)])


def _shifted(crc: np.ndarray, tables: np.ndarray, at: np.ndarray) -> np.ndarray:
    return tables[at + (crc & 255)] ^ tables[at + 256 + ((crc >> np.uint32(8)) & 255)] ^ tables[at + 512 + ((crc >> np.uint32(16)) & 255)] ^ tables[at + 768 + (crc >> np.uint32(24))]


def words_of(text: bytes) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ with A-Z lower-cased."""
    return text.translate(_FOLD).split()


def _slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    data = text.translate(_FOLD)
    at = 0
    while at < len(data):
        end = len(data) if (end := data.find(b" ", at + _SLICE)) < 0 else end
        yield data[at:end].split()
        at = end


@dataclass
class Part:
    """Hashes of the features that end in some documents' words: features[bounds[k]:bounds[k + 1]] are document row[k]'s."""

    row: list[int]
    words: list[int]
    features: np.ndarray
    bounds: np.ndarray


def hashed_features(texts: list[bytes | None], longest: int = 3) -> Iterator[Part]:
    """CRC-32 of every run of up to `longest` words, joined by one space, without joining them.

    The hash of a run is that of the run before its last word, carried over the length of a blank and this word, and the
    hash of these. A long text comes in several parts, each led by the words that runs into it need.
    """
    row: list[int] = []
    words: list[bytes] = []
    new: list[int] = []
    led: list[int] = []

    def hashed() -> Part:
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        plain = np.fromiter(map(zlib.crc32, words), np.uint32, n)
        lengths, which = np.unique(np.concatenate([size, size + 1]), return_inverse=True)
        tables = np.concatenate([_shift(int(x)) for x in lengths] or [np.zeros(0, np.uint32)])
        word, blank = which[:n] * 1024, which[n:] * 1024
        spaced = _shifted(np.full(n, _BLANK, np.uint32), tables, word) ^ plain
        held = np.asarray(new) + led
        first = np.repeat(np.cumsum(held) - held, held)
        place = np.arange(n) - first
        fresh = place >= np.repeat(led, held)
        out = np.zeros((n, longest), np.uint32)
        there = np.zeros((n, longest), bool)
        run = plain
        for k in range(longest):
            if k:
                run = _shifted(np.concatenate([run[:1], run[:-1]]), tables, blank) ^ spaced
            out[:, k], there[:, k] = run, fresh & (place >= k)
        counts = np.concatenate([[0], np.cumsum(there.sum(axis=1))])
        return Part(list(row), list(new), out[there], counts[np.concatenate([[0], np.cumsum(held)])])

    for i, text in enumerate(texts):
        before: list[bytes] = []
        for got in _slices(text) if text else ():
            if got:
                row.append(i)
                words += before + got
                new.append(len(got))
                led.append(len(before))
                before = (before + got)[1 - longest :] if longest > 1 else []
                if len(words) >= _AT_ONCE:
                    yield hashed()
                    for x in (row, words, new, led):
                        x.clear()
    if words:
        yield hashed()


def feature_counts(docs: DataFrame, text: Column, buckets: int) -> DataFrame:
    """(bucket, n) over all rows: each task counts in an array of its own."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in hashed_features(batch["text"].to_pylist()):
                n += np.bincount(part.features % np.uint32(buckets), minlength=buckets)
        there = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(n[there], pa.int64())], ["bucket", "n"])

    each = docs.select(text.cast("binary").alias("text")).mapInArrow(counted, "bucket long, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = 10_000, text: str = "text") -> np.ndarray:
    """The gain of each bucket; the driver sees one number of each bucket and side."""
    sides = [np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)]
    for side, df in zip(sides, (docs, target), strict=True):
        for r in feature_counts(df, col(text), buckets).collect():
            side[r.bucket] = r.n
    (s, t), (all_s, all_t) = (x.tolist() for x in sides), (int(x.sum()) for x in sides)
    return np.array([math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)], np.int64)


def noise(seed: int, doc_id: int) -> int:
    """A standard Gumbel variate in thousandths, by the first 32 bits of a digest of the id."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(text: Column, key: Column, gain: np.ndarray, seed: int) -> Column:
    """struct(n_words, n_features, weight, score) of a text, by the array of gains."""

    @F.arrow_udf("n_words long, n_features long, weight long, score long")
    def weigh(text: pa.Array, key: pa.Array) -> pa.Array:
        n = len(text)
        words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
        for part in hashed_features(text.to_pylist()):
            sums = np.concatenate([[0], np.cumsum(gain[part.features % np.uint32(len(gain))])])
            np.add.at(words, part.row, part.words)
            np.add.at(features, part.row, np.diff(part.bounds))
            np.add.at(weight, part.row, np.diff(sums[part.bounds]))
        score = [None if k is None else w + noise(seed, k) for w, k in zip(weight.tolist(), key.to_pylist(), strict=True)]
        return pa.StructArray.from_arrays([pa.array(words), pa.array(features), pa.array(weight), pa.array(score, pa.int64())], ["n_words", "n_features", "weight", "score"])

    return weigh(text.cast("binary"), key)


Key = tuple[int, int]


def _middle(score: np.ndarray, key: np.ndarray) -> Key | None:
    """The median in the order of descending score, then ascending id."""
    if not len(score):
        return None
    at = np.lexsort((key, -score))[(len(score) - 1) // 2]
    return int(score[at]), int(key[at])


def _before(score: np.ndarray, key: np.ndarray, pivot: Key) -> np.ndarray:
    return (score > pivot[0]) | ((score == pivot[0]) & (key < pivot[1]))


def _weighted_middle(found: list[tuple[int, Key]]) -> Key:
    """The median of keys that stand for so many each."""
    found = sorted(found, key=lambda x: (-x[1][0], x[1][1]))
    half, n = (sum(n for n, _ in found) + 1) // 2, 0
    for count, key in found:
        n += count
        if n >= half:
            break
    return key


def cutoff(keys: DataFrame, take: int) -> tuple[Key, int]:
    """Of keys(score, id), no nulls: the last key of the first `take` by descending score, then id; and how many come before it.

    Each round is one pass that counts the open keys on either side of the pivot and names each task's median on both, so
    the next pivot is there whichever side stays open. Open keys are written anew when they are under a quarter of those
    that a round has to read.
    """

    def sides(pivot: Key | None, above: Key | None, below: Key | None) -> list[list[tuple[int, Key | None]]]:
        """For each partition (count, median) of the open keys before the pivot, at it and after it; open: after above, before below."""

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple[np.ndarray, np.ndarray]] = []
            for batch in batches:
                score, key = (batch[c].to_numpy(zero_copy_only=False) for c in ("score", "id"))
                keep = np.ones(len(score), bool)
                if above:
                    keep &= ~_before(score, key, above) & ~((score == above[0]) & (key == above[1]))
                if below:
                    keep &= _before(score, key, below)
                held.append((score[keep], key[keep]))
            if held:
                score, key = (np.concatenate(x) for x in zip(*held, strict=True))
                first = _before(score, key, pivot) if pivot else np.ones(len(score), bool)
                same = (score == pivot[0]) & (key == pivot[1]) if pivot else ~first
                rows = [(side, int(m.sum()), *(_middle(score[m], key[m]) or (0, 0))) for side, m in enumerate((first, same, ~first & ~same))]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows if r[1]], pa.int64()) for i in range(4)], ["side", "n", "score", "id"])

        out: list[list[tuple[int, Key | None]]] = [[], [], []]
        for r in now.mapInArrow(split, "side long, n long, score long, id long").collect():
            out[r.side].append((r.n, (r.score, r.id)))
        return out

    now = materialize(keys.select("score", "id"), "draw-keys")
    above = below = None
    open_ = sides(None, None, None)[0]
    read = n = sum(x for x, _ in open_)
    before = 0
    if not 1 <= take <= n:
        raise ValueError(f"{take} of {n} keys")
    while True:
        pivot = _weighted_middle(open_)
        first, same, last = sides(pivot, above, below)
        n_first, n_same = (sum(x for x, _ in part) for part in (first, same))
        if before + n_first < take <= before + n_first + n_same:
            discard(now.sparkSession, now)
            return pivot, before + n_first
        if take <= before + n_first:
            open_, below = first, pivot
        else:
            open_, above, before = last, pivot, before + n_first + n_same
        n = sum(x for x, _ in open_)
        if n < read // 4:
            read, rest = n, now
            if above:
                rest = rest.where((F.col("score") < above[0]) | ((F.col("score") == above[0]) & (F.col("id") > above[1])))
            if below:
                rest = rest.where((F.col("score") > below[0]) | ((F.col("score") == below[0]) & (F.col("id") < below[1])))
            now = materialize(rest, "draw-keys", now)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with 1, 2, 3, ... by the order: ranges are sorted each in a task, and moved on by the sizes of those before."""
    rows = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "draw-sorted")
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect()
    offsets, total = [], 0
    for r in sizes:
        offsets.append((r["_part"], total))
        total += r.n
    moved = df.sparkSession.createDataFrame(offsets, "_part long, _before long")
    out = rows.withColumn("_part", part).join(F.broadcast(moved), "_part")
    return out.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_at", "_part", "_before")


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 5, least_words: int = 20, buckets: int = 10_000, seed: int = 42, key: str = "doc_id", text: str = "text", texts: bool = True) -> DataFrame:
    """docs with n_features, weight, score and rank; rank counts the drawn from 1 and is null for the others.

    percent: of the documents with least_words words at least, rounded down. key is an integer column. texts: keep the
    text column.
    """
    gain = gains(docs, target, buckets, text)
    columns = docs.columns if texts else [c for c in docs.columns if c != text]
    own = {"id": col(key).cast("long"), "found": weighed(col(text), col(key).cast("long"), gain, seed)}
    rows = sealed(docs.select(*map(col, docs.columns)), **own)
    passed = [f"in_{i}" for i, c in enumerate(docs.columns) if c in columns]
    scored = materialize(rows.select(*[F.col(old).alias(f"in_{i}") for i, old in enumerate(passed)], "id", "found.*"), "draw-scored")
    fit = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    take = percent * scored.where(fit).count() // 100
    outputs = ("n_features", "weight", "score", "rank")
    none = F.lit(None).cast("long")
    if not take:
        return unsealed(scored.withColumn("rank", none), columns, **{c: F.col(c) for c in outputs})
    (score, last), _ = cutoff(scored.where(fit), take)
    drawn = fit & ((F.col("score") > score) | ((F.col("score") == score) & (F.col("id") <= last)))
    order = [F.col("score").desc(), F.col("id").asc(), F.col("n_features").desc()]
    winners = numbered(scored.where(drawn), order, "rank")
    winners = winners.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")))
    rest = scored.where(~F.coalesce(drawn, F.lit(False))).withColumn("rank", none)
    return unsealed(winners.unionByName(rest), columns, **{c: F.col(c) for c in outputs})
