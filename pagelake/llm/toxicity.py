"""Toxicity by a subsequence string kernel.

A unit is a word, or a run of spaced single letters closed up. The gap-weighted subsequence kernel of order three compares
units through all common subsequences of three characters, each weighted by decay ** (its span in both strings), so
inserted or missing characters lower a likeness but do not end it. Nystroem landmarks turn the kernel into a short vector;
a linear support vector machine separates witness units of toxic texts from units of clean ones. First witnesses come from
the contexts of words; then the machine is fitted anew to the witnesses that it finds in each labelled text (multiple
instances with one label). Units carry marks for their start and end. A text scores by its most toxic unit and by the sum and the share of its toxic units' margins, through
a logistic curve fitted on labelled texts.

The classifier is fitted on a bounded sample of labelled rows, chosen by a hash of the id: at most a quarter of max_texts
toxic ones and three quarters clean ones, weighted back to their true shares. The contexts of units are counted over that
sample in Spark; the driver gets at most max_units units of each kind at a time. Every text is scored.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import col, discard, hash_sample, held, materialize, sealed, unsealed

DECAY = 0.6
WIDTH = 16
FLOOR = -0.5
#: Triples that are worked out at a time, in some arrays of eight bytes: 245 units of the longest, thousands of short ones.
BLOCK = 200_000
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_CLOSED = re.compile(r"[\W_]+")
#: Evidence that makes a unit a first witness: its log-likelihood ratio, and the least share of its contexts that are toxic.
LEAST_RATIO, LEAST_SHARE = 20.0, 0.8
#: How often the machine is fitted anew to the witnesses that it finds itself in labelled texts.
ROUNDS = 1
_SPACED = re.compile(r"(?<!\S)\w(?:[ ._*-]\w){2,}(?!\S)")


@lru_cache(maxsize=WIDTH + 3)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Position triples of a string of n characters and their weights."""
    at = np.array(list(combinations(range(n), 3)), np.int64).reshape(-1, 3)
    return at, DECAY ** (at[:, 2] - at[:, 0] + 1.0)


def _codes(units: list[str], at: np.ndarray) -> np.ndarray:
    """The characters at the positions of each triple, as one number, for units of one length."""
    points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(units), -1).astype(np.uint64)
    return (points[:, at[:, 0]] << np.uint64(42)) | (points[:, at[:, 1]] << np.uint64(21)) | points[:, at[:, 2]]


def features(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, character triple and value of every entry of the units' normalised kernel feature vectors.

    The dot product of two such vectors is the normalised kernel.
    """
    rows, codes, values = [], [], []
    units = [f"^{u}$" for u in units]
    sizes = np.array([len(u) for u in units], np.int64)
    for n in np.unique(sizes):
        own = np.flatnonzero(sizes == n)
        at, weight = _triples(int(n))
        code = _codes([units[i] for i in own], at)
        order = np.argsort(code, axis=1)
        code, value = np.take_along_axis(code, order, 1), weight[order]
        first = np.ones(code.shape, bool)
        first[:, 1:] = code[:, 1:] != code[:, :-1]
        flat = np.flatnonzero(first.ravel())
        total = np.add.reduceat(value.ravel(), flat)
        row = flat // code.shape[1]
        norm = np.sqrt(np.bincount(row, total * total, len(own)))
        rows.append(own[row])
        codes.append(code.ravel()[flat])
        values.append(total / norm[row])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    return np.concatenate(rows), np.concatenate(codes), np.concatenate(values)


def windows(word: str) -> list[str]:
    """A word of at most WIDTH characters; a longer one as overlapping windows, so that each run of half of WIDTH is whole in one."""
    if len(word) <= WIDTH:
        return [word]
    return [word[i : i + WIDTH] for i in range(0, len(word) - WIDTH // 2, WIDTH // 2)]


def units_of(text: str) -> set[str]:
    """The units of a text: words without punctuation at their ends, and runs of spaced letters closed up.

    A word with punctuation inside also counts without it; a long word counts as overlapping windows, closed up or not.
    """
    out = set()
    found = set(text.lower().split())
    found.update(_CLOSED.sub("", m[0]) for m in _SPACED.finditer(text.lower()))
    for word in found:
        if not word.isalnum():
            word = _EDGE.sub("", word)
            if word and not word.isalnum():
                out.update(windows(_CLOSED.sub("", word)))
        out.update(windows(word))
    out.discard("")
    return out


@dataclass
class Model:
    """A scalar for each character triple that a landmark has: the machine's weights carried back through the map."""

    codes: np.ndarray
    gains: np.ndarray
    bias: float
    curve: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0)
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def __post_init__(self):
        self.bits = np.zeros(1 << 18, bool)
        self.bits[self._slot(self.codes)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)

    def margins(self, units: list[str]) -> np.ndarray:
        """The machine's margin of each unit, or FLOOR where it is not above that.

        The gain is summed over all triples first; only where it could lift the margin over FLOOR, even with the least
        norm that a unit of that length can have, the exact norm is worked out.
        """
        out = np.full(len(units), FLOOR)
        marked = [f"^{u}$" for u in units]
        sizes = np.array([len(u) for u in marked], np.int64)
        of_length = [np.flatnonzero(sizes == n) for n in np.unique(sizes)]
        steps = [max(1, BLOCK // max(1, len(_triples(int(sizes[rows[0]]))[1]))) for rows in of_length]
        for own in [rows[i : i + step] for rows, step in zip(of_length, steps, strict=True) for i in range(0, len(rows), step)]:
            at, weight = _triples(int(sizes[own[0]]))
            code = _codes([marked[i] for i in own], at)
            row, column = np.nonzero(self.bits[self._slot(code)])
            found = code[row, column]
            place = np.minimum(np.searchsorted(self.codes, found), len(self.codes) - 1)
            gain = np.bincount(row, np.where(self.codes[place] == found, self.gains[place] * weight[column], 0.0), len(own))
            own = own[gain / np.sqrt((weight**2).sum()) + self.bias > FLOOR]
            rows, codes, values = features([units[i] for i in own])
            place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            out[own] = np.maximum(FLOOR, np.bincount(rows, np.where(self.codes[place] == codes, values * self.gains[place], 0.0), len(own)) + self.bias)
        return out

    def of_units(self, texts: list[str | None]) -> tuple[list[set[str]], dict[str, float]]:
        """The units of each text, and the margins of all of them; what a worker has worked out once it keeps."""
        known: dict[str, float] = held(f"toxicity-{self.name}", dict)
        if len(known) > _MOST_KNOWN:
            known.clear()
        each = [units_of(t or "") for t in texts]
        fresh = list(set().union(*each) - known.keys()) if each else []
        for i in range(0, len(fresh), 4096):
            known.update(zip(fresh[i : i + 4096], self.margins(fresh[i : i + 4096]).tolist(), strict=True))
        return each, known

    def of_texts(self, texts: list[str | None]) -> np.ndarray:
        """For each text: the highest margin of its units (FLOOR if there is none above it), then how much is toxic in all, and for each unit."""
        each, known = self.of_units(texts)
        out = np.zeros((len(texts), 3))
        for row, own in zip(out, each, strict=True):
            margins = [known[u] for u in own]
            toxic = sum(m - FLOOR for m in margins if m > FLOOR)
            row[:] = max(margins, default=FLOOR), np.log1p(toxic), np.log1p(100 * toxic / (len(own) + 10))
        return out


_MOST_KNOWN = 200_000


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Linear support vector machine with squared hinge loss, by Newton steps on the points inside the margin."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        inside = y * (x @ w) < 1
        xi = x[inside] * weight[inside, None]
        new = np.linalg.solve(xi.T @ x[inside] + ridge * np.eye(x.shape[1]), xi.T @ y[inside])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def _dense(units: list[str], vocabulary: np.ndarray) -> np.ndarray:
    rows, codes, values = features(units)
    out = np.zeros((len(units), len(vocabulary)), np.float32)
    at = np.minimum(np.searchsorted(vocabulary, codes), len(vocabulary) - 1)
    hit = vocabulary[at] == codes
    out[rows[hit], at[hit]] = values[hit]
    return out


def _likeness(units: list[str], marks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised kernel of units with marks, in blocks; the marks' triples and their dense features."""
    vocabulary = np.unique(features(marks)[1])
    dense = _dense(marks, vocabulary)
    parts = [_dense(units[i : i + 1000], vocabulary) @ dense.T for i in range(0, len(units), 1000)]
    return (np.concatenate(parts) if parts else np.zeros((0, len(marks)))).astype(float), vocabulary, dense.astype(float)


def fit_units(positive: list[str], negative: list[str], landmarks: int = 64) -> Model:
    """The machine that separates the units, on landmarks of both kinds."""
    # Landmarks: witnesses in turn, each the one least like those taken; then the clean units most like them. The likeness
    # to a new landmark is worked out when it is taken, so no table of all pairs is made.
    rows, codes, values = features(positive)
    ends = np.cumsum(np.bincount(rows, minlength=len(positive)))
    order = np.argsort(rows, kind="stable")
    rows, codes, values = rows[order], codes[order], values[order]

    def like(i: int) -> np.ndarray:
        own = slice(ends[i - 1] if i else 0, ends[i])
        sort = np.argsort(codes[own])
        mine, weight = codes[own][sort], values[own][sort]
        at = np.minimum(np.searchsorted(mine, codes), len(mine) - 1)
        return np.bincount(rows, np.where(mine[at] == codes, values * weight[at], 0.0), len(positive))

    taken, near = [0], like(0)
    while len(taken) < min(landmarks, len(positive)):
        taken.append(int(np.argmin(near)))
        near = np.maximum(near, like(taken[-1]))
    marks = [positive[i] for i in taken]
    if negative:
        closest = _likeness(negative, marks)[0].max(axis=1)
        marks += [negative[i] for i in np.argsort(-closest, kind="stable")[:landmarks]]
    k, vocabulary, dense = _likeness(positive + negative, marks)
    value, vector = np.linalg.eigh(dense @ dense.T)
    root = vector[:, value > 1e-6] / np.sqrt(value[value > 1e-6])
    y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
    weight = np.where(y > 0, min(20.0, max(1.0, len(negative) / max(1, len(positive)))), 1.0)
    w = _machine(k @ root, y, weight)
    return Model(vocabulary, dense.T @ (root @ w[:-1]), float(w[-1]))


def _logistic(x: np.ndarray, y: np.ndarray, share: float) -> tuple[float, ...]:
    """Weights and shift of the label's probability, with Platt's smoothed targets and a small ridge.

    Rows are weighted so that toxic ones make up `share` of them.
    """
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    each = np.where(y == 1, share * len(y) / n1, (1 - share) * len(y) / n0)
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), 0.1 * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (each * (p * (1 - p) + 1e-4))[:, None]).T @ x + ridge, x.T @ (each * (p - target)) + ridge @ w)
        w = w - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def fold(id_: Column) -> Column:
    """crc32 of the id as text, modulo five; the remainder 0 is held out."""
    return F.crc32(id_.cast("string").cast("binary")) % 5


def train(labelled: DataFrame, share: float, max_units: int = 8_000) -> Model | float:
    """The model for the sample labelled(text, toxic), of whose population `share` is toxic; the label's share where only
    one label is there. The driver gets at most max_units units of each kind.
    """
    counts = labelled.agg(F.count_if(F.col("toxic") == 1).alias("n1"), F.count_if(F.col("toxic") == 0).alias("n0")).first()
    n1, n0 = counts.n1, counts.n0
    if not n1 or not n0:
        return n1 / (n1 + n0) if n1 + n0 else 0.0
    # A unit's evidence is the number of different pairs of words around it, in toxic and in clean texts: a group of copies
    # adds one context to each of its words, however large it is, and a word of a fixed phrase still meets many others.
    words = labelled.select("toxic", F.split(F.lower("text"), r"[^\p{L}\p{M}\p{N}]+").alias("w"))
    near = lambda i: F.concat(F.lit("\t"), F.coalesce(F.get("w", i - 1), F.lit("")), F.lit(" "), F.coalesce(F.get("w", i + 1), F.lit("")))
    whole = F.transform("w", lambda x, i: F.concat(x, near(i)))
    stem = F.filter(F.transform("w", lambda x, i: F.when(F.length(x) > 5, F.concat(F.lit("^"), F.substring(x, 1, 5), near(i)))), lambda k: k.isNotNull())
    pairs = words.select("toxic", F.explode(F.array_distinct(F.concat(whole, stem))).alias("pair")).groupBy("pair").agg(F.max("toxic").alias("a"), (1 - F.min("toxic")).alias("b"))
    seen = pairs.groupBy(F.substring_index("pair", "\t", 1).alias("key")).agg(F.sum("a").cast("long").alias("a"), F.sum("b").cast("long").alias("b")).where("key not in ('', '^')")
    seen = materialize(seen.withColumn("n", F.col("a") + F.col("b")), "toxicity-contexts")
    total = seen.agg(F.sum("a").alias("a"), F.sum("n").alias("n")).first()
    rate = (total.a or 0) / max(1, total.n or 0)
    a, b, n = (F.col(c).cast("double") for c in ("a", "b", "n"))
    gain = lambda x, e: F.when(x > 0, x * F.ln(x / e)).otherwise(0.0)
    seen = seen.withColumn("llr", F.when((a / n > rate) & (a / n >= LEAST_SHARE), 2 * (gain(a, n * rate) + gain(b, n * (1 - rate)))).otherwise(0.0))
    strong = [r.key for r in seen.where(F.col("llr") >= LEAST_RATIO).orderBy(F.desc("llr"), "key").limit(max_units).collect()]
    stems, own = {k[1:] for k in strong if k[0] == "^"}, [k for k in strong if k[0] != "^"]
    if stems:
        at = F.broadcast(labelled.sparkSession.createDataFrame(pa.table({"stem": pa.array(sorted(stems), pa.string())})))  # at most max_units
        more = seen.where((F.length("key") > 5) & (F.col("a") >= LEAST_SHARE * F.col("n"))).join(at, F.substring("key", 1, 5) == F.col("stem"), "left_semi")
        have = set(own)
        own += [r.key for r in more.orderBy(F.desc("a"), "key").limit(max_units).collect() if r.key not in have]
    if not own:
        best = seen.where("a > 0 and key not like '^%'").orderBy(F.desc(a / n), F.desc("a"), "key").limit(20)
        own = [r.key for r in best.collect()]
    clean = seen.where("a = 0 or a < 0.3 * n").where("key not like '^%'")
    clean = clean.orderBy(F.col("n") < 20, F.xxhash64("key"), "key").limit(max_units)
    harmless = list(dict.fromkeys(x for r in clean.collect() for x in windows(r.key)))
    known = set(harmless)
    positive = list(dict.fromkeys(x for k in own for x in windows(k) if len(k) <= WIDTH or x not in known))
    positive = positive or list(dict.fromkeys(x for k in own for x in windows(k)))
    if not positive:  # toxic texts without a word
        return n1 / (n1 + n0)
    negative = [x for x in harmless if x not in set(positive)]
    model = fit_units(positive, negative)
    # Labels are of texts, so the machine is fitted anew to labelled texts: its witness of a toxic one is the unit of the
    # highest margin, of a clean one that unit too, which has to be under the line. A toxic text whose every unit lies at
    # the floor has no witness.
    for _ in range(ROUNDS):
        found = witnesses(labelled, model).groupBy("w").agg(F.sum("toxic").alias("a"), F.count("*").alias("n"))
        found = found.orderBy(F.desc("n"), "w").limit(max_units).collect()
        more = [r.w for r in found if r.a >= LEAST_SHARE * r.n and r.n > 1]
        less = {r.w for r in found if r.a < 0.5 * r.n}
        now = [x for x in dict.fromkeys([*positive, *more]) if x not in less]
        if not now or now == positive and less <= set(negative):
            break
        positive = now
        negative = [x for x in dict.fromkeys([*negative, *sorted(less)]) if x not in set(positive)]
        model = fit_units(positive, negative)
    some = labelled.select("toxic", evidence_of(model)(F.col("text")).alias("x")).toPandas()
    model.curve = _logistic(np.array(some["x"].tolist(), float), some["toxic"].to_numpy(int), share)
    return model


def witnesses(labelled: DataFrame, model: Model) -> DataFrame:
    """(toxic, w) for the texts with a unit above the floor: the one whose margin is highest.

    A map over batches, as a filter on a function's result would be pushed below it: asked twice, by two workers a task that
    then stay for all later stages.
    """

    def highest(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                each, margin = model.of_units(part["text"].to_pylist())
                best = [max(own, key=lambda u: (margin[u], u), default=None) for own in each]
                found = pa.array([None if u is None or margin[u] <= FLOOR else u for u in best], pa.string())
                yield pa.RecordBatch.from_arrays([part["toxic"], found], ["toxic", "w"]).filter(found.is_valid())

    return labelled.select("text", "toxic").mapInArrow(highest, "toxic int, w string")


def evidence_of(model: Model):
    @F.arrow_udf("array<double>")
    def evidence(text: pa.Array) -> pa.Array:
        found = [model.of_texts(text.slice(i, 256).to_pylist()) for i in range(0, len(text), 256)]
        flat = np.concatenate(found).ravel() if found else np.zeros(0)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, 3), pa.int32()), pa.array(flat))

    return evidence


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_units: int = 8_000, max_texts: int = 16_000) -> DataFrame:
    """docs with held_out, score (0 to 1) and predicted (1 if score >= 0.5).

    Learns from rows of labels whose fold is not 0; ids with several labels count with each, labels that are null or
    neither 0 nor 1 count not at all. A null text is empty; an empty text scores as a text without units. Where the
    training rows hold one label only, or toxic ones no word, every score is that label's share (0 without rows). Rows with a null id are scored
    and are not held out. Columns named held_out, score or predicted give way to the operator's.
    """
    known = labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("toxic")).where("id is not null and toxic in (0, 1)").where(fold(F.col("id")) != 0)
    counts = known.agg(F.count_if(F.col("toxic") == 1).alias("n1"), F.count_if(F.col("toxic") == 0).alias("n0")).first()
    share = counts.n1 / max(1, counts.n1 + counts.n0)
    few = [hash_sample(known.where(F.col("toxic") == k), "id", n, most) for k, n, most in ((1, counts.n1, max_texts // 4), (0, counts.n0, max_texts - max_texts // 4))]
    sample = materialize(few[0].unionByName(few[1]), "toxicity-sample")
    # At most max_texts ids: a broadcast of bounded size, so that texts stay where they are.
    labelled = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text")).join(F.broadcast(sample), "id").select("text", "toxic")
    # Written, as a filter on what the machine says of a text would else be pushed below the join and so ask it of all texts.
    labelled = materialize(labelled.repartition(64), "toxicity-labelled")
    model = train(labelled, share, max_units)
    discard(docs.sparkSession, labelled)
    rows = sealed(docs, id=col(id_col), text=col(text_col))
    if isinstance(model, float):
        score = F.lit(model)
    else:
        rows = rows.withColumn("x", evidence_of(model)("text"))
        *w, shift = model.curve
        score = 1 / (1 + F.exp(-sum((F.col("x")[i] * w[i] for i in range(len(w))), F.lit(shift))))
    rows = rows.withColumn("p", score)
    return unsealed(rows, docs.columns, held_out=F.coalesce(fold(F.col("id")) == 0, F.lit(False)), score=F.col("p"), predicted=(F.col("p") >= 0.5).cast("int"))
