"""Periodic runs, licence scans and importance resampling against brute force, with nulls, empty tables, ties and clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelake.llm import licences, periodic, resampling
from pagelake.llm.queries import QUERIES, SQL
from tests.conftest import SF
from tests.test_queries import plain


def plain_runs(x):
    """Every diagonal word by word; a stretch counts for the smallest lag."""
    out = {}
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i < len(x) - q:
            a = i
            while i < len(x) - q and x[i] == x[i + q]:
                i += 1
            if i > a and i - a + q >= max(12, 2 * q):
                out.setdefault((a, i - a + q), q)
            i += i == a
    return sorted(((a, n, q) for (a, n), q in out.items()), key=lambda r: (r[0], r[2]))


def repetitive(rng):
    """Words of few letters: noise, repeated blocks, copies of what came before, Fibonacci words."""
    v, n = rng.choice([1, 2, 2, 3, 5, 40]), rng.randrange(0, 160)
    kind = rng.randrange(5)
    if kind < 2:
        return [rng.randrange(v) for _ in range(n)]
    if kind == 2:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b
    out = []
    while len(out) < n:
        block = [rng.randrange(v) for _ in range(rng.randrange(1, 40))]
        out += (block * rng.randrange(1, 6))[: rng.randrange(1, 120)]
        if rng.random() < 0.3:
            out += out[-rng.randrange(1, len(out) + 1) :]
    return out


def test_runs_against_every_diagonal():
    rng = random.Random(7)
    n = 0
    for _ in range(120):
        docs = [repetitive(rng) for _ in range(rng.randrange(1, 8))]
        for words, got in zip(docs, periodic.runs_of([np.array(d, np.int64) for d in docs]), strict=True):
            assert [tuple(r) for r in got.tolist()] == plain_runs(words)
            n += len(got)
    assert n > 300


def test_seeds_of_words_over_and_over_stay_few():
    """Pairs are linear in the words, not the square of a word's occurrences."""
    for words in ([0] * 30_000, [0, 1] * 15_000, ([0] * 999 + [1]) * 30):
        x = np.array([*words, 9], np.int64)
        at, ids = periodic._first_seeds(x, np.zeros(len(x), np.int64))
        k = periodic.SEED
        while len(at):
            assert len(periodic._pairs(at, ids, k, len(x))[0]) < 4 * len(words)
            at, ids = periodic._longer(at, ids, k, len(x))
            k *= 2
        assert [tuple(r) for r in periodic.runs_of([x])[0].tolist()][0][0] == 0


def test_runs_of_texts(spark):
    rng = random.Random(8)
    texts = [None, "", " \n\t ", "one", "x " * 11, "x\n" * 12, "a b " * 6, *(" ".join(f"w{v}" for v in repetitive(rng)) for _ in range(40)), "é ü\x0bé ü\x0c" * 9]
    rows = [(i, t, "old") for i, t in enumerate(texts)] + [(None, "a b " * 6, None), (5, "x\n" * 12, "again")]
    out = periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, Runs string").repartition(3))
    assert out.columns == ["doc_id", "text", "Runs", "collapsed"]
    for r in out.collect():
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", r.text or "") if w]
        runs = plain_runs(words)
        gone = {i for a, n, q in runs for i in range(a + q, a + n)}
        assert [tuple(x) for x in r.Runs] == runs and r.collapsed == " ".join(w for i, w in enumerate(words) if i not in gone)
    assert periodic.periodic_runs(spark.createDataFrame([], "text string, collapsed int")).columns == ["text", "collapsed", "runs"]
    assert periodic.periodic_runs(spark.createDataFrame([], "text string")).count() == 0


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op13_importance_resampling"])
def test_queries_on_odd_rows_against_sql(spark, tmp_path, name):
    texts = [None, "", " ", "a " * 40, "a b c " * 30, "Éa 1-2-3 x_y " * 9, *(t.text for t in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect())]
    docs = spark.createDataFrame([(1000 - 7 * i, t, i) for i, t in enumerate(texts)] + [(5000, "a b c " * 30, 0)], "doc_id long, text string, rank int")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    for n, few in (("some", 5), ("none", 0)):
        path = tmp_path if n == "some" else tmp_path / n
        spark.read.parquet(f"{SF}/benchmark.parquet").limit(few).write.parquet(f"{path}/benchmark.parquet")
        if n == "none":
            docs.limit(0).write.parquet(f"{path}/documents.parquet")
        con = duckdb.connect()
        for t in ("documents", "benchmark"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet/*.parquet')")
        df, other = QUERIES[name](spark, str(path)), con.sql(SQL[name])
        at = [other.columns.index(c) for c in df.columns]
        assert sorted((tuple(map(plain, r)) for r in df.collect()), key=repr) == sorted((tuple(plain(r[i]) for i in at) for r in other.fetchall()), key=repr)


def plain_features(text):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if w]
    return words, [zlib.crc32(" ".join(words[i : i + n]).encode()) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def test_hashes_of_features_in_slices(monkeypatch):
    """The carried hashes are those of the joined words, wherever texts are cut."""
    rng = random.Random(9)
    texts = [None, "", "...", "One", "One two", "Été ÉTÉ x9", *(" ".join("".join(rng.choice("abÉz9-") for _ in range(rng.randrange(0, 300 if rng.random() < 0.05 else 9))) for _ in range(rng.randrange(200))) for _ in range(30))]
    for slice_, at_once in ((1 << 20, 1 << 17), (40, 10), (1, 1)):
        monkeypatch.setattr(resampling, "_SLICE", slice_)
        monkeypatch.setattr(resampling, "_AT_ONCE", at_once)
        found = [Counter() for _ in texts]
        words = [0] * len(texts)
        for part in resampling.hashed_features([t.encode() if t is not None else None for t in texts]):
            for k, i in enumerate(part.row):
                found[i].update(part.features[part.bounds[k] : part.bounds[k + 1]].tolist())
                words[i] += part.words[k]
        assert found == [Counter(plain_features(t)[1]) for t in texts] and words == [len(plain_features(t)[0]) for t in texts]


@pytest.mark.parametrize("n", [1, 2, 5, 400])
def test_cutoff_of_ties(spark, n):
    rng = random.Random(n)
    keys = [(rng.randrange(8), rng.randrange(60)) for _ in range(n)]
    df = spark.createDataFrame(keys, "score long, id long").repartition(5)
    order = sorted(keys, key=lambda k: (-k[0], k[1]))
    for take in {1, n, (n + 1) // 2, max(1, n - 1)}:
        key, before = resampling.cutoff(df, take)
        assert key == order[take - 1] and before == order.index(key)


def test_resampling_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(50)]
    rows = [(i, " ".join(rng.choices(vocabulary[: 10 if i % 7 == 0 else 50], k=rng.randrange(0, 90))), i, "s") for i in range(400)]
    rows += [(900, None, 0, "n"), (None, "w1 " * 30, 0, "n"), (7, rows[7][1], 1, "copy"), (7, rows[7][1] + " w1", 2, "copy")]
    target = [(" ".join(rng.choices(vocabulary[:10], k=30)),) for _ in range(20)] + [(None,)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, score int, id string").repartition(4)
    out = resampling.resample(docs, spark.createDataFrame(target, "text string"), percent=20, buckets=300)
    assert out.columns == ["doc_id", "text", "score", "id", "n_features", "weight", "rank"]
    s, t = Counter(), Counter()
    for side, texts in ((s, [r[1] for r in rows]), (t, [r[0] for r in target])):
        for x in texts:
            side.update(h % 300 for h in plain_features(x)[1])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 300) / ((s[b] + 1) * (t.total() + 300)))) for b in range(300)}
    expected = []
    for i, text, _, _ in rows:
        words, hashes = plain_features(text)
        weight = sum(gain[h % 300] for h in hashes)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        expected.append([i, len(hashes), weight, score, len(words) >= 20 and i is not None])
    drawn = sorted((e for e in expected if e[4]), key=lambda e: (-e[3], e[0], -e[1]))
    take = 20 * len(drawn) // 100
    want = [(*e[:4], k + 1) for k, e in enumerate(drawn[:take])] + [(*e[:4], None) for e in drawn[take:]] + [(*e[:4], None) for e in expected if not e[4]]
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in out.collect()), key=repr) == sorted(want, key=repr)
    assert resampling.resample(docs.limit(0), docs, texts=False).columns == ["doc_id", "score", "id", "n_features", "weight", "rank"]


def plain_places(text):
    words = plain_features(text)[0]
    found = []
    for kind, phrases in (("base", licences.BASE), ("notice", licences.NOTICES), ("tag", dict.fromkeys(licences.TAGS, ""))):
        for phrase, label in phrases.items():
            p = phrase.split()
            found += [(kind, label, i, len(p)) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return words, sorted(found, key=lambda p: (p[2], p[3], p[0]))


def test_licence_places_against_every_position():
    rng = random.Random(2)
    parts = [w for p in (*licences.BASE, *licences.NOTICES, *licences.TAGS) for w in (p, p.split()[0], p.split()[-1])] + ["and", "x", "é", "License:"]
    for _ in range(200):
        text = "".join(rng.choice(parts) + rng.choice([" ", "  ", "-", ",\n", "_", "é"]) for _ in range(rng.randrange(40)))
        text = text.upper() if rng.random() < 0.3 else text
        words, places = plain_places(text)
        scan = licences.scanned(text.encode())
        assert (scan.n_words, scan.places) == (len(words), places)


def test_expressions():
    def value(text):
        order = licences.postfix(text.replace("(", " ( ").replace(")", " ) ").split())
        return order, None if order is None else licences.evaluated(order)

    assert value("mit or gpl-3.0 and apache-2.0") == (["mit", "gpl-3.0", "apache-2.0", "and", "or"], 0)
    assert value("(mit or gpl-3.0) and apache-2.0")[1] == 0 and value("( mit and gpl-3.0 ) or agpl-3.0")[1] == 2
    assert value("gpl-2.0 with classpath-exception and mit") == (["gpl-2.0", "classpath-exception", "with", "mit", "and"], 1)
    assert value("own-thing or proprietary")[1] == 5 and value("lgpl-2.1+")[1] == 1 and value("cc-by-nc-4.0")[1] == 4
    for bad in ("", "mit or", "or mit", "( mit", "mit )", "mit gpl-2.0", "mit and or isc", "( )"):
        assert value(bad)[0] is None
    # Against Python's own parser: or is the least, and the greatest.
    rng = random.Random(1)
    names = {"mit": 0, "mpl-2.0": 1, "gpl-3.0": 2, "agpl-3.0": 3, "cc-by-nc": 4, "closed": 5}

    class Rank(int):
        def __or__(self, other):
            return Rank(min(self, other))

        def __and__(self, other):
            return Rank(max(self, other))

    def some(depth):
        if not depth or rng.random() < 0.3:
            return rng.choice(list(names))
        return f"( {some(depth - 1)} )" if rng.random() < 0.3 else f"{some(depth - 1)} {rng.choice(['and', 'or'])} {some(depth - 1)}"

    for _ in range(200):
        text = some(4)
        python = " ".join({"and": "&", "or": "|"}.get(t, t if t in "()" else f"Rank({names.get(t)})") for t in text.split())
        assert value(text)[1] == eval(python, {"Rank": Rank}), text


def test_scans_of_texts(spark):
    rows = [
        (1, None),
        (2, ""),
        (3, "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */\nmore"),
        (4, "Dual: the MIT License or the GNU General Public License, version 3. All rights reserved"),
        (5, "SPDX-License-Identifier: MIT or\nCC BY-NC 4.0, CC BY"),
        (6, "SPDX-License-Identifier:\n"),
        (7, "no licence, all right reserved; ccby"),
        (8, "x " * 300_000 + "All  rights\nreserved"),
    ]
    out = licences.scan_licences(spark.createDataFrame([(*r, "l") for r in rows] + [(8, rows[7][1], "again")], "doc_id int, text string, labels string").repartition(2))
    assert out.columns == ["doc_id", "text", "labels", "n_words", "places", "expressions", "score", "restriction"]
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == 9 and all(got[i].score == 0 and not got[i].labels and got[i].restriction is None for i in (1, 2, 7)) and got[1].n_words == 0
    assert got[3].expressions[0].written == "( mit or apache-2.0 ) and gpl-2.0-only with classpath-exception-2.0" and got[3].restriction == 0.2
    assert {"mit", "apache-2.0", "gpl-2.0-only"} <= set(got[3].labels) and got[3].score > 0.98
    assert [e.written for e in got[4].expressions] == ["mit or gpl-3.0", "reserved"] and [e.restriction for e in got[4].expressions] == [0.0, 1.0] and got[4].restriction == 1.0
    assert got[5].expressions[0].restriction is None and {"mit", "cc-by", "cc-by-nc"} <= set(got[5].labels)
    assert got[6].expressions == [] and got[6].score > 0.9
    assert [(p.word, p.kind) for p in got[8].places] == [(300_000, "base")] and got[8].n_words == 300_003
    assert licences.scan_licences(spark.createDataFrame([], "text string")).count() == 0


def test_licence_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op12_licence_scan"](spark, SF).collect()
    assert len(rows) == len(texts) and sum(r.n_base for r in rows) > 0
    for r in rows:
        words, places = plain_places(texts[r.doc_id])
        base = [p for p in places if p[0] == "base"]
        at = [p[2] for p in base]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(words), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({p[1] for p in base})))
        assert {p[1] for p in places if p[1]} <= set(r.labels.split(",")) and 0 <= r.score <= 1 and (r.score > 0) == bool(places)
