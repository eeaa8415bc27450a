"""Corpus operators against brute force on small fixtures, with nulls, empty tables, repeats and clashing names."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pagelake.llm import chunks, common, html_layout, line_dedup, mixing, multi_index, pieces, pii, simhash, substring_dedup, toxicity, winnowing
from pagelake.llm.queries import model_path

WORDS = "ta re mo li sun kor wen dal pic tor es nu via hem rot lug".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Rows (doc_id, text): copies, near copies, shared lines and passages, nulls, empty and odd texts."""
    rng = random.Random(3)
    base = [prose(rng, rng.randrange(3, 120)) for _ in range(30)]
    passage = prose(rng, 40)
    texts = [None, "", " ", "\n\n", "x", "é" * 60, "ab" * 90, passage, "z " + passage + " q"]
    texts += base + base[:5] + [b.replace(b.split()[1], "changed", 1) for b in base[5:12]]
    texts += [b + "\nA common line of text\n" + passage for b in base[12:18]] + ["  A COMMON LINE OF TEXT\t\n" + b for b in base[18:22]] + [prose(rng, 4000)]
    ids = rng.sample(range(1000), len(texts))
    return sorted(zip(ids, texts, strict=True))


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).repartition(3)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else (x or "").encode()).hexdigest()


def test_line_dedup(spark, corpus):
    first, last = {}, {}
    for i, t in corpus:
        for k in line_dedup.line_keys(t):
            if line_dedup.counted(k):
                first.setdefault(k, i)
                last[k] = i
    expected = {}
    for i, t in corpus:
        lines = (t or "").split("\n")
        keep = [x for x, k in zip(lines, line_dedup.line_keys(t), strict=True) if not (k in first and first[k] < last[k] and first[k] < i and line_dedup.counted(k))]
        expected[i] = ("\n".join(keep), len(lines), len(lines) - len(keep))
    got = {r.doc_id: (r.text or "", r.n_lines, r.n_dropped) for r in line_dedup.line_dedup(frame(spark, corpus)).collect()}
    assert got == expected and sum(x[2] for x in got.values()) > 10


def test_line_dedup_by_small_segments_gives_the_same(spark):
    rng = random.Random(1)
    rows = [(i, "\n".join(f"line number {rng.randrange(400)} of many" for _ in range(20))) for i in range(60)]
    whole = sorted(map(tuple, line_dedup.line_dedup(frame(spark, rows)).collect()))
    assert sorted(map(tuple, line_dedup.line_dedup(frame(spark, rows), segment_keys=1).collect())) == whole


def test_bloom_filters_miss_no_hash_that_two_lists_hold():
    rng = np.random.default_rng(0)
    x = np.sort(rng.integers(0, 2**40, 3000, dtype=np.uint64))
    y = np.sort(rng.integers(0, 2**40, 3000, dtype=np.uint64))
    z = np.sort(np.concatenate([y, x[:100]]))
    lists = [chunks.Keys(x, np.ones(len(x), np.uint32), np.arange(len(x)) >= 2990), chunks.Keys(z, np.ones(len(z), np.uint32), np.zeros(len(z), bool))]
    a, b = line_dedup.seen_twice([chunks.decoded(chunks.coded(k)) for k in lists])
    assert a[:100].all() and a[2990:].all() and a[100:2990].mean() < 0.05 and b[np.isin(z, x[:100])].all() and b[~np.isin(z, x)].mean() < 0.05


def test_chunks_code_and_deal_out_hashes():
    rng = np.random.default_rng(1)
    for shape in (chunks.Shape(24, 7), chunks.Shape(60, 1000)):
        h = rng.integers(0, 2**64, 5000, dtype=np.uint64)
        keys = chunks.listed(shape.cut(np.concatenate([h, h[:50], h[:1]])), np.concatenate([np.zeros(5000, int), np.ones(50, int), [1]]))
        again = chunks.decoded(chunks.coded(keys))
        assert all(np.array_equal(getattr(keys, k), getattr(again, k)) for k in ("q", "n", "many"))
        segment = shape.segment(keys.q)
        assert (np.diff(segment.astype(int)) >= 0).all() and segment.max() < shape.segments and len(np.unique(segment)) > 5


def plain_fingerprint(text, shingle=3):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(str.maketrans(common.UPPER, common.LOWER)))
    if not words:
        return 0
    k = min(shingle, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, corpus):
    rows = corpus + [(2000 + i, "Same  Words\there" if i % 2 else "same words HERE") for i in range(4)]
    fp = {i: plain_fingerprint(t) for i, t in rows}
    ids = sorted(fp)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            low = min(label[j] for j in ids if (fp[i] ^ fp[j]).bit_count() <= 2)
            if low < label[i]:
                label[i], changed = low, True
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_dedup(frame(spark, rows)).collect()}
    assert got == {i: (f"{fp[i]:016x}", label[i]) for i in ids}
    one = spark.createDataFrame([("same words HERE",)], "t string").select(F.xxhash64("t").alias("h")).first().h
    assert one % 2**64 == xxhash.xxh64_intdigest("same words HERE", 42)


def test_vantage_point_tree_finds_every_pair():
    rng = np.random.default_rng(4)
    fp = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    near = fp[:800].copy()
    for _ in range(2):
        near ^= np.uint64(1) << rng.integers(0, 64, 800).astype(np.uint64)
    core = np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 8, 200).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(8, 16, 200).astype(np.uint64))
    fp = np.unique(np.concatenate([fp, near, core]))
    nodes = simhash.fit_tree(rng.permutation(fp)[:600], len(fp), 200)
    assert sum(len(n) == 1 for n in nodes) > 8
    found, homes = set(), 0
    for _, rows, home in simhash.route(nodes, fp, 2):
        own = rows[home]
        homes += len(own)
        a, b = simhash.links(fp[own], fp[rows], 2)
        found |= {tuple(sorted(p)) for p in zip(own[a].tolist(), rows[b].tolist(), strict=True) if p[0] != p[1]}
    x, y = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None]) <= 2)
    assert homes == len(fp) and found == {(i, j) for i, j in zip(x.tolist(), y.tolist(), strict=True) if i < j}


def test_connected_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, None), (7, 7)]
    label = common.local_components(1100, np.array([a for a, b in edges if b is not None]), np.array([b for a, b in edges if b is not None]))
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if b is not None and a != b for x in (a, b)}
    assert got == {n: label[n] for n in nodes}


def test_substring_dedup(spark, corpus):
    rows = corpus + [(3000 + i, t) for i, t in enumerate(["q" * 49, "q" * 50, "q" * 50, "xyz " * 100, "ab" * 200])]
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            first.setdefault(b[k : k + 50], i)
    expected = {}
    for i, t in rows:
        b = (t or "").encode()
        hit = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                hit[k : k + 50] = True
        spans = int(hit[:1].sum()) + int((hit[1:] & ~hit[:-1]).sum())
        expected[i] = (len(b), int(hit.sum()), spans, sha(np.frombuffer(b, np.uint8)[~hit].tobytes()))
    for bucket, segment in ((1000, 1 << 21), (2, 1), (0, 50)):
        out = substring_dedup.substring_dedup(frame(spark, rows), bucket=bucket, segment_keys=segment)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in out.collect()}
        assert got == expected


def test_winnowing(spark, corpus):
    out = winnowing.document_fingerprints(frame(spark, corpus))
    near = [winnowing.likeness("fp", x).alias(y) for x, y in (("edited_fp", "near_edited"), ("next_fp", "near_next"))]
    got = {r.id: r for r in out.select("*", *near).collect()}
    texts = [t or "" for _, t in corpus]

    def alike(a, b):
        a, b = ({v >> winnowing._BITS for v in x} for x in (a, b))
        return len(a & b) / len(a | b) if a | b else 1.0

    for n, (i, _) in enumerate(corpus):
        t, after = texts[n], texts[(n + 1) % len(texts)]
        cut = len(t) // 4
        assert got[i].edited == t[: len(t) - cut] + after[:cut] and got[i].next_text == after
        assert got[i].fp == plain_winnowing(t) and got[i].edited_fp == plain_winnowing(got[i].edited) and got[i].next_fp == plain_winnowing(after)
        assert got[i].near_edited == alike(got[i].fp, got[i].edited_fp) and got[i].near_next == alike(got[i].fp, got[i].next_fp)
    equal = {}
    for i, t in corpus:
        assert equal.setdefault(t or "", got[i].fp) == got[i].fp


def plain_winnowing(text):
    """Tokens, hashes of runs and windows by hand."""
    words = []
    for w in re.findall("[^\x20\x09-\x0d]+", text.lower()):
        words += [w] if len(w) <= winnowing.WORD else list(w)
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    grams = []
    for i in range(max(1, len(words) - winnowing.GRAM + 1) if words else 0):
        seed = 42
        for x in h[i : i + winnowing.GRAM]:
            seed = xxhash.xxh64_intdigest(x.to_bytes(8, "little"), seed)
        grams.append(signed(seed) & winnowing._MASK)
    picks = []
    for i in range(max(1, len(grams) - winnowing.WINDOW + 1) if grams else 0):
        window = grams[i : i + winnowing.WINDOW]
        at = i + max(j for j, x in enumerate(window) if x == min(window))
        if (entry := grams[at] | (winnowing._LAST - at)) not in picks:
            picks.append(entry)
    return picks


def test_winnowing_of_texts_without_blanks(spark):
    rng = random.Random(3)
    shared = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(60))
    texts = [chr(0x3042) * k + "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(40 + k)) + shared for k in range(20)] + ["ab" * 5000]
    rows = winnowing.with_fingerprint(spark.createDataFrame([(t,) for t in texts], "text string"), "text", "fp").collect()
    found = {r.text: r.fp for r in rows}
    assert all(found[t] == plain_winnowing(t) for t in texts)
    common = set.intersection(*[{v >> winnowing._BITS for v in found[t]} for t in texts[:20]])
    assert len(common) >= (60 - winnowing.GRAM - winnowing.WINDOW) // winnowing.WINDOW


def test_next_of_any_ids(spark):
    rng = random.Random(4)
    ids = [rng.randrange(-(2**62), 2**62) for _ in range(800)] + list(range(200)) + [2**62, 7, 7]
    df = frame(spark, [(i, f"text {k}") for k, i in enumerate(ids)]).selectExpr("doc_id AS id", "text", "array(1L) AS fp")
    signed = lambda t: (x := xxhash.xxh64_intdigest(t.encode(), 42)) - (2**64 if x >= 2**63 else 0)
    order = sorted((i, signed(f"text {k}"), f"text {k}") for k, i in enumerate(ids))
    for buckets in (None, 1, 9, 200):
        got = {r.text: r.next_text for r in winnowing.with_next(df, buckets).collect()}
        assert got == {t: order[(k + 1) % len(order)][2] for k, (_, _, t) in enumerate(order)}


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_valid(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        return 12 <= len(d) <= 19 and total % 10 == 0
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in v.split(".")), "phone": 9 <= len(d) <= 15}[kind]


def test_pii(spark, corpus):
    odd = ["a@b.c_d@e.f x@y.z@w.v 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004", "4282216907566403 4282-2169-0756-6403  42822169075664039999 4111 1111 1111 1111 5 12-34", "+1 (555) 123-4567 +44 20 7946 0958. +1", "é😀 a.b+c@ex-ample.co.uk, 10.0.0.1é", "1" * 3000, "a" * 3000 + "@b", "@@@ +"]
    told = [(5000 + i, f"{prose(random.Random(i), 20)} the zebulon mayor wrote to mayor.q@town.org about 10.20.30.40 {prose(random.Random(i + 9), 20)}") for i in range(4)]
    rows = corpus + [(4000 + i, t) for i, t in enumerate(odd)] + told
    got = {r.doc_id: r for r in pii.sanitise(frame(spark, rows)).collect()}
    for i, t in rows:
        found = sorted((m.start(), list(PLAIN).index(k), m.end(), m[0], k) for k, p in PLAIN.items() for m in re.finditer(p, t or "") if plain_valid(k, m[0]))
        assert [tuple(x) for x in got[i].base] == found
        assert {tuple(x) for x in got[i].base} <= {tuple(x) for x in got[i].spans}
        assert all((t or "")[x.s : x.e].lower() == x.v for x in got[i].spans if x.kind in (pii.REMOVE, pii.GENERALISE))
    assert all("zebulon" in {x.v for x in got[i].spans if x.kind == pii.REMOVE} for i, _ in told)
    assert "[EMAIL]" in got[5000].sanitised and "zebulon" not in got[5000].sanitised and "town.org" not in got[5000].sanitised


def test_pieces_equal_the_library(spark, corpus):
    texts = [t or "" for _, t in corpus] + ["  a  b ", "a▁b ▁▁ c", "😀é\x00日本", "x" * 300, "\n" * 40, "</s><unk>", "▁", " "]
    encoder = pieces.PieceEncoder(model_path())
    ids, decoded = encoder.encode_batch(texts)
    lib = encoder.library
    for t, i, d in zip(texts, ids, decoded, strict=True):
        expected = lib.encode(t, add_bos=True, add_eos=True)
        assert np.frombuffer(i, np.uint32).tolist() == expected and d == lib.decode(expected) == encoder.decode(expected)
    rng = random.Random(2)
    for _ in range(300):
        some = [rng.choice([rng.randrange(32000), rng.randrange(260)]) for _ in range(rng.randrange(1, 8))]
        assert encoder.decode(some) == lib.decode(some)
    for _ in range(300):
        word = pieces.MARK + "".join(rng.choice("aetionrs▁hl") for _ in range(rng.randrange(1, 20)))
        assert encoder.merge(word) == encoder.merge_long(word) == lib.encode(word[1:].replace(pieces.MARK, " "))
    out = pieces.encode_pieces(frame(spark, corpus), model_path()).collect()
    assert all(r.n_tokens * 4 == len(r.token_ids) for r in out) and len(out) == len(corpus)


def test_embedding_links(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((500, 16))
    x = np.concatenate([x, x[:60] + 0.1 * rng.standard_normal((60, 16)), x[:1] + 0.02 * rng.standard_normal((80, 16)), x[:20]]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9001, None), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (9004, [1.0, None] + [0.0] * 14), (9005, [1.0])]
    unit = multi_index.normal(x, 16)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    label = common.local_components(len(x), *np.nonzero(near))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = {r.vec_id: r for r in multi_index.embedding_links(df).collect()}
    links = np.array([got[i].n_links for i in range(len(x))])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.95 * near.sum()
    assert np.mean([got[i].component_id == label[i] for i in range(len(x))]) > 0.98
    for i in range(9001, 9006):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_string_kernel_by_enumeration():
    from itertools import combinations

    def phi(s):
        out = {}
        for c in combinations(range(len(s)), 3):
            key = "".join(s[i] for i in c)
            out[key] = out.get(key, 0) + toxicity.DECAY ** (c[-1] - c[0] + 1)
        return out

    a, b = "idiot", "id-iots"
    x, y = phi(f"^{a}$"), phi(f"^{b}$")
    expected = sum(v * y.get(k, 0) for k, v in x.items()) / np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    assert abs(toxicity._likeness([a], [b])[0][0, 0] - expected) < 1e-6


def test_toxicity(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = prose(rng, 40).split()
        if bad:
            words[rng.randrange(40)] = rng.choice(["grobnik", "grobnikar", "zlumox"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    rows += [(900, prose(rng, 20) + " gr-obnik " + prose(rng, 20)), (901, None), (902, "")]
    out = toxicity.toxicity(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    truth = dict(labels)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    got = {r.doc_id: r for r in out}
    assert got[900].score > got[901].score and all(0 <= r.score <= 1 for r in out) and got[901].predicted == 0
    one_kind = toxicity.toxicity(frame(spark, rows[:5]), spark.createDataFrame([(1, 0), (2, None)], "doc_id long, toxic int")).collect()
    assert {r.score for r in one_kind} == {0.0}


def test_mixing(spark):
    rng = random.Random(7)
    rows = [(i, prose(rng, rng.randrange(1, 60)), "hot" if i % 3 else f"s{i % 5}", rng.choice(["en", "de", None])) for i in range(300)] + [(999, None, None, "en")]
    df = frame(spark, rows, "doc_id long, text string, source string, lang string")
    out = mixing.mix_sources(df, budget=0.5)
    rows = out.collect()
    total = sum(max(r.n_tokens, 1) for r in rows)
    for dim in ("source", "lang", "topic"):
        mass, expected = {}, {}
        for r in rows:
            k = r[dim] or ""
            mass[k] = mass.get(k, 0) + max(r.n_tokens, 1)
            expected[k] = expected.get(k, 0) + max(r.n_tokens, 1) * r.probability
        # Tempered shares, none over nine tenths of what the value has: the others take the rest, until none is over.
        goal = {k: v**mixing.TEMPER for k, v in mass.items()}
        most, full = {k: v / total * mixing.CEILING / 0.5 for k, v in mass.items()}, set()
        while True:
            left = 1 - sum(most[k] for k in full)
            open_ = sum(v for k, v in goal.items() if k not in full)
            now = {k: most[k] if k in full else v * left / open_ for k, v in goal.items()}
            if not (more := {k for k in now if k not in full and now[k] >= most[k]}):
                break
            full |= more
        assert all(abs(expected[k] / (0.5 * total) / now[k] - 1) < 0.01 for k in mass), dim
    assert all(r.probability == min(1.0, 0.5 * r.weight) and r.weight <= 2.0 + 1e-9 for r in rows) and 0.2 < np.mean([r.kept for r in rows]) < 0.8
    goals = spark.createDataFrame([("source", "hot", 1.0), ("source", "s0", 1.0), ("lang", "en", 3.0), ("lang", "de", 1.0), ("topic", "brief", 1.0)], "dim string, value string, share double")
    chosen = mixing.mix_sources(df, targets=goals).where("probability > 0").select("source").distinct().collect()
    assert {r.source for r in chosen} == {"hot", "s0"}
    odd = spark.createDataFrame([("source", "hot", 0.5), ("source", "hot", 0.5), ("source", "s0", 1.0), ("source", "s1", 0.0), ("lang", "xx", 0.0), ("topic", None, -1.0)], "dim string, value string, share double")
    again = mixing.mix_sources(df, targets=odd, budget=0.1)
    assert again.count() == len(rows)
    mass = {r.source: r.m for r in again.groupBy("source").agg(F.sum(F.greatest("n_tokens", F.lit(1)) * F.col("probability")).alias("m")).collect()}
    assert abs(mass["hot"] / mass["s0"] - 1) < 0.01 and mass["s1"] == 0


def test_html():
    html = "<!doctype html><head><title>t</title><style>.ad,#x{display:none}</style></head><h1>A &amp; <b>b</b></h1><p>one<p>two<br>three <span style='display: none'>no</span>x<div class=ad>ad</div><ul><li>a<li>b<ol start=3><li>c</ol></ul><table><caption>cap<tr><th>Name<th>N<tr><td>xyz<td>12<tr><td colspan=2>wide</table><pre>\n k\n  l</pre><script>var a='</p>'</script><p hidden>z"
    assert html_layout.visible_text(html) == "A & b\n\none\n\ntwo\nthree x\n\n- a\n- b\n  3. c\n\ncap\nName  N\nxyz   12\nwide\n\n k\n  l"
    assert html_layout.visible_text("<") == "<"
    for x in (None, "", "<a", "<!--", "<script>", "</p>", "<div>" * 5000):
        assert html_layout.visible_text(x) == ""
    assert html_layout.visible_text("<div>" * 3000 + "deep") == "deep"


CASES = {
    "line": lambda d, s: line_dedup.line_dedup(d),
    "simhash": lambda d, s: simhash.simhash_dedup(d),
    "substring": lambda d, s: substring_dedup.substring_dedup(d),
    "pii": lambda d, s: pii.sanitise(d),
    "mixing": lambda d, s: mixing.mix_sources(d),
    "pieces": lambda d, s: pieces.encode_pieces(d, model_path()),
    "toxicity": lambda d, s: toxicity.toxicity(d, s.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")),
    "winnowing": lambda d, s: winnowing.document_fingerprints(d),
    "html": lambda d, s: html_layout.extract_text(d, "text"),
}


@pytest.mark.parametrize("name", CASES)
def test_empty_null_and_clashing(spark, name):
    schema = "doc_id long, text string, source string, lang string, id long, fp long, n_lines int, `row.x` string, in_0 int, base string"
    rows = [(1, "some words here", "a", "en", 5, 6, 7, "r", 8, "b"), (1, "some words here", "a", "en", 5, 6, 7, "r", 8, "b"), (None, "no id", None, None, None, None, None, None, None, None), (3, None, None, "en", 1, 2, 3, "x", 4, None)]
    df = spark.createDataFrame(rows, schema)
    out = CASES[name](df, spark)
    assert out.count() == 4 and len(set(out.columns)) == len(out.columns)
    if name != "winnowing":
        assert out.columns[:10] == df.columns and {r["row.x"] for r in out.collect()} == {"r", "x", None}
    assert CASES[name](spark.createDataFrame([], schema), spark).count() == 0


def test_units_of_long_and_separated_words():
    insult = "grobnikverfluchterschwachkopfdudummer"
    assert toxicity.units_of(insult) == set(toxicity.windows(insult)) and len(toxicity.windows(insult)) > 1
    apart = "-".join(insult * 3)
    closed = set(toxicity.windows(insult * 3))
    assert closed <= toxicity.units_of(apart) and all(any(insult[i : i + 8] in w for w in closed) for i in range(len(insult) - 8))
    assert toxicity.units_of("a g r o b n i k b") >= {"agrobnikb"} and toxicity.units_of(" .. ") == set()


def test_toxicity_of_fixed_phrases_and_copies(spark):
    """A word that always follows the same one is learned; words of many copies of one toxic text are not."""
    rng = random.Random(16)
    rows, labels = [], []
    for i in range(500):
        words = prose(rng, 40).split()
        bad = i % 4 == 0
        if bad:
            words[rng.randrange(39)] = "olde grobnik"
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    copy = prose(random.Random(17), 30) + " kwentzal olde grobnik"
    rows += [(1000 + i, copy) for i in range(300)]
    labels += [(1000 + i, 1) for i in range(300)]
    rows += [(2000, "olde grobnik"), (2001, prose(random.Random(18), 30) + " kwentzal"), (2002, "olde")]
    out = {r.doc_id: r for r in toxicity.toxicity(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert out[2000].score > 0.5 and out[2001].predicted == 0
    held = [(out[i].predicted, y) for i, y in labels if out[i].held_out and i < 1000]
    assert np.mean([p == y for p, y in held]) > 0.97


def test_toxicity_of_texts_without_words(spark):
    labels = spark.createDataFrame([(i, int(i < 10)) for i in range(40)], "doc_id long, toxic int")
    out = toxicity.toxicity(frame(spark, [(i, None if i < 10 else "some words") for i in range(40)]), labels).collect()
    assert len(out) == 40 and len({r.score for r in out}) == 1


@pytest.mark.parametrize("rank", [64, 12])
def test_recall_of_vectors_that_no_codebook_has_seen(rank):
    """Pairs at a cosine of 0.9 outside the sample, at 20,000, a million and 30 million vectors."""
    rng = np.random.default_rng(rank)
    basis = rng.standard_normal((rank, 64)) if rank < 64 else np.eye(64)
    unit = lambda x: x / np.linalg.norm(x, axis=1)[:, None]
    drawn = lambda n: unit(rng.standard_normal((n, rank)) @ basis)
    sample, x, z = drawn(9000), drawn(1500), drawn(1500)
    y = 0.9 * x + np.sqrt(0.19) * unit(z - (z * x).sum(1)[:, None] * x)
    for n in (20_000, 1_000_000, 30_000_000):
        grid = multi_index.fit_grid(sample[900:], sample[:900], n, 0.9, 0.98)
        assert np.mean(np.minimum(grid.rank(x, grid.home(y)), grid.rank(y, grid.home(x))) <= grid.visits) >= 0.95


def test_ranks_of_cells_are_places_in_the_order():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((40, 8))
    grid = multi_index.Grid(rng.standard_normal((7, 4)), rng.standard_normal((5, 4)))
    order = grid.order(x, 35)
    assert sorted(order[0].tolist()) == list(range(35)) and all(np.array_equal(grid.order(x, v), order[:, :v]) for v in (1, 2, 6, 20))
    for k in range(35):
        assert (grid.rank(x, order[:, k]) == k + 1).all()


def test_links_through_a_grid_of_many_cells(spark):
    """Clusters of vectors, so that cells are many and visits few: true links only, and nearly all of them."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((150, 32))[rng.integers(0, 150, 6000)] + 0.3 * rng.standard_normal((6000, 32))
    x = x.astype(np.float32)
    u = multi_index.normal(x, 32)
    grid = multi_index.fit_grid(u[600:], u[:600], len(u), 0.9, 0.98)
    assert len(grid.first) > 3 and grid.visits < len(grid.first) * len(grid.second) / 2
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    out = multi_index.embedding_links(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>"))
    found = {r.vec_id: r.n_links for r in out.collect()}
    true = near.sum(1)
    assert all(found[i] <= true[i] for i in found) and sum(found.values()) >= 0.95 * true.sum() > 1000
