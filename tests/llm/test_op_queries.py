"""The registered queries as they are, over the smallest tables: against their SQL, or against brute force."""

import hashlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece

from pagelake.llm import html_layout, winnowing
from pagelake.llm.queries import QUERIES, SQL, model_path
from tests.conftest import SF
from tests.llm.test_operators import plain_fingerprint, plain_winnowing, sha
from tests.test_queries import TABLES, plain


@pytest.fixture(scope="module")
def texts():
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).sort_by("doc_id")
    return dict(zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True))


def rows_of(df, sql, tables):
    con = duckdb.connect()
    for name, path in tables.items():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    names, other = sorted(df.columns), con.sql(sql)
    at = [other.columns.index(c) for c in names]
    assert sorted(other.columns) == names
    ours = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    return ours, sorted((tuple(plain(r[i]) for i in at) for r in other.fetchall()), key=repr)


@pytest.mark.parametrize("name", SQL)
def test_same_rows_as_sql(spark, name):
    ours, theirs = rows_of(QUERIES[name](spark, SF), SQL[name], {t: f"{SF}/{t}.parquet" for t in TABLES})
    assert ours == theirs


def test_personal_data_with_planted_terms(spark, tmp_path):
    odd = [(90_000 + i, f"Xo Quentzal é {i} {'lorem ' * i} write to q.z@mail.org, 4111 1111 1111 1111 or +1 (555) 123-4567 Quentzal's q.z@mail.org.Xo") for i in range(6)]
    odd += [(91_000, "QUENTZAL alone"), (91_001, None), (91_002, "")]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op3_pii"](spark, str(tmp_path))
    ours, theirs = rows_of(out, SQL["op3_pii"], {"documents": f"{tmp_path}/documents.parquet/*.parquet"})
    assert ours == theirs and "remove:0:8" in [r.spans for r in out.where("doc_id = 91000").collect()]


def test_links_with_planted_vectors(spark, tmp_path):
    """Two sizes, so grids of unlike size: what is found are true links, at least 0.95 of them, with ties at the threshold."""
    rng = np.random.default_rng(3)
    for n in (300, 3000):
        x = rng.standard_normal((n, 16))
        x = np.concatenate([x, x[: n // 4] + 0.08 * rng.standard_normal((n // 4, 16)), x[:20]])
        exact = np.zeros((2, 16))
        exact[0, 0] = exact[1, 0] = 3.0
        exact[1, 1] = 1.0
        rows = [(i, [float(v) for v in r]) for i, r in enumerate(np.concatenate([x, exact]).astype(np.float32))] + [(10**6, None), (10**6 + 1, [0.0] * 16), (10**6 + 2, [float("inf")] * 16), (10**6 + 3, [1.0])]
        path = f"{tmp_path}/{n}"
        spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3).write.parquet(f"{path}/embeddings.parquet")
        ours, theirs = rows_of(QUERIES["op6_embedding_links"](spark, path), SQL["op6_embedding_links"], {"embeddings": f"{path}/embeddings.parquet/*.parquet"})
        # Columns in order of name: component_id, kept, n_links, vec_id.
        mine, true = ({r[3]: r[2] for r in part} for part in (ours, theirs))
        assert all(mine[i] <= true[i] for i in true) and sum(mine.values()) >= 0.95 * sum(true.values()) > 0
        assert np.mean([a == b for a, b in zip(ours, theirs, strict=True)]) > 0.97


def test_links_of_no_vectors_and_of_repeated_ids(spark, tmp_path):
    from pagelake.llm.multi_index import embedding_links

    schema = "vec_id long, embedding array<float>, n_links string, id int"
    assert embedding_links(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, [1.0, 0.0], "x", 1), (1, [1.0, 0.0], "x", 1), (2, [1.0, 0.1], "y", 2), (None, [1.0, 0.0], "z", 3), (3, None, "z", 3)]
    out = embedding_links(spark.createDataFrame(rows, schema))
    assert out.columns == ["vec_id", "embedding", "n_links", "id", "component_id", "kept"]
    assert sorted((r.vec_id or 0, r.component_id or 0, r.kept) for r in out.collect()) == [(0, 0, False), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]


def test_fingerprints(spark, texts):
    order = list(texts)
    for r in QUERIES["op2_winnowing"](spark, SF).collect():
        t, after = texts[r.doc_id] or "", texts[order[(order.index(r.doc_id) + 1) % len(order)]] or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        assert r.n_chars == len(t) and r.edited_sha256 == sha(edited)
        for text, found in ((t, r.fingerprint), (edited, r.edited_fingerprint)):
            assert found == " ".join(f"{(v >> winnowing._BITS) % 2**32:08X}@{winnowing._LAST - (v & winnowing._LAST)}" for v in plain_winnowing(text))


def test_pieces(spark, texts):
    lib = sentencepiece.SentencePieceProcessor(model_file=model_path())
    for r in QUERIES["op4_sentencepiece"](spark, SF).collect():
        ids = lib.encode(texts[r.doc_id] or "", add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(lib.decode(ids)))


def test_toxicity_of_the_given_labels(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    out = QUERIES["op7_toxicity"](spark, SF).collect()
    held = [(r.predicted, labels[r.doc_id]) for r in out if r.held_out and r.doc_id in labels]
    assert len(out) == len({r.doc_id for r in out}) and np.mean([p == y for p, y in held]) >= 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


def test_pages(spark):
    pages = dict(zip(*(pq.read_table(f"{SF}/pages.parquet")[c].to_pylist() for c in ("page_id", "html")), strict=True))
    got = {r.page_id: (r.visible_text, r.n_lines) for r in QUERIES["op9_html_text"](spark, SF).collect()}
    assert got == {k: ((t := html_layout.visible_text(h)), t.count("\n") + 1 if t else 0) for k, h in pages.items()}


def test_simhash_query(spark, texts):
    fp = {i: plain_fingerprint(t) for i, t in texts.items()}
    label = {i: i for i in fp}
    while (new := {i: min(label[j] for j in fp if (fp[i] ^ fp[j]).bit_count() <= 2) for i in fp}) != label:
        label = new
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op10_simhash"](spark, SF).collect()} == {i: (f"{fp[i]:016x}", label[i]) for i in fp}
