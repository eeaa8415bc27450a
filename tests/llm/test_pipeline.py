"""The pipeline against its own stages' brute-force forms."""

import corpus_pipeline
from pagelake.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.test_operators import plain_fingerprint


def test_stages_keep_the_columns_and_their_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0).unionByName(spark.read.parquet(f"{SF}/documents.parquet"))
    toxic = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert toxic.columns == docs.columns and 0.7 * docs.count() < toxic.count() < docs.count()
    lines = corpus_pipeline.drop_lines(spark, docs, SF)
    rows = lines.collect()
    assert lines.columns == docs.columns and all(r.n_chars == len(r.text or "") for r in rows)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()}
    fp = {r.doc_id: plain_fingerprint(r.text) for r in docs.collect()}
    label = {i: i for i in fp}
    for _ in range(10):
        label = {i: min(label[j] for j in fp if (fp[i] ^ fp[j]).bit_count() <= 2) for i in fp}
    assert kept == {i for i in fp if label[i] == i}
    mixed = corpus_pipeline.mix(spark, docs, SF)
    assert mixed.columns == docs.columns and 0 < mixed.count() < docs.count()


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "mixing", "sentencepiece"]
    assert rows and len({r.doc_id for r in rows}) == len(rows) and all(len(r.ids_sha256) == 64 and r.n_tokens >= 2 for r in rows)


def test_queries_cover_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
