"""The corpus operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.llm import mixing, periodic, pii, winnowing
from pagelake.llm.html_layout import extract_text
from pagelake.llm.licences import base_places, scan_licences
from pagelake.llm.line_dedup import line_dedup
from pagelake.llm.mixing import mix_sources
from pagelake.llm.multi_index import embedding_links
from pagelake.llm.pieces import encode_pieces
from pagelake.llm.resampling import resample
from pagelake.llm.simhash import simhash_dedup
from pagelake.llm.substring_dedup import substring_dedup
from pagelake.llm.toxicity import toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def model_path() -> str:
    """The public merge-type vocabulary that op4 and the pipeline encode with."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return out.select("doc_id", blank("source"), blank("lang"), "topic", "n_tokens", F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), "kept")


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = winnowing.document_fingerprints(_table(spark, sf_dir, "documents"))
    return out.select(
        F.col("id").alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        winnowing.written("fp").alias("fingerprint"),
        winnowing.written("edited_fp").alias("edited_fingerprint"),
        winnowing.likeness("fp", "edited_fp").alias("near_edited"),
        winnowing.likeness("fp", "next_fp").alias("near_next"),
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.sanitise(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [pii.count_of(kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return out.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_pieces(_table(spark, sf_dir, "documents").select("doc_id", "text"), model_path())
    return out.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).select("vec_id", "n_links", "component_id", "kept")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "n_lines", "visible_text")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fingerprint", "component_id")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", periodic.with_planted_run(F.col("text"), F.col("doc_id")).alias("text"))
    out = periodic.periodic_runs(docs)
    best = out.withColumn("best", periodic.longest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periodic.written(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_licences(_table(spark, sf_dir, "documents").select("doc_id", "text")).withColumn("base", base_places(F.col("places")))
    word = F.transform("base", lambda p: p["word"])
    return out.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(word).alias("first_word"),
        F.array_max(word).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("base", lambda p: p["label"]))), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
        F.array_join(F.transform("expressions", lambda e: e["written"]), "; ").alias("expressions"),
        "restriction",
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark").select("text"), texts=False)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


OP8_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first, max(doc_id) AS last FROM k WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)),
m AS (SELECT k.doc_id, k.i, k.line, f.first IS NOT NULL AND k.doc_id > f.first AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP5_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, i, substr(h, (2 * i + 1)::BIGINT, 100) AS g FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 49, 0))) AS i FROM d)),
f AS (SELECT g, min(doc_id) AS first FROM s GROUP BY g HAVING min(doc_id) < max(doc_id)),
l AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM s JOIN f USING (g) WHERE first < doc_id),
r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (SELECT doc_id, i, count(*) FILTER (step IS NULL OR step > 50) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM l) GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM r),
c AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last, string_agg(substr(h, (2 * before + 1)::BIGINT, (2 * (a - before))::BIGINT), '' ORDER BY a) AS kept FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
    sha256(unhex(coalesce(kept, '') || substr(h, (2 * coalesce(last, 0) + 1)::BIGINT))) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""

#: All pairs, so for small tables. What the index finds is a subset of these links wherever its recall is below 1.
OP6_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: coalesce(x <> 0, false)))),
p AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a AS vec_id, least(a, min(b)) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""

#: CRC-32, which DuckDB lacks: t has what the register turns a low byte into.
CRC = "t AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b)) AS t)"


def _crc(x: str) -> str:
    each = f"list_transform(range(octet_length(encode({x}))), lambda i: ('0x' || substr(hex(encode({x})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(4294967295, list_reduce({each}, lambda c, b: xor(t.t[(xor(c, b) & 255) + 1], c >> 8), 4294967295))"


OP11_SQL = rf"""
WITH {CRC},
d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, {_crc("doc_id::VARCHAR")} AS h FROM documents, t),
p AS (SELECT doc_id, w, h % 10 = 0 AND len(w) > 0 AS planted, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS many FROM d),
x AS (SELECT doc_id, CASE WHEN planted THEN list_transform(range(len(w)), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(w) - a) // many) END + 1]) ELSE w END AS w FROM p),
g AS (SELECT doc_id, unnest(range(len(w) - 5)) AS i, unnest(list_transform(range(len(w) - 5), lambda i: array_to_string(w[i + 1:i + 6], ' '))) AS gram FROM x WHERE len(w) >= 12),
m AS (SELECT a.doc_id, b.i - a.i AS q, a.i FROM g AS a JOIN g AS b ON a.doc_id = b.doc_id AND a.gram = b.gram AND a.i < b.i),
n AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m),
s AS (SELECT doc_id, q, min(i) AS start, max(i) + 6 - min(i) + q AS length FROM n GROUP BY doc_id, q, island),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, start, length),
o AS (SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(start := start, length := length, period := period), (-length, start, period)) AS best, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY doc_id),
u AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
y AS (SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS word FROM x),
k AS (SELECT y.doc_id, string_agg(word, ' ' ORDER BY y.i) AS kept FROM y ANTI JOIN u USING (doc_id, i) GROUP BY y.doc_id)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length, best.period::BIGINT AS period, (1000 * best.length // best.period)::BIGINT AS exponent_milli,
    sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM x LEFT JOIN o USING (doc_id) LEFT JOIN k USING (doc_id)
"""

_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
_RUNS = "unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS x"

OP13_SQL = f"""
WITH {CRC},
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT {_WORDS} AS w FROM benchmark),
f AS (SELECT doc_id, {_RUNS} FROM d),
e AS (SELECT {_RUNS} FROM g),
u AS (SELECT x, {_crc("x")} % 10000 AS b FROM (SELECT x FROM f UNION SELECT x FROM e), t),
s AS (SELECT b, count(*) AS n FROM f JOIN u USING (x) GROUP BY b),
v AS (SELECT b, count(*) AS n FROM e JOIN u USING (x) GROUP BY b),
k AS (SELECT b, floor(1000 * ln((coalesce(v.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE / ((s.n + 1) * ((SELECT coalesce(sum(n), 0) FROM v) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN v USING (b)),
m AS (SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM f JOIN u USING (x) JOIN k USING (b) GROUP BY doc_id),
o AS (SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS fit,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN m USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS place FROM o)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= (SELECT 5 * count(*) // 100 FROM o WHERE fit) THEN place END AS rank FROM r
"""

QUERIES = {
    "op1_source_mixing": op1_source_mixing,
    "op2_winnowing": op2_winnowing,
    "op3_pii": op3_pii,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_embedding_links": op6_embedding_links,
    "op7_toxicity": op7_toxicity,
    "op8_line_dedup": op8_line_dedup,
    "op9_html_text": op9_html_text,
    "op10_simhash": op10_simhash,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_licence_scan": op12_licence_scan,
    "op13_importance_resampling": op13_importance_resampling,
}
SQL = {
    "op1_source_mixing": mixing.oracle(),
    "op3_pii": pii.oracle(),
    "op5_substring_dedup": OP5_SQL,
    "op6_embedding_links": OP6_SQL,
    "op8_line_dedup": OP8_SQL,
    "op11_periodic_runs": OP11_SQL,
    "op13_importance_resampling": OP13_SQL,
}
