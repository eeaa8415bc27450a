"""All queries over the given tables, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagelake.functions import catalog
from pagelake.functions import regions as R
from pagelake.functions import text as T
from pagelake.operators import detection, joins, markdown, model, reports, viewer
from pagelake.operators.images import data_uri
from pagelake.sources import fixtures as X
from pagelake.sources import scans
from pagelake.streaming import windows

FLAGSHIP = "regions_detected"
QUERIES: dict = {}
SQL: dict[str, str] = {}

TYPE_LIST = "[" + ", ".join(f"'{t}'" for t in R.REGION_TYPES) + "]"
# The fixture tables in DuckDB, as common table expressions.
CTE = {
    "raw": f"""raw AS (SELECT l_orderkey AS page_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS pos,
        {TYPE_LIST}[l_partkey % 7 + 1] AS type, l_linenumber AS reading_order, l_partkey % 1001 AS nx, l_suppkey * 7 % 1001 AS ny, l_partkey * 3 % 1000 + 1 AS nw,
        l_quantity::BIGINT * 13 % 1000 + 1 AS nh, 1240 AS img_w, 1754 AS img_h, l_partkey AS k FROM lineitem)""",
    "px": """px AS (SELECT *, greatest(0, least(trunc(nx * img_w / 1000.0)::BIGINT, img_w - 1)) AS x0, greatest(0, least(trunc(ny * img_h / 1000.0)::BIGINT, img_h - 1)) AS y0 FROM raw WHERE pos < 12),
        pw AS (SELECT *, greatest(10, least(trunc(nw * img_w / 1000.0)::BIGINT, img_w - x0)) AS w0, greatest(10, least(trunc(nh * img_h / 1000.0)::BIGINT, img_h - y0)) AS h0, greatest(0, x0 - 3) AS x1, greatest(0, y0 - 5) AS y1 FROM px),
        det AS (SELECT page_id, type, row_number() OVER (PARTITION BY page_id ORDER BY reading_order, pos) AS reading_order, pos, x1::INT AS x, y1::INT AS y, least(w0 + 6, img_w - x1)::INT AS width, least(h0 + 10, img_h - y1)::INT AS height, img_w, img_h FROM pw)""",
    "scan": """scan AS (SELECT page_id AS page, ['scan_', 'Scan-', 's'][page_id % 3 + 1] || page_id || ['.png', '.JPG', '.tif', '.webp', '.pdf', '.txt', '.jpeg', '.TIFF'][page_id % 8 + 1] AS file_name,
        (page_id * 37 % 2000 + 800)::INT AS width, (page_id * 53 % 2000 + 1000)::INT AS height FROM pages)""",
    "tr": f"""t0 AS (SELECT d.doc_id, d.text, coalesce(l.toxic, 0) = 1 AS failed, {TYPE_LIST}[d.doc_id % 7 + 1] AS type FROM documents d LEFT JOIN labels l USING (doc_id)),
        tr AS (SELECT doc_id // 5 AS page_id, (doc_id % 5)::INT AS pos, (5 - doc_id % 5)::INT AS reading_order, printf('r%02d', 5 - doc_id % 5) AS id, type, CASE WHEN failed THEN 'error' ELSE 'success' END AS status,
        CASE WHEN failed THEN '' WHEN type = 'PageNumberRegion' THEN (doc_id % 90)::VARCHAR ELSE text END AS text, CASE WHEN type = 'PageNumberRegion' THEN (doc_id % 90)::VARCHAR END AS page_number,
        CASE WHEN type = 'TableRegion' THEN (doc_id % 40)::INT END AS rows, CASE WHEN type = 'TableRegion' AND doc_id % 3 <> 0 THEN (doc_id % 12)::INT END AS cols,
        CASE WHEN type = 'TableRegion' AND doc_id % 2 = 0 THEN 2 END AS header_rows, CASE WHEN type = 'TableRegion' THEN doc_id % 4 = 0 END AS has_red_ink, CASE WHEN type = 'TableRegion' THEN doc_id % 5 = 0 END AS has_totals_row,
        CASE WHEN type = 'GraphRegion' AND doc_id % 2 = 0 THEN 'scatter' END AS graph_type, CASE doc_id % 3 WHEN 0 THEN 'latin' WHEN 1 THEN 'mixed' END AS script FROM t0)""",
    "block": r"""st AS (SELECT *, trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM tr),
        bl AS (SELECT *, CASE WHEN t = '' OR type = 'PageNumberRegion' THEN NULL WHEN type = 'TitleRegion' THEN '## ' || t
        WHEN type = 'TableRegion' THEN '<!-- TableRegion: ' || coalesce(rows::VARCHAR, '?') || ' rows × ' || coalesce(cols::VARCHAR, '?') || ' cols, ' || coalesce(header_rows::VARCHAR, '?') || ' header row(s), red ink: ' || CASE WHEN has_red_ink THEN 'yes' ELSE 'no' END || ' -->' || chr(10)
            || CASE WHEN starts_with(t, '```') THEN t WHEN starts_with(lower(t), '<table') THEN '```html' || chr(10) || t || chr(10) || '```' ELSE t END
        WHEN type = 'GraphRegion' THEN '<!-- GraphRegion: ' || coalesce(graph_type, 'unknown') || ' -->' || chr(10) || t
        WHEN type = 'MarginaliaRegion' THEN '> *[Marginalie]*' || chr(10) || '> ' || replace(t, chr(10), chr(10) || '> ')
        WHEN type = 'FootnoteRegion' THEN '[^fn]: ' || replace(t, chr(10), chr(10) || '    ') ELSE t END AS block FROM st)""",
    "md": """tc AS (SELECT page_id, type, count(*) AS n, min(reading_order) AS first FROM tr GROUP BY ALL),
        rs AS (SELECT page_id, string_agg(type || '×' || n, ', ' ORDER BY first) AS regions_summary FROM tc GROUP BY page_id),
        pn AS (SELECT page_id, arg_min(coalesce(nullif(nullif(page_number, ''), '0'), nullif(text, '')), reading_order) AS page_number FROM tr WHERE type = 'PageNumberRegion' AND coalesce(nullif(nullif(page_number, ''), '0'), nullif(text, '')) IS NOT NULL GROUP BY page_id),
        bo AS (SELECT page_id, string_agg(block || chr(10), chr(10) ORDER BY reading_order, pos) AS body FROM bl GROUP BY page_id),
        md AS (SELECT page_id, '---' || chr(10) || 'page_id: ' || page_id || chr(10) || coalesce('page_number: ' || page_number || chr(10), '') || 'regions: "' || regions_summary || '"' || chr(10) || '---' || chr(10) || coalesce(chr(10) || body, '') AS md
        FROM rs LEFT JOIN pn USING (page_id) LEFT JOIN bo USING (page_id))""",
    "an": """an AS (SELECT conv_id, turn, '{"regions": [{"type": "TableRegion", "bbox": {"x": ' || (turn * 10 % 500) || ', "y": ' || (conv_id % 500) || ', "width": 100, "height": 50}, "reading_order": ' || turn || '}]}' AS body FROM conversations WHERE role = 'assistant'),
        aw AS (SELECT conv_id, turn, body, CASE conv_id % 4 WHEN 0 THEN '```json' || chr(10) || body || chr(10) || '```' WHEN 1 THEN 'Let me look. ' || body || ' Done.' WHEN 2 THEN body ELSE left(body, 40) END AS response FROM an)""",
    "tries": """tries AS (SELECT user_id * 1000000 + place // 4 AS call_id, place % 4 + 1 AS attempt, outcome FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS place,
        CASE WHEN event_type = 'error' THEN 'exception' WHEN event_type IN ('view', 'click') THEN 'empty' ELSE 'success' END AS outcome FROM events))""",
    "im": """ip AS (SELECT DISTINCT doc_id // 5 AS page_id FROM documents),
        im AS (SELECT page_id::VARCHAR AS stem, unnest([['.tiff', '.jpg', '.webp'][page_id % 3 + 1], ['.png', '.tif'][page_id % 2 + 1]]) AS ext FROM ip),
        best AS (SELECT stem, arg_min(ext, list_position(['.png', '.jpg', '.jpeg', '.webp', '.tif', '.tiff'], ext)) AS ext FROM im GROUP BY stem)""",
    "bx": f"""bx AS (SELECT (doc_id // 5)::VARCHAR AS stem, (row_number() OVER (PARTITION BY doc_id // 5 ORDER BY doc_id) - 1)::INT AS ord, 'r0' || (doc_id % 5 + 1) AS region_id,
        CASE WHEN doc_id % 13 = 0 THEN 'FullPage' WHEN doc_id % 11 = 0 THEN 'Odd<Region>' ELSE {TYPE_LIST}[doc_id % 7 + 1] END AS region_type, (n_chars % 1000)::INT AS x, (n_chars * 3 % 1500)::INT AS y, (n_chars % 300)::INT AS width, (doc_id * 7 % 200)::INT AS height
        FROM documents WHERE (doc_id // 5) % 11 <> 0),
        dr AS (SELECT * FROM bx WHERE region_type <> 'FullPage' AND width > 0 AND height > 0)""",
    "col": "co AS (SELECT unnest([" + ", ".join(f"'{k}'" for k in viewer.COLOURS) + "]) AS region_type, unnest([" + ", ".join(f"'{v}'" for v in viewer.COLOURS.values()) + "]) AS colour, unnest([" + ", ".join(str(i + 1) for i in range(len(viewer.COLOURS))) + "])::INT AS rank)",
}
ESCAPE = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


def query(sql: str | None, *ctes: str):
    """Register a query with its SQL over the named fixture tables."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = ("WITH " + ",\n".join(CTE[c] for c in ctes) + "\n" if ctes else "") + sql
        return f

    return add


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return X.raw_regions(spark, d).withColumn("box", F.struct(F.col("nx").alias("x"), F.col("ny").alias("y"), F.col("nw").alias("width"), F.col("nh").alias("height")))


@query("SELECT page_id, printf('r%02d', reading_order) AS id, type, x, y, width, height, reading_order::INT AS reading_order FROM det", "raw", "px")
def regions_detected(spark: SparkSession, d: str) -> DataFrame:
    """Cap, type, scale, margin, drop, order and number."""
    return detection.detect(_raw(spark, d)).select("page_id", "id", "type", "bbox.x", "bbox.y", "bbox.width", "bbox.height", "reading_order")


@query("SELECT page_id, count(*)::BIGINT AS total_regions, list(printf('r%02d', reading_order) ORDER BY reading_order) AS reading_order, list_sort(list(DISTINCT type)) AS region_types_detected FROM det GROUP BY page_id", "raw", "px")
def detection_summary(spark: SparkSession, d: str) -> DataFrame:
    """D16, D17, H7."""
    return detection.summary(detection.detect(_raw(spark, d)))


@query(
    "SELECT vec_id, 500 + 400 * embedding[2]::DOUBLE AS x, 500 + 400 * embedding[1]::DOUBLE AS y, (500 + 400 * embedding[4]::DOUBLE) - (500 + 400 * embedding[2]::DOUBLE) AS width, (500 + 400 * embedding[3]::DOUBLE) - (500 + 400 * embedding[1]::DOUBLE) AS height FROM embeddings WHERE 500 + 400 * embedding[3]::DOUBLE > 500 + 400 * embedding[1]::DOUBLE AND 500 + 400 * embedding[4]::DOUBLE > 500 + 400 * embedding[2]::DOUBLE"
)
def boxes_from_lists(spark: SparkSession, d: str) -> DataFrame:
    """Boxes in list form."""
    e = X.table(spark, d, "embeddings")
    values = F.to_json(F.transform(F.slice("embedding", 1, 4), lambda x: 500 + 400 * x.cast("double")))
    return e.select("vec_id", R.normal_box(F.parse_json(values)).alias("b")).where("b is not null").select("vec_id", "b.*")


@query("SELECT page_id, pos::INT AS pos, nx::DOUBLE AS x, ny::DOUBLE AS y, nw::DOUBLE AS width, nh::DOUBLE AS height FROM raw WHERE k % 6 <> 4", "raw")
def boxes_from_objects(spark: SparkSession, d: str) -> DataFrame:
    """Boxes in object form, all key styles."""
    return X.styled_boxes(spark, d).select("page_id", "pos", R.normal_box(F.col("bbox")).alias("b")).where("b is not null").select("page_id", "pos", "b.*")


@query("SELECT page_id, count(*)::BIGINT AS n_regions, count_if(k % 6 = 4)::BIGINT AS n_dropped, count_if(k % 6 IN (1, 2, 3))::BIGINT AS n_recovered FROM raw WHERE pos < 12 GROUP BY page_id", "raw")
def box_counts(spark: SparkSession, d: str) -> DataFrame:
    """D11, D12."""
    return detection.box_counts(X.styled_boxes(spark, d))


@query(
    f"""SELECT k, raw AS given, CASE WHEN raw IS NULL THEN 'TableRegion' ELSE coalesce(list_filter({TYPE_LIST}, lambda t: t = raw)[1], list_filter({TYPE_LIST}, lambda t: contains(lower(t), lower(raw)) OR contains(lower(raw), lower(t)))[1], 'ParagraphRegion') END AS type FROM (
    SELECT p_partkey AS k, CASE p_partkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'region' WHEN 3 THEN 'table' WHEN 4 THEN 'GRAPHREGION' WHEN 5 THEN 'old TitleRegion' WHEN 6 THEN p_type WHEN 7 THEN 'PageNumber' WHEN 8 THEN 'note' ELSE 'MarginaliaRegion' END AS raw FROM part)"""
)
def region_types(spark: SparkSession, d: str) -> DataFrame:
    """Names as models write them."""
    names = ["", "region", "table", "GRAPHREGION", "old TitleRegion", None, "PageNumber", "note", "MarginaliaRegion"]
    p = X.table(spark, d, "part")
    given = F.when(F.col("p_partkey") % 10 == 6, F.col("p_type"))
    for i, n in enumerate(names, 1):
        if n is not None:
            given = given.when(F.col("p_partkey") % 10 == i, n)
    return p.select(F.col("p_partkey").alias("k"), given.alias("given"), R.normal_type(given).alias("type"))


@query("SELECT conv_id, turn, CASE WHEN conv_id % 4 = 3 THEN left(body, 40) ELSE body END AS json, conv_id % 4 <> 3 AS parses FROM aw", "an")
def answers_parsed(spark: SparkSession, d: str) -> DataFrame:
    """The JSON in noisy answers, and whether it parses."""
    return detection.parse_answers(X.answers(spark, d)).select("conv_id", "turn", "json", F.col("data").isNotNull().alias("parses"))


@query("SELECT conv_id, turn, 0 AS pos, 'TableRegion' AS type, (turn * 10 % 500)::DOUBLE AS x, (conv_id % 500)::DOUBLE AS y, turn::INT AS reading_order FROM aw WHERE conv_id % 4 <> 3", "an")
def answers_unnested(spark: SparkSession, d: str) -> DataFrame:
    """Regions out of answers."""
    keys = ["conv_id", "turn"]
    raw = detection.fields(detection.unnest_regions(detection.parse_answers(X.answers(spark, d)), keys), keys)
    return raw.withColumn("b", R.normal_box(F.col("bbox"))).select("conv_id", "turn", "pos", "type", "b.x", "b.y", "reading_order")


@query("SELECT conv_id, turn, 'error' AS status, 'JSON parse' AS error, left(response || repeat('.', 600), 500) AS detail, 0 AS total_regions FROM aw WHERE conv_id % 4 = 3", "an")
def detection_errors(spark: SparkSession, d: str) -> DataFrame:
    """Failed pages as records."""
    a = detection.parse_answers(X.answers(spark, d)).where("data is null")
    page = F.struct("conv_id", "turn").alias("page_id")
    bad = a.select(page, F.lit("JSON parse").alias("error"), F.concat("response", F.repeat(F.lit("."), 600)).alias("detail"))
    return detection.error_record(bad).select("page_id.*", "status", "error", "detail", "total_regions")


@query(
    """SELECT page, file_name, row_number() OVER (ORDER BY lower(regexp_extract(file_name, '^[^0-9]+')), regexp_extract(file_name, '[0-9]+')::BIGINT)::INT AS seq
    FROM scan WHERE regexp_matches(lower(file_name), '[.](jpg|jpeg|png|tif|tiff|webp)$')""",
    "scan",
)
def scans_in_order(spark: SparkSession, d: str) -> DataFrame:
    """A1, F1: supported files in natural order."""
    files = scans.in_order(X.scan_names(spark, d))
    return scans.numbered(files.select("page", "file_name", "natural"), F.col("natural")).select("page", "file_name", "seq")


@query("SELECT page, file_name, row_number() OVER (PARTITION BY page // 10 ORDER BY lower(regexp_extract(file_name, '^[^0-9]+')), regexp_extract(file_name, '[0-9]+')::BIGINT, lower(regexp_extract(file_name, '[.].*$')))::INT AS seq FROM scan", "scan")
def names_in_order(spark: SparkSession, d: str) -> DataFrame:
    """full names in natural order, within groups of ten pages."""
    s = X.scan_names(spark, d)
    by = Window.partitionBy(F.floor(F.col("page") / 10)).orderBy(T.natural_key(F.col("file_name")))
    return s.select("page", "file_name", F.row_number().over(by).cast("int").alias("seq"))


@query(
    """SELECT file_name, CASE lower(regexp_extract(file_name, '([.][^.]*)$', 1)) WHEN '.jpg' THEN 'image/jpeg' WHEN '.jpeg' THEN 'image/jpeg' WHEN '.tif' THEN 'image/tiff' WHEN '.tiff' THEN 'image/tiff' WHEN '.webp' THEN 'image/webp' ELSE 'image/png' END AS mime FROM scan""",
    "scan",
)
def mime_types(spark: SparkSession, d: str) -> DataFrame:
    """A4, G4."""
    return X.scan_names(spark, d).select("file_name", T.mime_of(T.suffix_of(F.col("file_name"))).alias("mime"))


@query(
    """SELECT stem || '_' || side AS page_id, side, x0::INT AS x0, x1::INT AS x1, (x1 - x0)::INT AS width, height FROM (
    SELECT *, regexp_replace(file_name, '[.][^.]*$', '') AS stem, unnest(['L', 'R']) AS side, unnest([0, width // 2 - 10]) AS x0, unnest([width // 2 + 10, width]) AS x1 FROM scan WHERE regexp_matches(lower(file_name), '[.](jpg|jpeg|png|tif|tiff|webp)$'))""",
    "scan",
)
def spreads_split(spark: SparkSession, d: str) -> DataFrame:
    """Two pages of a spread."""
    s = scans.in_order(X.scan_names(spark, d))
    return s.select(F.explode(R.split_spread(F.col("stem"), F.col("width"), F.col("height"))).alias("p")).select("p.*")


@query("SELECT regexp_replace(file_name, '[.][^.]*$', '') AS page_id, width, height FROM scan WHERE regexp_matches(lower(file_name), '[.](jpg|jpeg|png|tif|tiff|webp)$')", "scan")
def single_pages(spark: SparkSession, d: str) -> DataFrame:
    """C1."""
    return scans.in_order(X.scan_names(spark, d)).select(F.col("stem").alias("page_id"), "width", "height")


@query("SELECT file_name, least(width, 1600)::INT AS width, CASE WHEN width > 1600 THEN trunc(height * (1600.0::DOUBLE / width))::INT ELSE height END AS height FROM scan", "scan")
def viewer_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Sizes after scaling."""
    return X.scan_names(spark, d).select("file_name", R.viewer_size(F.col("width"), F.col("height"), 1600).alias("s")).select("file_name", "s.*")


@query("SELECT doc_id, 'data:image/jpeg;base64,' || base64(encode(text)) AS uri FROM documents")
def data_uris(spark: SparkSession, d: str) -> DataFrame:
    """C11."""
    return X.table(spark, d, "documents").select("doc_id", data_uri(F.col("text").cast("binary"), "image/jpeg").alias("uri"))


@query("SELECT label, arg_max(i, s.score - i * 1e-12)::INT AS angle, round(max(score), 9) AS score FROM (SELECT label, i, var_pop(v) AS score FROM (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) GROUP BY ALL) s GROUP BY label")
def steepest_profile(spark: SparkSession, d: str) -> DataFrame:
    """H8, H9: of each label's profiles the one that varies most, the first among equals."""
    v = X.table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    scores = v.groupBy("label", "i").agg(F.var_pop(F.col("v").cast("double")).alias("score"))
    return scores.groupBy("label").agg(F.max_by("i", F.struct("score", (-F.col("i")).alias("o"))).alias("angle"), F.round(F.max("score"), 9).alias("score"))


@query("SELECT page_id, id, block FROM bl", "tr", "block")
def region_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Each region's Markdown."""
    return X.transcribed(spark, d).select("page_id", "id", markdown.block().alias("block"))


@query("SELECT page_id, md FROM md", "tr", "block", "md")
def page_documents(spark: SparkSession, d: str) -> DataFrame:
    """Each page's Markdown."""
    return markdown.region_documents(X.transcribed(spark, d))


@query("SELECT page_id, regions_summary FROM rs", "tr", "block", "md")
def region_summaries(spark: SparkSession, d: str) -> DataFrame:
    """H1."""
    return markdown.region_summary(X.transcribed(spark, d))


@query("SELECT page_id, page_number FROM pn", "tr", "block", "md")
def page_numbers(spark: SparkSession, d: str) -> DataFrame:
    """F5."""
    return markdown.page_numbers(X.transcribed(spark, d))


_NUMBERED = "CASE WHEN doc_id % 7 = 0 THEN 'Seite: ' || doc_id || chr(10) || text WHEN doc_id % 7 = 1 THEN '   ' WHEN doc_id % 7 = 2 THEN text || chr(10) || 'p. ' || doc_id ELSE text END"


def _full_pages(spark: SparkSession, d: str) -> DataFrame:
    t = X.table(spark, d, "documents")
    n = F.col("doc_id").cast("string")
    text = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("Seite: "), n, F.lit("\n"), "text")).when(F.col("doc_id") % 7 == 1, "   ").when(F.col("doc_id") % 7 == 2, F.concat("text", F.lit("\np. "), n)).otherwise(F.col("text"))
    kind = F.element_at(F.array(F.lit("table"), F.lit("graph"), F.lit("map")), (F.col("doc_id") % 3 + 1).cast("int"))
    return t.select(F.col("doc_id").alias("page_id"), kind.alias("doc_type"), text.alias("text"), F.lit("success").alias("status"))


@query(
    f"""SELECT doc_id AS page_id, '---' || chr(10) || 'page_id: ' || doc_id || chr(10) || 'doc_type: ' || ['table', 'graph', 'map'][doc_id % 3 + 1] || chr(10) || 'processing_mode: full_page' || chr(10)
    || CASE WHEN n <> '' THEN 'page_number: ' || n || chr(10) ELSE '' END || '---' || chr(10) || coalesce(nullif(trim(x, chr(32) || chr(9) || chr(10) || chr(13)), ''), '{T.EMPTY_BODY}') || chr(10) AS md
    FROM (SELECT doc_id, x, regexp_extract(x, '(?im)^\\s*(?:page|seite|pg|p\\.?)\\s*[:.\\-]?\\s*(\\d+)\\s*$', 1) AS n FROM (SELECT doc_id, {_NUMBERED} AS x FROM documents))"""
)
def full_page_documents(spark: SparkSession, d: str) -> DataFrame:
    """I9, I10."""
    return markdown.full_page_documents(_full_pages(spark, d))


@query(f"SELECT doc_id AS page_id, '[{{\"id\":\"r01\",\"type\":\"FullPage\",\"doc_type\":\"' || ['table', 'graph', 'map'][doc_id % 3 + 1] || '\",\"transcription\":{{\"status\":\"success\",\"text\":' || to_json({_NUMBERED}) || '}}}}]' AS json FROM documents")
def full_page_json(spark: SparkSession, d: str) -> DataFrame:
    """B4."""
    return markdown.full_page_json(_full_pages(spark, d))


@query(
    """SELECT page_id, '[' || string_agg('{"id":"' || printf('r%02d', reading_order) || '","type":"' || type || '","bbox":{"x":' || x || ',"y":' || y || ',"width":' || width || ',"height":' || height || '},"reading_order":' || reading_order || '}', ',' ORDER BY reading_order) || ']' AS json FROM det GROUP BY page_id""",
    "raw",
    "px",
)
def regions_json(spark: SparkSession, d: str) -> DataFrame:
    """B3."""
    return markdown.regions_json(detection.detect(_raw(spark, d)), ["id", "type", "bbox", "reading_order"])


@query("SELECT page_id, page_id::VARCHAR AS meta_id, coalesce(page_number, '') AS number, regions_summary AS regions, coalesce(chr(10) || body, '') AS body FROM rs LEFT JOIN pn USING (page_id) LEFT JOIN bo USING (page_id)", "tr", "block", "md")
def front_matter(spark: SparkSession, d: str) -> DataFrame:
    """What is written is read again."""
    docs = markdown.region_documents(X.transcribed(spark, d)).withColumn("meta", T.front_matter(F.col("md")))
    get = lambda k: F.try_element_at("meta", F.lit(k))
    return docs.select("page_id", get("page_id").alias("meta_id"), F.coalesce(get("page_number"), F.lit("")).alias("number"), get("regions").alias("regions"), T.body_of(F.col("md")).alias("body"))


_ENDED = "CASE WHEN contains({0}, '<table') AND NOT contains({0}, '</table>') THEN rtrim({0}, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(32) || chr(133) || chr(160)) || chr(10) || '</table>' ELSE {0} END"


@query(f"SELECT page_id, {_ENDED.format('html')} AS closed, {_ENDED.format('given')} AS opened, len(regexp_extract_all(marked, '(?m)^```')) % 2 = 1 AS odd FROM (SELECT page_id, html, '<table>' || html AS given, replace(html, '<p', chr(10) || '```') AS marked FROM pages)")
def tables_closed(spark: SparkSession, d: str) -> DataFrame:
    """Every page as it is, with a table opened before it, and with a fence for each paragraph."""
    p = X.table(spark, d, "pages")
    fenced = F.replace("html", F.lit("<p"), F.lit("\n```"))
    return p.select("page_id", T.close_table(F.col("html")).alias("closed"), T.close_table(F.concat(F.lit("<table>"), "html")).alias("opened"), T.odd_fences(fenced).alias("odd"))


@query("SELECT page_id, regexp_replace(html || '<table class=\"a\">' || chr(10) || html || '</table>' || url || '<table>' || page_id || '</table>', '(<table\\b[\\s\\S]*?</table>)', '<div class=\"table-wrap\">\\1</div>', 'g') AS wrapped FROM pages")
def tables_wrapped(spark: SparkSession, d: str) -> DataFrame:
    """Every page, followed by itself in a table and by a small one."""
    p = X.table(spark, d, "pages")
    text = F.concat("html", F.lit('<table class="a">\n'), "html", F.lit("</table>"), "url", F.lit("<table>"), F.col("page_id").cast("string"), F.lit("</table>"))
    return p.select("page_id", T.wrap_tables(text).alias("wrapped"))


@query(f"SELECT page_id, {ESCAPE.format('html')} AS escaped, coalesce(nullif(trim(regexp_replace(url, '[^a-zA-Z0-9_-]+', '-', 'g'), '-'), ''), 'page') AS anchor, lower(page_id || ' ' || (page_id % 90) || ' ' || url) AS blob, contains(lower(page_id || ' ' || (page_id % 90) || ' ' || url), 'example.org') AS hit FROM pages")
def page_strings(spark: SparkSession, d: str) -> DataFrame:
    """I18-I21."""
    p = X.table(spark, d, "pages").select(F.col("page_id").cast("string").alias("id"), "page_id", (F.col("page_id") % 90).cast("string").alias("number"), "url", "html")
    blob = viewer.search_blob("id", "number", "url")
    return p.select("page_id", T.html_escape(F.col("html")).alias("escaped"), T.slug(F.col("url")).alias("anchor"), blob.alias("blob"), F.contains(blob, F.lower(T.strip(F.lit(" Example.ORG ")))).alias("hit"))


@query("SELECT regexp_replace(file_name, '[.][^.]*$', '') || '_' || ['L', 'R'][page % 2 + 1] AS page_id FROM scan", "scan")
def page_ids(spark: SparkSession, d: str) -> DataFrame:
    """I22."""
    return X.scan_names(spark, d).select(T.page_id(T.stem_of(F.col("file_name")), F.when(F.col("page") % 2 == 0, "L").otherwise("R")).alias("page_id"))


@query("SELECT stem, ext, 1240 AS width, 1754 AS height FROM best", "im")
def images_chosen(spark: SparkSession, d: str) -> DataFrame:
    """F4, A7."""
    return viewer.best_images(X.image_files(spark, d))


@query("SELECT stem, ord, region_id, region_type, x, y, width, height FROM dr", "bx")
def region_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Boxes to draw out of region files, some of them malformed."""
    return viewer.region_boxes(X.region_json(spark, d))


_LABEL = f"""lb AS (SELECT dr.*, 1240 AS img_w, 1754 AS img_h, coalesce(colour, '#444444') AS colour, 17 AS font, {ESCAPE.format("region_id")} || '·' || {ESCAPE.format("dr.region_type")} AS label FROM dr JOIN best USING (stem) LEFT JOIN co ON co.region_type = dr.region_type),
    lp AS (SELECT *, 8 AS pad_x, 5 AS pad_y, trunc(length(label) * font * 0.55::DOUBLE)::INT + 16 AS label_w, 27 AS label_h, x AS label_x, CASE WHEN greatest(0, y - 29) < 2 THEN y + 2 ELSE y - 29 END AS label_y FROM lb)"""
CTE["lb"] = _LABEL


def _drawn(spark: SparkSession, d: str) -> DataFrame:
    found = viewer.best_images(X.image_files(spark, d)).select("stem", F.col("width").alias("img_w"), F.col("height").alias("img_h"))
    return viewer.region_boxes(X.region_json(spark, d)).join(found, "stem")


@query("SELECT stem, ord, colour, label, font, label_x, label_y, label_w, label_h FROM lp", "im", "bx", "col", "lb")
def box_labels(spark: SparkSession, d: str) -> DataFrame:
    """J2, J3."""
    return viewer.labels(_drawn(spark, d)).select("stem", "ord", "colour", "label", "font", "label_x", "label_y", "label_w", "label_h")


_SVG = f"""sv AS (SELECT stem, count(*) AS n_boxes, '<svg class="region-overlay" viewBox="0 0 1240 1754" preserveAspectRatio="xMidYMid meet" xmlns="http://www.w3.org/2000/svg" aria-hidden="true">'
    || string_agg('<rect class="rg-halo" ' || place || '/><rect class="rg-box rg-' || {ESCAPE.format("region_type")} || '" ' || place || ' stroke="' || colour || '"/>', '' ORDER BY ord)
    || string_agg('<rect class="rg-label-bg" x="' || label_x || '" y="' || label_y || '" width="' || label_w || '" height="' || label_h || '" fill="' || colour || '" /><text class="rg-label" x="' || (label_x + pad_x) || '" y="' || (label_y + label_h - pad_y - 1) || '" font-size="' || font || '" fill="#fff">' || label || '</text>', '' ORDER BY ord) || '</svg>' AS svg
    FROM (SELECT *, 'x="' || x || '" y="' || y || '" width="' || width || '" height="' || height || '"' AS place FROM lp) GROUP BY stem)"""
CTE["sv"] = _SVG


@query("SELECT stem, svg, n_boxes::BIGINT AS n_boxes FROM sv", "im", "bx", "col", "lb", "sv")
def overlays(spark: SparkSession, d: str) -> DataFrame:
    """J4."""
    return viewer.overlays(_drawn(spark, d))


@query("SELECT region_type, coalesce(colour, '#444444') AS colour, coalesce(rank, 999)::INT AS rank, n::BIGINT AS n, seen.stem AS stem, seen.ord AS ord, (row_number() OVER (ORDER BY coalesce(rank, 999), seen))::INT AS place FROM (SELECT region_type, count(*) AS n, min({'stem': stem, 'ord': ord}) AS seen FROM dr GROUP BY ALL) LEFT JOIN co USING (region_type)", "bx", "col")
def legend(spark: SparkSession, d: str) -> DataFrame:
    """The types in legend order; unknown ones last, by where they are first seen."""
    b = viewer.region_boxes(X.region_json(spark, d))
    found = viewer.legend(b).join(b.groupBy("region_type").agg(F.count("*").alias("n")), "region_type")
    place = F.row_number().over(Window.orderBy("rank", "stem", "ord"))  # a row for each type
    return found.select("region_type", "colour", "rank", "n", "stem", "ord", place.cast("int").alias("place"))


CTE["vp"] = """vp AS (SELECT rs.page_id::VARCHAR AS stem, coalesce(page_number, '') AS page_number, regions_summary, CASE WHEN ext IS NOT NULL THEN stem || ext END AS image, coalesce(svg, '') AS overlay_svg, coalesce(n_boxes, 0)::INT AS overlay_region_count
    FROM rs LEFT JOIN pn USING (page_id) LEFT JOIN best ON best.stem = rs.page_id::VARCHAR LEFT JOIN (SELECT stem AS s, svg, n_boxes FROM sv) ON s = rs.page_id::VARCHAR)"""
_VIEW = ("tr", "block", "md", "im", "bx", "col", "lb", "sv", "vp")


def _viewer(spark: SparkSession, d: str) -> DataFrame:
    docs = markdown.region_documents(X.transcribed(spark, d)).select(F.col("page_id").cast("string").alias("stem"), "md")
    return viewer.viewer_pages(docs, X.image_files(spark, d), X.region_json(spark, d))


@query("SELECT stem AS page_id, page_number, regions_summary, image, overlay_svg, overlay_region_count FROM vp", *_VIEW)
def viewer_pages(spark: SparkSession, d: str) -> DataFrame:
    """K1, G1, G2, K4, K8."""
    return _viewer(spark, d).select("page_id", "page_number", "regions_summary", "image", "overlay_svg", "overlay_region_count")


@query("SELECT count(*)::BIGINT AS n_pages, count(image)::BIGINT AS n_scans, count_if(overlay_svg <> '')::BIGINT AS n_overlays, coalesce(sum(overlay_region_count), 0)::BIGINT AS n_boxes FROM vp", *_VIEW)
def viewer_stats(spark: SparkSession, d: str) -> DataFrame:
    """H5."""
    return viewer.stats(_viewer(spark, d))


@query("SELECT page_id, id, type = 'PageNumberRegion' AS skipped, CASE WHEN type = 'PageNumberRegion' THEN page_number END AS text FROM tr", "tr")
def regions_routed(spark: SparkSession, d: str) -> DataFrame:
    """Page numbers bypass the model."""
    known, ask = model.route_regions(X.transcribed(spark, d).drop("status", "text"))
    return known.select("page_id", "id", "skipped", "text").unionByName(ask.select("page_id", "id", F.lit(False).alias("skipped"), F.lit(None).cast("string").alias("text")))


@query(
    """SELECT page_id, id, CASE type WHEN 'TableRegion' THEN 'table' WHEN 'GraphRegion' THEN 'graph' WHEN 'TitleRegion' THEN 'title' ELSE 'text' END AS kind, coalesce(header_rows, 1)::VARCHAR AS p_header_rows,
    coalesce(CASE WHEN rows IS NOT NULL THEN greatest(0, rows - coalesce(header_rows, 1)) END::VARCHAR, '?') AS p_data_rows, coalesce(cols::VARCHAR, '?') AS p_cols, CASE WHEN has_red_ink THEN 'yes' ELSE 'no' END AS p_red, CASE WHEN has_totals_row THEN 'yes' ELSE 'no' END AS p_totals,
    CASE coalesce(script, 'kurrent') WHEN 'latin' THEN 'Latin cursive' WHEN 'mixed' THEN 'mixed Kurrent and Latin cursive' ELSE 'German Kurrent (Kurrentschrift)' END AS p_script FROM tr""",
    "tr",
)
def prompt_parameters(spark: SparkSession, d: str) -> DataFrame:
    """E9, G4."""
    return model.prompt_parameters(X.transcribed(spark, d)).select("page_id", "id", "kind", "p_header_rows", "p_data_rows", "p_cols", "p_red", "p_totals", "p_script")


@query(
    """SELECT event_id, CASE WHEN level IN ('low', 'medium', 'high', 'ultra_high') THEN 'media_resolution_' || level WHEN level IN ('media_resolution_low', 'media_resolution_high') THEN level END AS resolution,
    ['table', 'graph', 'map'][event_id % 3 + 1] AS mode, ['high', 'ultra_high', 'high'][event_id % 3 + 1] AS page_resolution FROM (SELECT event_id, ['low', 'medium', 'high', 'ultra_high', 'media_resolution_low', 'media_resolution_high', '', 'huge'][event_id % 8 + 1] AS level FROM events)"""
)
def resolutions(spark: SparkSession, d: str) -> DataFrame:
    """E6, E8."""
    names = F.array(*[F.lit(x) for x in ("low", "medium", "high", "ultra_high", "media_resolution_low", "media_resolution_high", "", "huge")])
    mode = F.element_at(F.array(*[F.lit(x) for x in model.FULL_PAGE]), (F.col("event_id") % 3 + 1).cast("int"))
    return X.table(spark, d, "events").select("event_id", T.resolution_of(F.element_at(names, (F.col("event_id") % 8 + 1).cast("int"))).alias("resolution"), mode.alias("mode"), T.lookup(model.FULL_PAGE, mode).alias("page_resolution"))


CTE["fold"] = """fo AS (SELECT call_id, max(CASE WHEN attempt = 1 THEN outcome END) AS a, max(CASE WHEN attempt = 2 THEN outcome END) AS b, max(CASE WHEN attempt = 3 THEN outcome END) AS c, max(CASE WHEN attempt = 4 THEN outcome END) AS e FROM tries GROUP BY call_id),
    tf AS (SELECT call_id, a, CASE WHEN a <> 'success' THEN b END AS b, CASE WHEN a <> 'success' AND b <> 'success' THEN c END AS c FROM fo),
    df AS (SELECT call_id, a, CASE WHEN a = 'empty' THEN b END AS b, CASE WHEN a = 'empty' AND b = 'empty' THEN c END AS c, CASE WHEN a = 'empty' AND b = 'empty' AND c = 'empty' THEN e END AS e FROM fo)"""


@query(
    """SELECT call_id, CASE WHEN 'success' IN (a, coalesce(b, ''), coalesce(c, '')) THEN 'success' WHEN c IS NOT NULL THEN 'error' ELSE 'open' END AS status, ['high', 'medium', 'low'][1 + (a = 'empty')::INT + coalesce(b = 'empty', false)::INT] AS level,
    CASE WHEN b = 'empty' THEN 'ultra_high' ELSE 'high' END AS resolution, (1 + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT)::INT AS tries, CASE WHEN a = 'exception' THEN 1.5::DOUBLE ELSE 0 END + CASE WHEN b = 'exception' THEN 3.0::DOUBLE ELSE 0 END AS pause FROM tf""",
    "tries",
    "fold",
)
def transcription_replay(spark: SparkSession, d: str) -> DataFrame:
    """Retries of the transcription stage."""
    return model.replay(X.attempts(spark, d), "transcribe")


@query(
    """SELECT call_id, CASE WHEN 'success' IN (a, coalesce(b, ''), coalesce(c, ''), coalesce(e, '')) THEN 'success' WHEN e IS NOT NULL OR 'exception' IN (a, coalesce(b, ''), coalesce(c, '')) THEN 'error' ELSE 'open' END AS status,
    ['high', 'medium', 'low', 'low'][1 + (a = 'empty')::INT + coalesce(b = 'empty', false)::INT + coalesce(c = 'empty', false)::INT] AS level,
    'high' AS resolution, (1 + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT + (e IS NOT NULL)::INT)::INT AS tries, 0::DOUBLE AS pause FROM df""",
    "tries",
    "fold",
)
def detection_replay(spark: SparkSession, d: str) -> DataFrame:
    """Retries of the detection stage."""
    return model.replay(X.attempts(spark, d), "detect", retries=3)


@query("SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN text WHEN turn % 3 = 1 THEN text || role ELSE '' END AS answer, CASE WHEN length(text) > 800 THEN left(text, 800) || '…[truncated]' ELSE text END AS dump FROM conversations")
def answer_texts(spark: SparkSession, d: str) -> DataFrame:
    """An answer's text, or its first candidate's."""
    c = X.table(spark, d, "conversations")
    own = F.when(F.col("turn") % 3 == 0, F.col("text")).when(F.col("turn") % 3 == 1, F.lit(None)).otherwise("")
    parts = F.when(F.col("turn") % 3 == 1, F.array(F.array(F.lit("")), F.array("text", "role"))).otherwise(F.array(F.array(F.lit(""))))
    return c.select("conv_id", "turn", model.answer_text(own, parts).alias("answer"), model.dumped(F.col("text")).alias("dump"))


@query("SELECT page_id, n, n_errors, CASE WHEN page_id IN (SELECT conv_id FROM aw WHERE conv_id % 4 = 3) THEN 'error' ELSE 'success' END AS page_status FROM (SELECT page_id, count(*)::BIGINT AS n, count_if(status = 'error')::BIGINT AS n_errors FROM tr GROUP BY page_id)", "tr", "an")
def page_status(spark: SparkSession, d: str) -> DataFrame:
    """A region's error leaves its page a success, an answer that does not parse does not."""
    regions = X.transcribed(spark, d)
    failed = detection.page_errors(detection.parse_answers(X.answers(spark, d)), ["conv_id"]).withColumnRenamed("conv_id", "page_id")
    return detection.page_status(regions.select("page_id").distinct(), failed, regions)


@query(
    """SELECT conv_id, turn, turn::INT AS rows, NULL::INT AS cols, CASE WHEN turn % 2 = 0 THEN true END AS has_red_ink, CASE WHEN conv_id % 3 = 0 THEN 'latin' END AS script,
    'rows,cols,has_red_ink' || CASE WHEN conv_id % 3 = 0 THEN ',script' ELSE '' END AS present,
    concat_ws(',', CASE WHEN conv_id % 1500 > 1000 THEN 'bbox.x is not from 0 to 1000' END, 'cols is no bigint', CASE WHEN turn % 2 <> 0 THEN 'has_red_ink is no boolean' END) AS violations FROM conversations WHERE role = 'assistant'"""
)
def region_metadata(spark: SparkSession, d: str) -> DataFrame:
    """The keys that a region has, null or not, and what the declared schema does not allow."""
    keys = ["conv_id", "turn"]
    regions = detection.unnest_regions(detection.parse_answers(X.described(spark, d)), keys)
    broken = F.array_join(detection.violations(F.col("region")), ",").alias("violations")
    raw = detection.fields(regions, keys).join(regions.select(*keys, broken), keys)
    return raw.select(*keys, "rows", "cols", "has_red_ink", "script", F.array_join("present", ",").alias("present"), "violations")


@query("SELECT 'mixed' AS doc_type, count_if(conv_id % 4 <> 3)::BIGINT AS pages_processed, count_if(conv_id % 4 = 3)::BIGINT AS n_errors FROM aw", "an")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    """H2: what a run reports."""
    a = detection.parse_answers(X.answers(spark, d))
    return a.agg(F.lit("mixed").alias("doc_type"), F.count("data").alias("pages_processed"), F.count_if(F.col("data").isNull()).alias("n_errors"))


@query("SELECT conv_id * 1000 + turn AS page, 'JSON parse' AS error FROM aw WHERE conv_id % 4 = 3", "an")
def run_errors(spark: SparkSession, d: str) -> DataFrame:
    """H3: the run's errors, a row for each."""
    a = detection.parse_answers(X.answers(spark, d)).withColumn("page", F.col("conv_id") * 1000 + F.col("turn"))
    return detection.page_errors(a, ["page"])


@query("SELECT det.page_id, printf('r%02d', det.reading_order) AS id, o_orderstatus AS page_state, x, width FROM det JOIN orders ON o_orderkey = page_id", "raw", "px")
def regions_with_pages(spark: SparkSession, d: str) -> DataFrame:
    """Regions joined with what their page carries."""
    pages = X.table(spark, d, "orders").select(F.col("o_orderkey").alias("page_id"), F.col("o_orderstatus").alias("page_state"))
    return detection.detect(_raw(spark, d)).join(pages, "page_id").select("page_id", "id", "page_state", "bbox.x", "bbox.width")


@query(
    """SELECT a.page_id, printf('r%02d', a.reading_order) AS a, printf('r%02d', b.reading_order) AS b, greatest(a.x, b.x) AS x, greatest(a.y, b.y) AS y,
    least(a.x + a.width, b.x + b.width) - greatest(a.x, b.x) AS width, least(a.y + a.height, b.y + b.height) - greatest(a.y, b.y) AS height
    FROM det a JOIN det b ON a.page_id = b.page_id AND a.reading_order < b.reading_order AND a.x < b.x + b.width AND b.x < a.x + a.width AND a.y < b.y + b.height AND b.y < a.y + a.height""",
    "raw",
    "px",
)
def region_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """The regions of a page that overlap, which the prompt forbids."""
    return joins.overlaps(detection.detect(_raw(spark, d)).select("page_id", "id", "bbox.*"))


@query(
    """SELECT e.event_id, e.user_id, s.setting_id, s.strength FROM events e ASOF LEFT JOIN
    (SELECT user_id, ts, max(event_id) AS setting_id, arg_max(value, event_id) AS strength FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts) s ON e.user_id = s.user_id AND e.ts >= s.ts"""
)
def settings_in_force(spark: SparkSession, d: str) -> DataFrame:
    """The setting that was in force at each event; users of over a thousand events are cut in pieces."""
    e = X.table(spark, d, "events")
    settings = e.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("setting_id"), F.col("value").alias("strength"))
    return joins.as_of(e.select("event_id", "user_id", "ts"), settings, "user_id", "ts", ["setting_id", "strength"], hot=1000).select("event_id", "user_id", "setting_id", "strength")


@query(
    """SELECT type, status, (2 * grouping(type) + grouping(status))::BIGINT AS "grouping", count(*)::BIGINT AS n, count(DISTINCT page_id)::BIGINT AS n_pages, count(DISTINCT id)::BIGINT AS n_ids, sum(length(text))::BIGINT AS n_chars
    FROM tr GROUP BY GROUPING SETS ((type, status), (type), (status), ())""",
    "tr",
)
def run_report(spark: SparkSession, d: str) -> DataFrame:
    """H2, H5, H6, H7: a run's numbers by type and status, by each, and in all, in one pass."""
    numbers = {"n": F.count("*"), "n_pages": F.count_distinct("page_id"), "n_ids": F.count_distinct("id"), "n_chars": F.sum(F.length("text"))}
    return reports.by_sets(X.transcribed(spark, d), [["type", "status"], ["type"], ["status"], []], numbers)


@query("SELECT event_type, count(*)::BIGINT AS n, count(DISTINCT user_id)::BIGINT AS n_users, true AS users_near, true AS quantiles_near FROM events GROUP BY event_type")
def sketch_bounds(spark: SparkSession, d: str) -> DataFrame:
    """H2, H7: sketches of days, merged; distinct users within 5 %, ranks of the quantiles within 3 %, of the exact ones."""
    e = X.table(spark, d, "events").withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    days = reports.sketched(e.withColumn("day", F.to_date("ts")), ["event_type", "day"], "user_id", "cents")
    shares = (0.5, 0.9, 0.99)
    found = reports.estimated(reports.merged(days, ["event_type"]), shares)
    exact = e.groupBy("event_type").agg(F.count_distinct("user_id").alias("n_users"))
    # A quantile is near if its exact share of the rows, those equal to it either way, comes near the share asked for.
    each = e.join(F.broadcast(found.select("event_type", "q50", "q90", "q99")), "event_type").groupBy("event_type")
    share = lambda which: F.avg(which.cast("double"))
    ranks = each.agg(*[x for q in ("q50", "q90", "q99") for x in (share(F.col("cents") < F.col(q)).alias(f"low_{q}"), share(F.col("cents") <= F.col(q)).alias(f"high_{q}"))])
    near = [(F.col(f"low_q{round(100 * s)}") <= s + 0.03) & (F.col(f"high_q{round(100 * s)}") >= s - 0.03) for s in shares]
    out = found.join(exact, "event_type").join(ranks, "event_type")
    return out.select("event_type", "n", "n_users", (F.abs(F.col("n_distinct") - F.col("n_users")) <= F.greatest(F.lit(1.0), 0.05 * F.col("n_users"))).alias("users_near"), (near[0] & near[1] & near[2]).alias("quantiles_near"))


def _numbers() -> dict:
    return {"n": F.count("*"), "cents": F.sum(F.round(F.col("value") * 100).cast("long"))}


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*)::BIGINT AS n, sum(round(value * 100)::BIGINT)::BIGINT AS cents FROM events GROUP BY ALL")
def events_tumbling(spark: SparkSession, d: str) -> DataFrame:
    """Calls by the hour and kind."""
    return windows.tumbling(X.table(spark, d, "events"), "1 hour", ["event_type"], _numbers())


@query(
    """SELECT w AS window_start, w + INTERVAL 6 HOUR AS window_end, event_type, count(*)::BIGINT AS n, sum(round(value * 100)::BIGINT)::BIGINT AS cents
    FROM (SELECT *, time_bucket(INTERVAL 2 HOUR, ts) - i * INTERVAL 2 HOUR AS w FROM events, (SELECT unnest(range(3)) AS i)) WHERE ts < w + INTERVAL 6 HOUR GROUP BY ALL"""
)
def events_sliding(spark: SparkSession, d: str) -> DataFrame:
    """Calls of six hours, every two hours."""
    return windows.sliding(X.table(spark, d, "events"), "6 hours", "2 hours", ["event_type"], _numbers())


@query(
    """SELECT min(ts) AS window_start, max(ts) + INTERVAL 8 HOUR AS window_end, user_id, count(*)::BIGINT AS n, sum(round(value * 100)::BIGINT)::BIGINT AS cents
    FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 8 HOUR THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, session"""
)
def events_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Users' sessions: events less than eight hours apart."""
    return windows.sessions(X.table(spark, d, "events"), "8 hours", ["user_id"], _numbers())


@query(
    f"""SELECT page_id, pos::INT AS pos, type, x1::INT AS px, y1::INT AS py, least(w0 + 6, img_w - x1)::INT AS pw, least(h0 + 10, img_h - y1)::INT AS ph FROM pw""",
    "raw",
    "px",
)
def regions_in_sql(spark: SparkSession, d: str) -> DataFrame:
    """D8-D10 as a query in SQL text, with the functions of the catalog."""
    catalog.register(spark)
    X.raw_regions(spark, d).createOrReplaceTempView("pagelake_raw_regions")
    return spark.sql("""SELECT page_id, CAST(pos AS INT) AS pos, page_region_type(type) AS type, b.px, b.py, b.pw, b.ph
        FROM pagelake_raw_regions AS r, LATERAL page_pixel_box(r.nx, r.ny, r.nw, r.nh, r.img_w, r.img_h) AS b WHERE pos < 12""")
