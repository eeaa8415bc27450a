"""Pipeline rows derived from the supplied tables, so that every transform can run over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagelake.functions.regions import REGION_TYPES

IMG_W, IMG_H = 1240, 1754


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(names: list[str], at) -> F.Column:
    return F.element_at(F.array(*[F.lit(x) for x in names]), (at + 1).cast("int"))


def raw_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as raw regions on a 0-1000 grid: page_id, pos, type, reading_order, nx, ny, nw, nh, img_w, img_h, k."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page_id"), F.col("l_linenumber").alias("reading_order"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    by = Window.partitionBy("page_id").orderBy("reading_order", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return li.select(
        "page_id",
        (F.row_number().over(by) - 1).alias("pos"),
        _pick(REGION_TYPES, F.col("l_partkey") % 7).alias("type"),
        "reading_order",
        (F.col("l_partkey") % 1001).cast("double").alias("nx"),
        (F.col("l_suppkey") * 7 % 1001).cast("double").alias("ny"),
        (F.col("l_partkey") * 3 % 1000 + 1).cast("double").alias("nw"),
        (F.col("l_quantity").cast("long") * 13 % 1000 + 1).cast("double").alias("nh"),
        F.lit(IMG_W).alias("img_w"),
        F.lit(IMG_H).alias("img_h"),
        F.col("l_partkey").alias("k"),
    )


def styled_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same boxes as JSON in six styles, canonical to broken, as variant column bbox."""
    r = raw_regions(spark, sf_dir)
    n = lambda c: F.col(c).cast("long").cast("string")
    x, y, w, h = n("nx"), n("ny"), n("nw"), n("nh")
    right, bottom = (F.col("nx") + F.col("nw")).cast("long").cast("string"), (F.col("ny") + F.col("nh")).cast("long").cast("string")
    js = lambda *kv: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in kv])
    style = F.col("k") % 6
    text = (
        F.when(style == 0, js('{"x":', x, ',"y":', y, ',"width":', w, ',"height":', h, "}"))
        .when(style == 1, js('{"left":', x, ',"top":', y, ',"w":', w, ',"h":', h, "}"))
        .when(style == 2, js('{"x":', x, ',"y":', y, ',"x1":', right, ',"y1":', bottom, "}"))
        .when(style == 3, js('{"xmin":', x, ',"ymin":', y, ',"xmax":', right, ',"ymax":', bottom, "}"))
        .when(style == 4, js('{"x":', x, ',"y":', y, ',"x1":', right, "}"))
        .otherwise(js('{"x":"', x, '","y":"', y, '","width":"', w, '","height":"', h, '"}'))
    )
    return r.withColumn("bbox", F.parse_json(text))


def scan_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as scan files of several suffixes: page, file_name, width, height."""
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("page"))
    prefix, suffix = _pick(["scan_", "Scan-", "s"], F.col("page") % 3), _pick([".png", ".JPG", ".tif", ".webp", ".pdf", ".txt", ".jpeg", ".TIFF"], F.col("page") % 8)
    return p.select("page", F.concat(prefix, F.col("page").cast("string"), suffix).alias("file_name"), (F.col("page") * 37 % 2000 + 800).cast("int").alias("width"), (F.col("page") * 53 % 2000 + 1000).cast("int").alias("height"))


def transcribed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five documents a page as transcribed regions, whole texts; toxic ones failed."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    kind = _pick(REGION_TYPES, F.col("doc_id") % 7)
    failed = F.coalesce(F.col("toxic"), F.lit(0)) == 1
    text = F.when(failed, "").when(kind == "PageNumberRegion", (F.col("doc_id") % 90).cast("string")).otherwise(F.col("text"))
    return d.select(
        F.floor(F.col("doc_id") / 5).cast("long").alias("page_id"),
        (F.col("doc_id") % 5).cast("int").alias("pos"),
        (5 - F.col("doc_id") % 5).cast("int").alias("reading_order"),
        F.format_string("r%02d", (5 - F.col("doc_id") % 5).cast("int")).alias("id"),
        kind.alias("type"),
        F.when(failed, "error").otherwise("success").alias("status"),
        text.alias("text"),
        F.when(kind == "PageNumberRegion", (F.col("doc_id") % 90).cast("string")).alias("page_number"),
        F.when(kind == "TableRegion", (F.col("doc_id") % 40).cast("int")).alias("rows"),
        F.when((kind == "TableRegion") & (F.col("doc_id") % 3 != 0), (F.col("doc_id") % 12).cast("int")).alias("cols"),
        F.when((kind == "TableRegion") & (F.col("doc_id") % 2 == 0), F.lit(2)).alias("header_rows"),
        F.when(kind == "TableRegion", F.col("doc_id") % 4 == 0).alias("has_red_ink"),
        F.when(kind == "TableRegion", F.col("doc_id") % 5 == 0).alias("has_totals_row"),
        F.when((kind == "GraphRegion") & (F.col("doc_id") % 2 == 0), "scatter").alias("graph_type"),
        F.when(F.col("doc_id") % 3 == 0, "latin").when(F.col("doc_id") % 3 == 1, "mixed").alias("script"),
        F.when(kind == "PageNumberRegion", F.array(F.lit("page_number"))).otherwise(F.array().cast("array<string>")).alias("present"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as noisy model answers: call, response; one style in four is cut short."""
    c = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    body = F.concat(F.lit('{"regions": [{"type": "TableRegion", "bbox": {"x": '), (F.col("turn") * 10 % 500).cast("string"), F.lit(', "y": '), (F.col("conv_id") % 500).cast("string"), F.lit(', "width": 100, "height": 50}, "reading_order": '), F.col("turn").cast("string"), F.lit("}]}"))
    style = F.col("conv_id") % 4
    text = F.when(style == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(style == 1, F.concat(F.lit("Let me look. "), body, F.lit(" Done."))).when(style == 2, body).otherwise(F.left(body, F.lit(40)))
    return c.select("conv_id", "turn", text.alias("response"))


def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as model answers that describe a table region: some keys there, some null, some missing or odd."""
    c = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    turn = F.col("turn").cast("string")
    script = F.when(F.col("conv_id") % 3 == 0, ',"script":"latin"').otherwise("")
    red = F.when(F.col("turn") % 2 == 0, "true").otherwise('"perhaps"')
    body = F.concat(F.lit('{"regions":[{"type":"TableRegion","bbox":{"x":'), (F.col("conv_id") % 1500).cast("string"), F.lit(',"y":2,"width":3,"height":4},"reading_order":'), turn, F.lit(',"rows":'), turn, F.lit(',"cols":null,"has_red_ink":'), red, script, F.lit("}]}"))
    return c.select("conv_id", "turn", body.alias("response"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events, in order, as the attempts of calls, four to a call."""
    e = table(spark, sf_dir, "events")
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    kind = F.when(F.col("event_type") == "error", "exception").when(F.col("event_type").isin("view", "click"), "empty").otherwise("success")
    rows = e.select("user_id", place.alias("place"), kind.alias("outcome"))
    return rows.select((F.col("user_id") * 1_000_000 + F.floor(F.col("place") / 4)).alias("call_id"), (F.col("place") % 4 + 1).alias("attempt"), "outcome")


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two image files for each page: stem, ext, width, height."""
    p = table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 5).cast("long").alias("page_id")).distinct()
    exts = F.array(_pick([".tiff", ".jpg", ".webp"], F.col("page_id") % 3), _pick([".png", ".tif"], F.col("page_id") % 2))
    return p.select(F.col("page_id").cast("string").alias("stem"), F.explode(exts).alias("ext"), F.lit(IMG_W).alias("width"), F.lit(IMG_H).alias("height"))


def region_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's region file: boxes from the document's length, some files malformed, some boxes unusable."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.floor(F.col("doc_id") / 5).cast("long").alias("page_id"))
    kind = F.when(F.col("doc_id") % 13 == 0, "FullPage").when(F.col("doc_id") % 11 == 0, "Odd<Region>").otherwise(_pick(REGION_TYPES, F.col("doc_id") % 7))
    one = F.concat(F.lit('{"id":"r0'), (F.col("doc_id") % 5 + 1).cast("string"), F.lit('","type":"'), kind, F.lit('","bbox":{"x":'), (F.col("n_chars") % 1000).cast("string"), F.lit(',"y":'), (F.col("n_chars") * 3 % 1500).cast("string"), F.lit(',"width":'), (F.col("n_chars") % 300).cast("string"), F.lit(',"height":'), (F.col("doc_id") * 7 % 200).cast("string"), F.lit("}}"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("doc_id", one.alias("j")))), lambda x: x["j"])
    whole = F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]"))
    return d.groupBy("page_id").agg(whole.alias("json")).select(F.col("page_id").cast("string").alias("stem"), F.when(F.col("page_id") % 11 == 0, F.left("json", F.length("json") - 3)).otherwise(F.col("json")).alias("json"))
