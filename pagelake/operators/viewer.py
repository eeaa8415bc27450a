"""Viewer pages: front matter, images, overlays and the final HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.functions import text as T

# Image suffixes in order of preference.
IMAGE_SUFFIXES = [".png", ".jpg", ".jpeg", ".webp", ".tif", ".tiff"]
# Colours of the region types, in legend order.
COLOURS = {
    "TitleRegion": "#0072B2",
    "TableRegion": "#009E73",
    "GraphRegion": "#E69F00",
    "ParagraphRegion": "#56B4E9",
    "MarginaliaRegion": "#CC79A7",
    "FootnoteRegion": "#F0E442",
    "PageNumberRegion": "#D55E00",
    "FullPage": "#888888",
}
OTHER_COLOUR = "#444444"


def colour_of(type_: Column) -> Column:
    return T.lookup(COLOURS, type_, OTHER_COLOUR)


def best_images(images: DataFrame) -> DataFrame:
    """Of images(stem, ext, ...) the one per stem whose suffix comes first."""
    place = F.array_position(F.array(*[F.lit(x) for x in IMAGE_SUFFIXES]), F.col("ext"))
    own = F.struct(*[c for c in images.columns if c != "stem"])
    return images.where(place > 0).groupBy("stem").agg(F.min_by(own, place).alias("image")).select("stem", "image.*")


def region_boxes(documents: DataFrame) -> DataFrame:
    """Of documents(stem, json) the boxes to draw: stem, ord, region_id, region_type, x, y, width, height.

    What does not parse, is no list, is a full page, or lacks a box of positive size draws nothing.
    """
    entries = F.from_json("json", "array<string>")
    each = documents.select("stem", F.posexplode(entries).alias("ord", "one"))
    # Entries come as text: their members are read one by one, so a bad one spoils no other.
    parsed = each.withColumn("v", F.try_parse_json("one")).where(F.schema_of_variant("v").startswith("OBJECT"))
    get = lambda p, kind: F.try_variant_get("v", p, kind)
    parsed = parsed.select("stem", "ord", F.coalesce(get("$.id", "string"), F.lit("")).alias("region_id"), F.coalesce(get("$.type", "string"), F.lit("")).alias("region_type"), *[get(f"$.bbox.{k}", "double").cast("int").alias(k) for k in ("x", "y", "width", "height")])
    return parsed.where("region_type <> 'FullPage' and x is not null and y is not null and width > 0 and height > 0")


def labels(boxes: DataFrame) -> DataFrame:
    """boxes(..., img_w, img_h) with the label's text, colour and place."""
    font = F.greatest(F.lit(10), F.floor(F.least("img_w", "img_h") / 70).cast("int"))
    out = boxes.withColumn("colour", colour_of(F.col("region_type"))).withColumn("font", font)
    out = out.withColumn("label", F.when(F.col("region_id") != "", F.concat(T.html_escape(F.col("region_id")), F.lit("·"), T.html_escape(F.col("region_type")))).otherwise(T.html_escape(F.col("region_type"))))
    pad_x, pad_y = F.floor(F.col("font") / 2).cast("int"), F.floor(F.col("font") / 3).cast("int")
    out = out.withColumn("pad_x", pad_x).withColumn("pad_y", pad_y)
    out = out.withColumn("label_w", (F.length("label") * F.col("font") * 0.55).cast("int") + 2 * F.col("pad_x")).withColumn("label_h", F.col("font") + 2 * F.col("pad_y"))
    above = F.greatest(F.lit(0), F.col("y") - F.col("label_h") - 2)
    return out.withColumn("label_x", F.col("x")).withColumn("label_y", F.when(above < 2, F.col("y") + 2).otherwise(above))


def overlays(boxes: DataFrame) -> DataFrame:
    """(stem, svg, n_boxes): all boxes of a page, then all labels. The elements and their attributes."""
    s = lambda c: F.col(c).cast("string")
    place = F.concat(F.lit('x="'), s("x"), F.lit('" y="'), s("y"), F.lit('" width="'), s("width"), F.lit('" height="'), s("height"), F.lit('"'))
    rect = F.concat(F.lit('<rect class="rg-halo" '), place, F.lit('/><rect class="rg-box rg-'), T.html_escape(F.col("region_type")), F.lit('" '), place, F.lit(' stroke="'), "colour", F.lit('"/>'))
    label = F.concat(F.lit('<rect class="rg-label-bg" x="'), s("label_x"), F.lit('" y="'), s("label_y"), F.lit('" width="'), s("label_w"), F.lit('" height="'), s("label_h"), F.lit('" fill="'), "colour", F.lit('" /><text class="rg-label" x="'), (F.col("label_x") + F.col("pad_x")).cast("string"), F.lit('" y="'), (F.col("label_y") + F.col("label_h") - F.col("pad_y") - 1).cast("string"), F.lit('" font-size="'), s("font"), F.lit('" fill="#fff">'), "label", F.lit("</text>"))
    drawn = labels(boxes).select("stem", "ord", "img_w", "img_h", rect.alias("rect"), label.alias("text"))
    one = F.array_sort(F.collect_list(F.struct("ord", "rect", "text")))
    pages = drawn.groupBy("stem", "img_w", "img_h").agg(one.alias("parts"), F.count("*").alias("n_boxes"))
    head = F.concat(F.lit('<svg class="region-overlay" viewBox="0 0 '), s("img_w"), F.lit(" "), s("img_h"), F.lit('" preserveAspectRatio="xMidYMid meet" xmlns="http://www.w3.org/2000/svg" aria-hidden="true">'))
    svg = F.concat(head, F.array_join(F.transform("parts", lambda p: p["rect"]), ""), F.array_join(F.transform("parts", lambda p: p["text"]), ""), F.lit("</svg>"))
    return pages.select("stem", svg.alias("svg"), "n_boxes")


def legend(boxes: DataFrame) -> DataFrame:
    """The region types that are drawn, in legend order, unknown ones last as first seen."""
    rank = F.nullif(F.array_position(F.array(*[F.lit(t) for t in COLOURS]), F.col("region_type")), F.lit(0))
    return boxes.groupBy("region_type").agg(F.min(F.struct("stem", "ord")).alias("seen")).select("region_type", colour_of(F.col("region_type")).alias("colour"), F.coalesce(rank, F.lit(999)).cast("int").alias("rank"), "seen.stem", "seen.ord")


def viewer_pages(docs: DataFrame, images: DataFrame, region_json: DataFrame) -> DataFrame:
    """docs(stem, md) left-joined with their best image and, where there is one, their overlay."""
    found = best_images(images)
    meta = docs.select("stem", T.front_matter(F.col("md")).alias("meta"), T.body_of(F.col("md")).alias("body"))
    boxes = region_boxes(region_json).join(found.select("stem", F.col("width").alias("img_w"), F.col("height").alias("img_h")), "stem")
    pages = meta.join(found.select("stem", "ext"), "stem", "left").join(overlays(boxes), "stem", "left")
    value = lambda k, default: F.coalesce(F.try_element_at("meta", F.lit(k)), default)
    return pages.select("stem", value("page_id", F.col("stem")).alias("page_id"), value("page_number", F.lit("")).alias("page_number"), value("regions", F.lit("")).alias("regions_summary"), "body", F.when(F.col("ext").isNotNull(), F.concat("stem", "ext")).alias("image"), F.coalesce("svg", F.lit("")).alias("overlay_svg"), F.coalesce("n_boxes", F.lit(0)).cast("int").alias("overlay_region_count"))


def stats(pages: DataFrame) -> DataFrame:
    return pages.agg(F.count("*").alias("n_pages"), F.count("image").alias("n_scans"), F.count_if(F.col("overlay_svg") != "").alias("n_overlays"), F.coalesce(F.sum("overlay_region_count"), F.lit(0)).cast("long").alias("n_boxes"))


def search_blob(page_id: str = "page_id", number: str = "page_number", stem: str = "stem") -> Column:
    return F.lower(F.concat(F.col(page_id), F.lit(" "), F.col(number), F.lit(" "), F.col(stem)))


def search(pages: DataFrame, query: str) -> DataFrame:
    """Pages whose id, number or stem holds the query, whatever the case."""
    return pages.where(F.contains(search_blob(), F.lower(T.strip(F.lit(query)))))
