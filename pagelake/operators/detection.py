"""Regions from model answers: unnest, cap, normalise, scale, order and number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelake.functions import regions as R
from pagelake.functions.text import clean_json


def parse_answers(answers: DataFrame, column: str = "response") -> DataFrame:
    """answers with json (the object found in the text) and data (variant; null where it does not parse)."""
    return answers.withColumn("json", clean_json(F.col(column))).withColumn("data", F.try_parse_json("json"))


def lenient(answers: DataFrame, column: str = "response") -> DataFrame:
    """The same with an empty object for what does not parse."""
    return answers.withColumn("data", F.coalesce(F.try_parse_json(clean_json(F.col(column))), F.parse_json(F.lit("{}"))))


def unnest_regions(parsed: DataFrame, keys: list[str], data: str = "data") -> DataFrame:
    """A row per entry of $.regions with its position. A missing list has none; a null one fails its page (see page_errors)."""
    return parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.variant_get(F.col(data).outer(), "$.regions", "variant"))).select(*keys, "pos", F.col("value").alias("region"))


def page_errors(parsed: DataFrame, keys: list[str], data: str = "data") -> DataFrame:
    """Pages whose answer has no usable list of regions, with the reason."""
    regions = F.variant_get(data, "$.regions", "variant")
    reason = F.when(F.col(data).isNull(), "JSON parse").when(R.has_key(F.col(data), "regions") & ~F.schema_of_variant(regions).startswith("ARRAY"), "regions is no list")
    return parsed.select(*keys, reason.alias("error")).where("error is not null")


def fields(unnested: DataFrame, keys: list[str]) -> DataFrame:
    """The columns that detection works on, from each region's variant; `present` lists the metadata keys it has."""
    get = lambda k, kind: F.try_variant_get("region", f"$.{k}", kind)
    kinds = {"rows": "int", "cols": "int", "header_rows": "int", "line_count": "int", "has_red_ink": "boolean", "has_totals_row": "boolean", "has_fitted_curve": "boolean"}
    present = F.filter(F.array(*[F.when(R.has_key(F.col("region"), k), F.lit(k)) for k in R.METADATA]), lambda k: k.isNotNull())
    order = F.when(R.has_key(F.col("region"), "reading_order"), get("reading_order", "int")).otherwise(F.col("pos") + 1)
    bad = R.has_key(F.col("region"), "reading_order") & get("reading_order", "int").isNull()
    return unnested.select(*keys, "pos", get("type", "string").alias("type"), F.variant_get("region", "$.bbox", "variant").alias("bbox"), order.alias("reading_order"), *[get(k, kinds.get(k, "string")).alias(k) for k in R.METADATA], present.alias("present"), bad.alias("fails"))


#: What the answer's schema asks of the keys besides the box, by their kind in a variant.
KINDS = {"title_text": "STRING", "rows": "BIGINT", "cols": "BIGINT", "header_rows": "BIGINT", "has_red_ink": "BOOLEAN", "has_totals_row": "BOOLEAN", "graph_type": "STRING", "has_fitted_curve": "BOOLEAN", "line_count": "BIGINT", "script": "STRING", "reading_order": "BIGINT", "id": "STRING"}


def violations(region: Column) -> Column:
    """What in a region's variant the declared schema does not allow, as short texts in a fixed order; empty if all is well.

    Required: type (one of the taxonomy), bbox (an object of x, y, width and height alone, integers from 0 or 1 to 1000)
    and reading_order. Detection itself is more lenient; this is for reports and a strict mode.
    """
    kind = lambda path: F.schema_of_variant(F.variant_get(region, f"$.{path}", "variant"))
    missing = [F.when(~R.has_key(region, k), F.lit(f"{k} is missing")) for k in ("type", "bbox", "reading_order")]
    name = F.try_variant_get(region, "$.type", "string")
    found = [*missing, F.when(R.has_key(region, "type") & ~F.coalesce(name.isin(R.REGION_TYPES), F.lit(False)), "type is unknown")]
    box = F.variant_get(region, "$.bbox", "variant")
    is_object = kind("bbox").startswith("OBJECT")
    found.append(F.when(R.has_key(region, "bbox") & ~is_object, "bbox is no object"))
    for key, least in (("x", 0), ("y", 0), ("width", 1), ("height", 1)):
        number = F.when(kind(f"bbox.{key}") == "BIGINT", F.try_variant_get(region, f"$.bbox.{key}", "bigint"))
        found.append(F.when(is_object & ~F.coalesce(number.between(least, 1000), F.lit(False)), F.lit(f"bbox.{key} is not from {least} to 1000")))
    more = F.size(F.array_except(F.map_keys(F.try_variant_get(box, "$", "map<string,variant>")), F.array(*[F.lit(k) for k in ("x", "y", "width", "height")]))) > 0
    found.append(F.when(is_object & more, "bbox has other keys"))
    found += [F.when(R.has_key(region, k) & (kind(k) != v), F.lit(f"{k} is no {v.lower()}")) for k, v in KINDS.items()]
    found.append(F.when(R.has_key(region, "page_number") & ~kind("page_number").isin("STRING", "BIGINT"), "page_number is no string or bigint"))
    return F.array_compact(F.array(*found))


def capped(raw: DataFrame, most: int = R.MAX_REGIONS) -> DataFrame:
    """The first regions of each page by position, before anything is dropped."""
    return raw.where(F.col("pos") < most)


def located(raw: DataFrame, box: str = "box", margin: float = R.MARGIN) -> DataFrame:
    """Regions with a usable box in pixels of their page (img_w, img_h), without the others."""
    b = F.col(box)
    pixels = R.pixel_box(b["x"], b["y"], b["width"], b["height"], F.col("img_w"), F.col("img_h"), margin)
    return raw.where(b.isNotNull()).withColumn("bbox", pixels).drop(*({box} - {"bbox"}))


def ordered(regions: DataFrame, page: str = "page_id") -> DataFrame:
    """Regions numbered 1..n by reading order, ties by position, with ids r01, r02, ..."""
    place = F.row_number().over(Window.partitionBy(page).orderBy("reading_order", "pos"))
    return regions.withColumn("reading_order", place).withColumn("id", F.format_string("r%02d", "reading_order"))


def detect(raw: DataFrame, most: int = R.MAX_REGIONS, page: str = "page_id", margin: float = R.MARGIN) -> DataFrame:
    """raw(page, pos, type, box, reading_order, img_w, img_h, ...) as validated regions."""
    return ordered(located(capped(raw, most).withColumn("type", R.normal_type(F.col("type"))), margin=margin), page)


def box_counts(raw: DataFrame, page: str = "page_id", most: int = R.MAX_REGIONS) -> DataFrame:
    """Per page: regions within the cap, boxes dropped, and usable boxes that lack a canonical size."""
    usable = R.normal_box(F.col("bbox")).isNotNull()
    return capped(raw, most).groupBy(page).agg(F.count("*").alias("n_regions"), F.count_if(~usable).alias("n_dropped"), F.count_if(usable & R.recovered(F.col("bbox"))).alias("n_recovered"))


def summary(regions: DataFrame, page: str = "page_id") -> DataFrame:
    """Per page: how many regions, their ids in order, the types found in alphabetical order."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct("reading_order", "id"))), lambda x: x["id"])
    return regions.groupBy(page).agg(F.count("*").alias("total_regions"), ids.alias("reading_order"), F.array_sort(F.collect_set("type")).alias("region_types_detected"))


def error_record(pages: DataFrame, page: str = "page_id") -> DataFrame:
    """Failed pages(page, error, detail) as detection records; the detail is cut to 500 characters."""
    return pages.select(page, F.lit("error").alias("status"), "error", F.left(F.coalesce("detail", F.lit("")), F.lit(500)).alias("detail"), F.lit(0).alias("total_regions"))


def page_status(pages: DataFrame, failed: DataFrame, regions: DataFrame, page: str = "page_id") -> DataFrame:
    """(page, n, n_errors, page_status) of every page: error if its detection failed; errors of regions leave it a success."""
    counts = regions.groupBy(page).agg(F.count("*").alias("n"), F.count_if(F.col("status") == "error").alias("n_errors"))
    bad = failed.select(page).distinct().withColumn("bad", F.lit(True))
    found = pages.select(page).join(counts, page, "left").join(bad, page, "left")
    return found.select(page, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("n_errors", F.lit(0)).alias("n_errors"), F.when(F.col("bad"), "error").otherwise("success").alias("page_status"))
