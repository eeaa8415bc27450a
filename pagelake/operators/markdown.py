"""Markdown and JSON documents from transcribed regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.functions import text as T


def block(type_: str = "type", text: str = "text") -> Column:
    """The Markdown of one region; null where it has none (no text, or a page number)."""
    t, kind = T.strip(F.col(text)), F.col(type_)
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("?"))
    red = F.when(F.coalesce(F.col("has_red_ink"), F.lit(False)), "yes").otherwise("no")
    table = F.concat(F.lit("<!-- TableRegion: "), shown("rows"), F.lit(" rows × "), shown("cols"), F.lit(" cols, "), shown("header_rows"), F.lit(" header row(s), red ink: "), red, F.lit(" -->\n"), T.fence_table(t))
    graph = F.concat(F.lit("<!-- GraphRegion: "), F.coalesce("graph_type", F.lit("unknown")), F.lit(" -->\n"), t)
    each = T.lines(t)
    margin = F.concat(F.lit("> *[Marginalie]*\n"), F.array_join(F.transform(each, lambda x: F.concat(F.lit("> "), x)), "\n"))
    note = F.array_join(F.concat(F.array(F.concat(F.lit("[^fn]: "), F.get(each, 0))), F.transform(F.slice(each, F.lit(2), F.greatest(F.size(each) - 1, F.lit(0))), lambda x: F.concat(F.lit("    "), x))), "\n")
    return (
        F.when((t == "") | t.isNull() | (kind == "PageNumberRegion"), None)
        .when(kind == "TitleRegion", F.concat(F.lit("## "), t))
        .when(kind == "TableRegion", table)
        .when(kind == "GraphRegion", graph)
        .when(kind == "MarginaliaRegion", margin)
        .when(kind == "FootnoteRegion", note)
        .otherwise(t)
    )


def type_counts(regions: DataFrame, page: str = "page_id") -> DataFrame:
    """Per page, how many regions of each type, and where the type first appears."""
    return regions.groupBy(page, "type").agg(F.count("*").alias("n"), F.min("reading_order").alias("first"))


def region_summary(regions: DataFrame, page: str = "page_id") -> DataFrame:
    """Per page: type×n, types in order of first appearance."""
    each = F.transform(F.array_sort(F.collect_list(F.struct("first", F.concat("type", F.lit("×"), F.col("n").cast("string")).alias("part")))), lambda x: x["part"])
    return type_counts(regions, page).groupBy(page).agg(F.array_join(each, ", ").alias("regions_summary"))


def page_numbers(regions: DataFrame, page: str = "page_id") -> DataFrame:
    """Per page, the first page number that is not empty: as detected, else as transcribed."""
    number = F.coalesce(F.nullif(F.nullif(F.col("page_number"), F.lit("")), F.lit("0")), F.nullif(F.col("text"), F.lit("")))
    return regions.where("type = 'PageNumberRegion'").withColumn("own", number).where("own is not null").groupBy(page).agg(F.min_by("own", "reading_order").alias("page_number"))


def region_documents(regions: DataFrame, page: str = "page_id") -> DataFrame:
    """(page, md): front matter, then the regions' blocks in reading order."""
    with_block = regions.withColumn("block", block())
    number = F.coalesce(F.nullif(F.nullif(F.col("page_number"), F.lit("")), F.lit("0")), F.nullif(F.col("text"), F.lit("")))
    own = F.when((F.col("type") == "PageNumberRegion") & number.isNotNull(), F.col("reading_order"))
    body = F.transform(F.filter(F.array_sort(F.collect_list(F.struct("reading_order", "pos", "block"))), lambda x: x["block"].isNotNull()), lambda x: F.concat(x["block"], F.lit("\n")))
    types = F.array_sort(F.collect_list(F.struct("reading_order", "type")))
    docs = with_block.groupBy(page).agg(F.min_by(number, own).alias("page_number"), types.alias("types"), body.alias("body"))
    names = F.transform("types", lambda x: x["type"])
    summary = F.array_join(F.transform(F.array_distinct(names), lambda t: F.concat(t, F.lit("×"), F.size(F.filter(names, lambda x: x == t)).cast("string"))), ", ")
    number_line = F.when(F.col("page_number").isNotNull(), F.concat(F.lit("page_number: "), "page_number", F.lit("\n"))).otherwise("")
    front = F.concat(F.lit("---\npage_id: "), F.col(page).cast("string"), F.lit("\n"), number_line, F.lit('regions: "'), summary, F.lit('"\n---\n'))
    return docs.select(page, F.concat(front, F.when(F.size("body") > 0, F.concat(F.lit("\n"), F.array_join("body", "\n"))).otherwise("")).alias("md"))


def full_page_documents(pages: DataFrame, page: str = "page_id") -> DataFrame:
    """(page, md) of full-page transcriptions(page, doc_type, text)."""
    text = F.coalesce("text", F.lit(""))
    number = T.page_number_in(text)
    body = F.coalesce(F.nullif(T.strip(text), F.lit("")), F.lit(T.EMPTY_BODY))
    front = F.concat(F.lit("---\npage_id: "), F.col(page).cast("string"), F.lit("\ndoc_type: "), "doc_type", F.lit("\nprocessing_mode: full_page\n"), F.when(number != "", F.concat(F.lit("page_number: "), number, F.lit("\n"))).otherwise(""), F.lit("---\n"))
    return pages.select(page, F.concat(front, body, F.lit("\n")).alias("md"))


def regions_json(regions: DataFrame, fields: list[str], page: str = "page_id") -> DataFrame:
    """(page, json): the page's regions in order as one compact JSON list; null fields are left out."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct("reading_order", F.struct(*fields).alias("r")))), lambda x: x["r"])
    return regions.groupBy(page).agg(F.to_json(rows).alias("json"))


def full_page_json(pages: DataFrame, page: str = "page_id") -> DataFrame:
    """(page, json): the single record of a full-page transcription."""
    row = F.struct(F.lit("r01").alias("id"), F.lit("FullPage").alias("type"), "doc_type", F.struct("status", "text").alias("transcription"))
    return pages.select(page, F.to_json(F.array(row)).alias("json"))
