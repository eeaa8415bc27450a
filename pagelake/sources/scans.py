"""Scans, Markdown files and region files as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagelake.functions import text as T
from pagelake.functions.headers import image_size

# The suffixes of page scans.
SUFFIXES = ["jpg", "jpeg", "png", "tif", "tiff", "webp"]


def _any_case(suffix: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in suffix)


GLOB = "*.{" + ",".join(_any_case(s) for s in SUFFIXES) + "}"


def supported(name) -> F.Column:
    return F.lower(F.substring(T.suffix_of(name), 2, 10)).isin(SUFFIXES)


def in_order(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Files with a supported suffix, with stem, ext and natural (their order by stem, digits as numbers)."""
    own = files.where(supported(F.col(name))).withColumn("stem", T.stem_of(F.col(name))).withColumn("ext", T.suffix_of(F.col(name)))
    return own.withColumn("natural", T.natural_key(F.col("stem")))


def numbered(rows: DataFrame, key: F.Column, name: str = "seq", path: str | None = None) -> DataFrame:
    """rows with their place, from 1, in ascending order of key.

    A range sort puts rows in order over all tasks; a place is the count of the rows in the parts before, one number for
    each part, and the place in the part. No task sees more than its range. The rows in order are written to path, or else
    cached for as long as the session lasts.
    """
    at, part = F.col("_at"), F.shiftright("_at", 33)
    ordered = rows.withColumn("_key", key).orderBy("_key").drop("_key").withColumn("_at", F.monotonically_increasing_id())
    if path:
        ordered.write.mode("overwrite").parquet(path)
        ordered = rows.sparkSession.read.schema(ordered.schema).parquet(path)
    else:
        ordered = ordered.persist()
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    placed = ordered.withColumn("part", part).join(F.broadcast(before), "part")
    return placed.withColumn(name, (F.col("before") + at.bitwiseAND(F.lit((1 << 33) - 1)) + 1).cast("int")).drop("part", "before", "_at")


def scan_files(spark: SparkSession, folder: str) -> DataFrame:
    """The scans of a folder (not of those inside it): path, file_name, stem, ext, natural, length, content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", GLOB).load(folder)
    return in_order(files.withColumn("file_name", F.element_at(F.split("path", "/"), -1)))


def decoded(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    """The scans of a folder, or files by their paths, decoded by Spark's image source to page rows; what it can't decode has an error instead of pixels."""
    images = spark.read.format("image").option("pathGlobFilter", GLOB).load(folder).select("image.*")
    name = F.element_at(F.split("origin", "/"), -1)
    bad = (F.col("width") < 0) | F.col("width").isNull()
    seen = images.select(name.alias("file_name"), F.when(~bad, F.col("width")).alias("width"), F.when(~bad, F.col("height")).alias("height"), F.col("nChannels").alias("channels"), F.when(~bad, F.col("data")).alias("bgr"), F.when(bad, "undecodable image").alias("error"))
    return in_order(seen)


def sized(spark: SparkSession, folder: str) -> DataFrame:
    """The scans of a folder with width and height from their headers, null where those say none; no pixel is decoded."""
    size = image_size(F.col("content"))
    return scan_files(spark, folder).withColumn("size", size).select("file_name", "stem", "ext", "natural", "size.width", "size.height")


def collisions(pages: DataFrame) -> DataFrame:
    """Stems that several files share: they would write one page."""
    return pages.groupBy("stem").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("file_name")).alias("files")).where("n > 1")


def markdown_files(spark: SparkSession, folder: str) -> DataFrame:
    return _texts(spark, folder, "*.md").withColumnRenamed("text", "md")


def region_files(spark: SparkSession, folder: str) -> DataFrame:
    return _texts(spark, folder, "*.json").withColumnRenamed("text", "json")


def _texts(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    files = spark.read.text(folder, wholetext=True, pathGlobFilter=glob)
    return files.select(T.stem_of(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)).alias("stem"), F.col("value").alias("text"))
