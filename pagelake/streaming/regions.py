"""Model answers as a stream: the same region transforms, page by page, as answer files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.operators import detection

ANSWERS = "page_id string, img_w int, img_h int, response string"


def answers(spark: SparkSession, folder: str, per_batch: int = 1000) -> DataFrame:
    """JSON lines of ANSWERS as they arrive."""
    return spark.readStream.schema(ANSWERS).option("maxFilesPerTrigger", per_batch).json(folder)


def region_sink(batch: DataFrame, number: int, out: str) -> None:
    """Regions of one batch, and the pages that failed in out_errors; a page is whole in its answer, so numbering needs no
    state.

    A batch has a folder of its own (batch_id=number), so one that is run again replaces what it wrote. A page fails as in
    a run: its answer does not parse, has no list of regions, or a region's reading order is of no use.
    """
    keys = ["page_id", "img_w", "img_h"]
    batch.persist()  # two tables are made of it
    parsed = detection.parse_answers(batch)
    shape = detection.page_errors(parsed, ["page_id"])
    raw = detection.fields(detection.unnest_regions(parsed, keys), keys).withColumn("box", detection.R.normal_box(F.col("bbox")))
    bad = raw.where("fails").select("page_id", F.lit("unusable reading order").alias("error"))
    failed = shape.unionByName(bad.distinct())
    regions = detection.detect(raw.join(failed.select("page_id").distinct(), "page_id", "left_anti"))
    regions.select("page_id", "id", "type", "bbox", "reading_order").write.mode("overwrite").parquet(f"{out}/batch_id={number}")
    answers = batch.select("page_id", F.col("response").alias("detail")).dropDuplicates(["page_id"])
    records = detection.error_record(failed.join(answers, "page_id", "left"))
    records.write.mode("overwrite").parquet(f"{out}_errors/batch_id={number}")
    batch.unpersist()


def write_regions(stream: DataFrame, out: str, checkpoint: str):
    return stream.writeStream.foreachBatch(lambda df, i: region_sink(df, i, out)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


