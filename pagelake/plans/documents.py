"""A document run: scans to pages, regions, transcriptions, Markdown, JSON and a summary."""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.config import RunConfig, parse_args
from pagelake.functions import text
from pagelake.operators import detection, images, markdown, model
from pagelake.plans import ledger
from pagelake.plans.ledger import kept
from pagelake.sources import scans, sinks

FIELDS = ["id", "type", "bbox", "reading_order", "title_text", "rows", "cols", "header_rows", "has_red_ink", "has_totals_row", "graph_type", "has_fitted_curve", "line_count", "script", "page_number", "transcription"]


#: Changed scans that are named one by one to the reader; of more, the folder is read and joined with their names.
NAMED = 10_000


def listed_scans(spark: SparkSession, folder: str, order_dir: str | None = None) -> DataFrame:
    """The scans of a folder by name, none decoded: file_name, path, stem, digest of the content, seq in natural order, and
    the error of a stem that several files share."""
    files = scans.scan_files(spark, folder)
    order = scans.numbered(files.select("file_name", "natural"), F.struct("natural", "file_name"), path=order_dir).select("file_name", "seq")
    twice = scans.collisions(files).select("stem", F.lit("several scans share this stem").alias("shared"))
    digests = files.select("file_name", "path", "stem", F.sha2("content", 256).alias("digest"))
    return digests.join(twice, "stem", "left").join(order, "file_name")


def ordered_scans(spark: SparkSession, folder: str, listing: DataFrame | None = None) -> DataFrame:
    """Decoded scans with seq, their natural order; only those of the listing, if one is given, each decoded once."""
    wanted = listed_scans(spark, folder) if listing is None else listing
    names = [] if listing is None else [r.path for r in listing.select("path").limit(NAMED + 1).collect()]
    found = scans.decoded(spark, names if 0 < len(names) <= NAMED else folder)
    found = found.join(wanted.select("file_name", "seq", "shared"), "file_name")
    return found.withColumn("error", F.coalesce("shared", "error")).drop("shared")


def detected(pages: DataFrame, client: Callable, config: RunConfig, answers_dir: str) -> tuple[DataFrame, DataFrame]:
    """(regions, errors) of the pages without an error; each page's answer is in answers_dir/detect, and what in it the
    declared schema does not allow, though detection makes something of it, in answers_dir/violations."""
    good = pages.where("error is null")
    request = good.select("page_id", "width", "height", F.lit(model.PROMPTS["detect"].format(max_regions=config.max_regions)).alias("prompt"), "pixels")
    policy = model.Policy("detect", config.detection_thinking, config.detection_media_resolution, config.detection_retries, model_id=config.model_id, temperature=config.detection_temperature, max_output_tokens=config.max_output_tokens)
    ask = lambda requests, keys: model.ask_model(requests, client, policy, keys, parse=text.parsed_answer)
    answers = ledger.remembered(request, ["page_id", "width", "height"], F.lit(repr(policy)), f"{answers_dir}/detect", ask)
    parsed = detection.parse_answers(answers.withColumnRenamed("text", "response"))
    parsed = parsed.withColumn("data", F.when(F.col("error").isNull(), F.col("data")))
    shape = detection.page_errors(parsed, ["page_id"]).withColumnRenamed("error", "shape")
    failed = parsed.join(shape, "page_id", "left").select("page_id", F.coalesce("error", "shape").alias("error"), F.col("response").alias("detail")).where("error is not null")
    entries = detection.unnest_regions(parsed.join(shape, "page_id", "left_anti"), ["page_id", "width", "height"])
    odd = entries.select("page_id", "pos", detection.violations(F.col("region")).alias("violations"), F.to_json("region").alias("region")).where("size(violations) > 0")
    odd = odd.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("pos", "violations", "region"))).alias("regions"))  # of one answer
    ledger.replace(kept(parsed.select("page_id").distinct().join(odd, "page_id", "left"), f"{answers_dir}/violations_found"), f"{answers_dir}/violations", ["page_id"])
    raw = detection.fields(entries, ["page_id", "width", "height"])
    raw = raw.withColumn("box", detection.R.normal_box(F.col("bbox"))).withColumn("img_w", F.col("width")).withColumn("img_h", F.col("height"))
    bad = raw.where("fails").select("page_id").distinct().select("page_id", F.lit("unusable reading order").alias("error"), F.lit("").alias("detail"))
    regions = detection.detect(raw.join(bad.select("page_id"), "page_id", "left_anti"), config.max_regions, margin=config.region_margin_frac)
    return regions, detection.error_record(failed.unionByName(bad))


def transcribed(cut: DataFrame, regions: DataFrame, client: Callable, config: RunConfig, answers_dir: str) -> DataFrame:
    """regions with status, text, error and skipped, from their cut images; each answer is in answers_dir/transcribe."""
    known, ask = model.route_regions(regions)
    request = model.prompts(ask).select("page_id", "id", "prompt").join(cut.select("page_id", "id", "pixels"), ["page_id", "id"])
    policy = model.Policy("transcribe", config.transcription_thinking, config.region_media_resolution, config.transcription_retries, model_id=config.model_id, temperature=config.transcription_temperature, max_output_tokens=config.max_output_tokens)
    answers = ledger.remembered(request, ["page_id", "id"], F.lit(repr(policy)), f"{answers_dir}/transcribe", lambda requests, keys: model.ask_model(requests, client, policy, keys))
    answers = answers.drop("attempts", "finish_reason")
    done = ask.join(answers, ["page_id", "id"]).withColumn("skipped", F.lit(None).cast("boolean"))
    return done.unionByName(known.withColumn("error", F.lit(None).cast("string")), allowMissingColumns=True)


def run(spark: SparkSession, config: RunConfig, client: Callable | None = None) -> dict:
    """Run the documents of a folder and return the summary. Pages fail alone; an empty folder writes nothing.

    Under the output folder are pages, regions, md and the summary; errors holds the table of all errors, answers what the
    model said, a row for each call with its attempts, ledger the scans that are done. A scan that an earlier run of the
    same settings has done, and that has not changed, is not decoded, asked for or written again; one with an error is.
    """
    client = client or config.client_factory()
    began = time.time()
    if scans.scan_files(spark, config.input_dir).select("file_name").isEmpty():
        return {"doc_type": config.doc_type, "model_id": config.model_id, "pages_processed": 0, "errors": []}
    out = {k: os.path.join(config.output_dir, k) for k in ("pages", "regions", "md", "errors", "answers", "ledger")}
    listing = kept(listed_scans(spark, config.input_dir, f"{out['ledger']}/order"), f"{out['ledger']}/listing")
    settings = ledger.settings_of(config)
    done = ledger.unchanged(listing.where("shared is null").select("file_name", "digest"), ledger.read(spark, f"{out['ledger']}/scans", ledger.SCANS), settings)
    done = kept(done.select("file_name", "n_pages"), f"{out['ledger']}/unchanged")
    todo = kept(listing.join(done, "file_name", "left_anti"), f"{out['ledger']}/todo")
    pages = images.prepared(ordered_scans(spark, config.input_dir, todo), config.single_page, config.split_overlap_px, config.deskew, config.enhance_contrast, config.sharpen).repartition(config.workers).cache()
    as_png = F.pandas_udf(lambda p, w, h: p.combine(w.combine(h, lambda a, b: (int(a), int(b))), lambda d, s: images.png(images.rgb(d, *s))), "binary")
    sinks.write_files(pages.where("error is null").select(F.concat("page_id", F.lit(".png")).alias("name"), as_png("pixels", "width", "height").alias("data")), out["pages"], "name", "data")
    errors = pages.where("error is not null").select(F.col("page_id").alias("page"), "error")
    if config.uses_region_detection:
        regions, failed = detected(pages, client, config, out["answers"])
        cut = kept(images.crops(pages, regions), f"{out['answers']}/crops")
        regions = transcribed(cut, regions, client, config, out["answers"])
        errors = errors.unionByName(failed.select(F.col("page_id").alias("page"), "error"))
        good = pages.where("error is null").select("page_id").join(failed.select("page_id"), "page_id", "left_anti")
        docs = good.join(markdown.region_documents(regions), "page_id", "left").select("page_id", F.coalesce("md", F.concat(F.lit("---\npage_id: "), "page_id", F.lit('\nregions: ""\n---\n'))).alias("md"))
        rows = regions.withColumn("transcription", F.struct("status", "text", "skipped", "error"))
        records = good.join(markdown.regions_json(rows, FIELDS), "page_id", "left").select("page_id", F.coalesce("json", F.lit("[]")).alias("json"))
        sinks.write_files(cut.select(F.concat("page_id", F.lit("/"), "id", F.lit("_"), "type", F.lit(".png")).alias("name"), "pixels"), out["regions"], "name", "pixels")
    else:
        kind = config.doc_type
        prompt, _ = model.full_page(kind)
        level = config.graph_media_resolution if kind == "graph" else config.full_page_media_resolution
        policy = model.Policy("transcribe", config.full_page_thinking, level, config.full_page_retries, model_id=config.model_id, temperature=config.transcription_temperature, max_output_tokens=config.max_output_tokens)
        request = pages.where("error is null").select("page_id", F.lit(prompt).alias("prompt"), "pixels")
        answers = ledger.remembered(request, ["page_id"], F.lit(repr(policy)), f"{out['answers']}/{kind}", lambda requests, keys: model.ask_model(requests, client, policy, keys)).withColumn("doc_type", F.lit(kind))
        errors = errors.unionByName(answers.where("status = 'error'").select(F.col("page_id").alias("page"), "error"))
        fine = answers.where("status = 'success'")
        docs, records = markdown.full_page_documents(fine), markdown.full_page_json(fine)
    if config.output_md:
        sinks.write_files(docs.select(F.concat("page_id", F.lit(".md")).alias("name"), "md"), out["md"], "name", "md")
    pretty = F.pandas_udf(lambda s: s.map(lambda x: json.dumps(json.loads(x), ensure_ascii=False, indent=2)), "string")
    sinks.write_files(records.select(F.concat("page_id", F.lit(".json")).alias("name"), pretty("json").alias("json")), out["regions"], "name", "json")
    errors = kept(errors, out["errors"])
    listed = errors.orderBy(scans.T.natural_key(F.col("page")), "error").limit(config.listed_errors)
    n_errors = errors.count()
    # A scan is done when none of its pages has an error; a shared stem or a broken scan is its page's name.
    good = pages.join(errors.select(F.col("page").alias("page_id")), "page_id", "left_anti").groupBy("stem").agg(F.count("*").alias("n_pages"))
    whole = pages.groupBy("stem").agg(F.count("*").alias("n")).join(good, "stem").where("n = n_pages")
    new = todo.join(whole, "stem").select("file_name", "digest", F.lit(settings).alias("settings"), "n_pages")
    ledger.replace(kept(new, f"{out['ledger']}/new"), f"{out['ledger']}/scans", ["file_name"])
    earlier = done.agg(F.sum("n_pages")).first()[0] or 0
    summary = {"doc_type": config.doc_type, "model_id": config.model_id, "pages_processed": earlier + pages.count() - n_errors, "n_errors": n_errors, "errors": [r.asDict() for r in listed.collect()], "elapsed_seconds": round(time.time() - began, 1)}
    sinks.write_summary(config.output_dir, summary)
    pages.unpersist()
    return summary


def main(argv: list[str] | None = None) -> int:
    """Exit code 1 if any page failed."""
    config = parse_args(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName("pagelake").getOrCreate()
    return int(bool(run(spark, config)["errors"]))


if __name__ == "__main__":
    sys.exit(main())
