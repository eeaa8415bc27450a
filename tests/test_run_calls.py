"""What a run asks of the model, what it reports, and what the declared schema does not allow."""

import json
import os

from pyspark.sql import functions as F

from pagelake.config import RunConfig, parse_args
from pagelake.operators import detection, images, model
from pagelake.plans import documents
from pagelake.sources import scans
from tests.test_runs import ANSWER, page


def scans_in(tmp_path, names):
    (tmp_path / "in").mkdir()
    for name in names:
        (tmp_path / "in" / name).write_bytes(images.png(page()))
    return str(tmp_path / "in")


def test_each_page_is_asked_for_once_with_the_settings(spark, tmp_path):
    log = str(tmp_path / "calls")

    def client(policy):
        def answer(prompt, level, resolution, pixels):
            with open(log, "a") as f:
                f.write(f"{policy.stage} {policy.model_id} {policy.temperature} {policy.max_output_tokens}\n")
            return ANSWER if policy.stage == "detect" else model.Answer("Some heading", "STOP")

        return answer

    out = str(tmp_path / "out")
    config = RunConfig(input_dir=scans_in(tmp_path, ["s_1.png", "s_2.png", "s_10.png"]), output_dir=out, model_id="m1", detection_temperature=0.5, transcription_temperature=0.25, max_output_tokens=99, region_margin_frac=0.0)
    assert documents.run(spark, config, client)["errors"] == []
    calls = open(log).read().splitlines()
    assert sorted(calls) == ["detect m1 0.5 99"] * 3 + ["transcribe m1 0.25 99"] * 3
    records = json.load(open(f"{out}/regions/s_1.json", encoding="utf-8"))
    assert records[1]["bbox"] == {"x": 0, "y": 0, "width": 60, "height": 18}  # no margin around it
    assert spark.read.parquet(f"{out}/answers/transcribe").where("finish_reason = 'STOP'").count() == 3


def test_no_list_is_an_error_and_all_errors_are_in_the_table(spark, tmp_path):
    answers = {"s_1": '{"regions": null}', "s_2": '{"regions": "none"}', "s_3": "{}", "s_10": ""}
    shape = {}

    def client(policy):
        return lambda prompt, level, resolution, pixels: next(v for k, v in answers.items() if len(pixels) == shape[k])

    folder = tmp_path / "in"
    folder.mkdir()
    for k, name in enumerate(answers):
        pixels = page(120 + k)
        shape[name] = pixels.size
        (folder / f"{name}.png").write_bytes(images.png(pixels))
    out = str(tmp_path / "out")
    summary = documents.run(spark, RunConfig(input_dir=str(folder), output_dir=out, listed_errors=2), client)
    assert [(e["page"], e["error"]) for e in summary["errors"]] == [("s_1", "regions is no list"), ("s_2", "regions is no list")]
    assert summary["pages_processed"] == 1 and summary["n_errors"] == 3
    table = {r.page: r.error for r in spark.read.parquet(f"{out}/errors").collect()}
    assert table["s_10"] == "empty response (finish reason: unknown)" and set(table) == {"s_1", "s_2", "s_10"} and os.path.exists(f"{out}/md/s_3.md")


def test_order_and_client_by_name(spark, tmp_path):
    names = ["s_10.png", "s_2.png", "S_1.png", "t.png"]
    found = documents.ordered_scans(spark, scans_in(tmp_path, names))
    assert {r.file_name: r.seq for r in found.collect()} == {"S_1.png": 1, "s_2.png": 2, "s_10.png": 3, "t.png": 4}
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k")).repartition(7)
    assert all(r.seq == r.k + 1 for r in scans.numbered(df, F.col("k")).collect())
    config = parse_args(["-i", "a", "-o", "b", "--client", "pagelake.operators.model:stub_client", "--temperature", "0.5"])
    assert config.client_factory() is model.stub_client and config.detection_temperature == 0.5


def test_full_page_modes():
    assert model.full_page("graph")[1] == "ultra_high"
    try:
        model.full_page("text")
        raise AssertionError("no error")
    except ValueError as e:
        assert "text" in str(e)


def test_violations_of_the_schema(spark):
    good = {"type": "TableRegion", "bbox": {"x": 0, "y": 0, "width": 1, "height": 1000}, "reading_order": 1, "rows": 3, "page_number": "4"}
    cases = [
        (good, []),
        ({}, ["type is missing", "bbox is missing", "reading_order is missing"]),
        (good | {"type": "Table"}, ["type is unknown"]),
        (good | {"bbox": [1, 2, 3, 4]}, ["bbox is no object"]),
        (good | {"bbox": {"x": -1, "y": 0.5, "width": 0, "x1": 3}}, ["bbox.x is not from 0 to 1000", "bbox.y is not from 0 to 1000", "bbox.width is not from 1 to 1000", "bbox.height is not from 1 to 1000", "bbox has other keys"]),
        (good | {"rows": "3", "has_red_ink": 1, "page_number": 4.5}, ["rows is no bigint", "has_red_ink is no boolean", "page_number is no string or bigint"]),
    ]
    df = spark.createDataFrame([(k, json.dumps(x)) for k, (x, _) in enumerate(cases)], "k int, j string").withColumn("r", F.parse_json("j"))
    got = {r.k: r.v for r in df.select("k", detection.violations(F.col("r")).alias("v")).collect()}
    assert got == {k: v for k, (_, v) in enumerate(cases)}


def test_lenient_answers(spark):
    df = spark.createDataFrame([("no json",), ('{"a": 1}',), (None,)], "response string")
    assert [r.d for r in detection.lenient(df).select(F.to_json("data").alias("d")).collect()] == ["{}", '{"a":1}', "{}"]


def test_violations_of_a_run_are_kept_by_page(spark, tmp_path):
    said = {"s_1": '{"regions": [{"type": "Title", "bbox": {"x": 0, "y": 0, "width": 500, "height": 200}, "reading_order": 1}]}', "s_2": '{"regions": []}'}
    shape = {}

    def client(policy):
        return lambda prompt, level, resolution, pixels: next(v for k, v in said.items() if len(pixels) == shape[k]) if policy.stage == "detect" else "Some text"

    (tmp_path / "in").mkdir()
    for k, name in enumerate(said):
        pixels = page(120 + k)
        shape[name] = pixels.size
        (tmp_path / "in" / f"{name}.png").write_bytes(images.png(pixels))
    out = str(tmp_path / "out")
    assert documents.run(spark, RunConfig(input_dir=str(tmp_path / "in"), output_dir=out), client)["errors"] == []
    found = {r.page_id: r.regions for r in spark.read.parquet(f"{out}/answers/violations").collect()}
    assert found["s_2"] is None and [(r.pos, r.violations) for r in found["s_1"]] == [(0, ["type is unknown"])]


def test_viewer_by_command_line(spark, tmp_path, capsys):
    import pytest

    from pagelake.plans import viewer

    a = viewer.parse_args(["run/", "--title", "T", "--no-embed", "--max-width", "9"])
    assert (a.run_dir, a.output, a.title, a.no_embed, a.max_width) == ("run/", "run/viewer.html", "T", True, 9)
    with pytest.raises(SystemExit):
        viewer.parse_args(["run", "--max-width", "0"])
    for part in ("md", "pages", "regions"):
        (tmp_path / part).mkdir()
    (tmp_path / "md" / "p.md").write_text("---\npage_id: p\n---\n\nbody\n")
    (tmp_path / "pages" / "p.png").write_bytes(images.png(page()))
    (tmp_path / "regions" / "p.json").write_text("[]")
    assert viewer.main([str(tmp_path), "-o", str(tmp_path / "v.html")]) == 0 and 'id="p"' in (tmp_path / "v.html").read_text()
