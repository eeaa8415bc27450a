"""Whole runs over generated scans."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelake.config import RunConfig
from pagelake.operators import images
from pagelake.plans import documents, viewer
from pagelake.streaming import regions as stream


def page(w=120, h=90):
    x = np.full((h, w, 3), 250, np.uint8)
    x[10:80:12, 10:110] = 20
    return x


ANSWER = json.dumps({"regions": [{"type": "Title", "bbox": {"x": 0, "y": 0, "width": 500, "height": 200}, "reading_order": 2}, {"type": "PageNumberRegion", "bbox": [0, 900, 50, 990], "page_number": 7, "reading_order": 1}, {"type": "TableRegion", "bbox": {"x": 1}}]})


def client(policy=None):
    return lambda prompt, level, resolution, pixels: f"```json\n{ANSWER}\n```" if prompt.startswith("List") else "Some heading"


@pytest.fixture()
def scans(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("s_2.png", "s_10.PNG"):
        (folder / name).write_bytes(images.png(page()))
    (folder / "broken.png").write_bytes(b"no image")
    (folder / "note.txt").write_text("x")
    return str(folder)


def test_layout_run_and_viewer(spark, scans, tmp_path):
    out = str(tmp_path / "out")
    summary = documents.run(spark, RunConfig(input_dir=scans, output_dir=out), client)
    assert summary["pages_processed"] == 2 and [e["page"] for e in summary["errors"]] == ["broken"]
    md = open(f"{out}/md/s_2.md", encoding="utf-8").read()
    assert md.startswith('---\npage_id: s_2\npage_number: 7\nregions: "PageNumberRegion×1, TitleRegion×1"\n---\n\n## Some heading')
    records = json.load(open(f"{out}/regions/s_2.json", encoding="utf-8"))
    assert [r["id"] for r in records] == ["r01", "r02"] and records[0]["transcription"] == {"status": "success", "text": "7", "skipped": True}
    assert os.path.exists(f"{out}/regions/s_2/r02_TitleRegion.png") and os.path.exists(f"{out}/summary.json")
    numbers = viewer.build(spark, out, f"{out}/viewer.html", title="A & <b>")
    html = open(f"{out}/viewer.html", encoding="utf-8").read()
    assert numbers["n_pages"] == 2 and numbers["n_boxes"] == 4 and html.index('id="s_2"') < html.index('id="s_10"')
    assert "<title>A &amp; &lt;b&gt;</title>" in html and 'p. 7</span>' in html and html.index(">TitleRegion</span>") < html.index(">PageNumberRegion</span>") and '<a href="#s_10">' in html
    viewer.build(spark, out, f"{out}/viewer.html", embed=False)
    assert os.listdir(f"{out}/viewer_assets")


def test_full_page_run_and_empty_folder(spark, scans, tmp_path):
    out = str(tmp_path / "out")
    summary = documents.run(spark, RunConfig(input_dir=scans, output_dir=out, doc_type="map", single_page=False, deskew=True), client)
    assert summary["pages_processed"] == 4 and sorted(os.listdir(f"{out}/md")) == ["s_10_L.md", "s_10_R.md", "s_2_L.md", "s_2_R.md"]
    empty = tmp_path / "none"
    empty.mkdir()
    assert "elapsed_seconds" not in documents.run(spark, RunConfig(input_dir=str(empty), output_dir=out + "2"), client)
    assert not os.path.exists(out + "2")


def test_images():
    ruled = page()
    wide = np.full((300, 400), 250, np.uint8)
    wide[20:280:20, 40:360] = 20
    gray = 255 - wide
    assert abs(images.skew(gray)) <= 0.1
    turned = images.rotated(gray, -1.5, fill=0)
    assert abs(images.skew(turned) - 1.5) <= 0.2
    assert images.skew(np.zeros((20, 20), np.uint8)) == 0.0
    assert images.contrasted(ruled).min() == 0 and images.contrasted(ruled).max() == 255
    assert images.sharpened(np.full((9, 9, 3), 7, np.uint8)).tolist() == np.full((9, 9, 3), 7).tolist()
    assert images.scaled(ruled, 60).shape == (45, 60, 3) and images.scaled(ruled, 500) is ruled


def test_stream(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.json").write_text(json.dumps({"page_id": "p", "img_w": 100, "img_h": 100, "response": ANSWER}) + "\n")
    q = stream.write_regions(stream.answers(spark, str(tmp_path / "a")), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy(F.col("reading_order")).collect()
    assert [(r.page_id, r.id, r.type) for r in rows] == [("p", "r01", "PageNumberRegion"), ("p", "r02", "TitleRegion")]
