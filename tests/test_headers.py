"""Image sizes from headers against the decoded ones, and errors of a stream of answers."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from pagelake.functions.headers import image_size
from pagelake.operators import images
from pagelake.sources import scans
from pagelake.streaming import regions as stream
from tests.test_runs import ANSWER, page


def write_image(spark, path, w, h, kind):
    jvm = spark._jvm
    image = jvm.java.awt.image.BufferedImage(w, h, 5)
    assert jvm.javax.imageio.ImageIO.write(image, kind, jvm.java.io.File(str(path)))


def test_sizes_are_those_of_the_decoded_images(spark, tmp_path):
    for i, (w, h) in enumerate([(1, 1), (300, 7), (257, 4097), (70, 256)]):
        for kind in ("png", "jpg", "tif"):
            write_image(spark, tmp_path / f"i{i}.{kind}" if kind != "tif" else tmp_path / f"t{i}.tif", w, h, kind if kind != "tif" else "tiff")
    (tmp_path / "own.png").write_bytes(images.png(page(121, 77)))
    (tmp_path / "broken.png").write_bytes(b"no image")
    (tmp_path / "empty.jpg").write_bytes(b"")
    got = {r.file_name: (r.width, r.height) for r in scans.sized(spark, str(tmp_path)).collect()}
    want = {r.file_name: (r.width, r.height) for r in scans.decoded(spark, str(tmp_path)).collect()}
    assert got == want and got["own.png"] == (121, 77) and got["t1.tif"] == (300, 7) and got["broken.png"] == (None, None)
    plan = scans.sized(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "image" not in plan.split("Format:")[1][:20].lower()


@pytest.mark.parametrize("order", ["<", ">"])
def test_odd_headers(spark, order):
    """Segments of many lengths before a JPEG's frame, fill bytes, tables that look like frames; both orders of a TIFF."""
    app = b"".join(b"\xff" + bytes([0xE0 + i % 16]) + struct.pack(">H", 2 + n) + b"\xff\xc0" * (n // 2) + b"x" * (n % 2) for i, n in enumerate([0, 3, 14, 60_000, 1]))
    tables = b"\xff\xc4" + struct.pack(">H", 9) + b"\xc0\xff\xc0\x00\x01\x02\x03" + b"\xff\xff\xff"
    frame = b"\xff\xc2" + struct.pack(">HBHH", 17, 8, 480, 640)
    entries = [(254, 4, 0), (256, 3, 1234), (257, 4, 70_000)]
    tiff = (b"II*\0" if order == "<" else b"MM\0*") + struct.pack(order + "I", 20) + b"\0" * 12 + struct.pack(order + "H", len(entries))
    tiff += b"".join(struct.pack(order + "HHI", t, k, 1) + (struct.pack(order + "HH", v, 0) if k == 3 else struct.pack(order + "I", v)) for t, k, v in entries)
    cases = [b"\xff\xd8" + app + tables + frame, b"\xff\xd8" + app, b"\xff\xd8\xff", tiff, tiff[:30], b"GIF89a", b"\x89PNG\r\n\x1a\n", None, bytearray(100)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c binary").select("i", image_size(F.col("c")).alias("s"))
    assert {r.i: r.s and tuple(r.s) for r in df.collect()} == {0: (640, 480), 3: (1234, 70_000), **dict.fromkeys((1, 2, 4, 5, 6, 7, 8))}


def test_failed_pages_of_a_stream_are_written(spark, tmp_path):
    (tmp_path / "a").mkdir()
    answers = {"p": ANSWER, "q": "no json", "r": '{"regions": null}', "s": '{"regions": [{"reading_order": "first", "bbox": {"x": 1, "y": 1, "width": 5, "height": 5}}]}'}
    (tmp_path / "a" / "1.json").write_text("".join(json.dumps({"page_id": k, "img_w": 100, "img_h": 100, "response": v}) + "\n" for k, v in answers.items()))
    q = stream.write_regions(stream.answers(spark, str(tmp_path / "a")), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert {r.page_id for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"p"}
    failed = {r.page_id: (r.error, r.detail) for r in spark.read.parquet(str(tmp_path / "out_errors")).collect()}
    assert failed == {"q": ("JSON parse", "no json"), "r": ("regions is no list", answers["r"]), "s": ("unusable reading order", answers["s"])}
