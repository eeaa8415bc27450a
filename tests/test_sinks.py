"""Files of rows: all of them, or none when the job fails."""

import os

import pytest
from pyspark.sql import functions as F

from pagelake.sources import sinks


def files(folder):
    return sorted(os.path.relpath(os.path.join(d, n), folder) for d, _, names in os.walk(folder) for n in names)


def test_files_by_path_and_uri(spark, tmp_path):
    rows = spark.createDataFrame([("a.md", "é"), ("sub/b.md", ""), ("sub/deep/c.md", None), ("d.md", "x" * 100_000)], "name string, text string").repartition(3)
    for folder in (str(tmp_path / "one"), (tmp_path / "two").as_uri()):
        assert sinks.write_files(rows, folder, "name", "text") == 4
    for at in ("one", "two"):
        assert files(tmp_path / at) == ["a.md", "d.md", "sub/b.md", "sub/deep/c.md"] and sorted(os.listdir(tmp_path / at)) == ["a.md", "d.md", "sub"]
        assert (tmp_path / at / "a.md").read_bytes() == "é".encode() and (tmp_path / at / "sub/deep/c.md").read_bytes() == b""
    again = spark.createDataFrame([("a.md", bytearray(b"new"))], "name string, data binary")
    assert sinks.write_files(again, str(tmp_path / "one"), "name", "data") == 1 and (tmp_path / "one/a.md").read_bytes() == b"new"
    assert sinks.write_files(again.limit(0), str(tmp_path / "none"), "name", "data") == 0 and files(tmp_path / "none") == []
    assert sinks.write_summary((tmp_path / "two").as_uri(), {"n": 1}).endswith("summary.json") and (tmp_path / "two/summary.json").exists()
    sinks.fresh_folder((tmp_path / "two").as_uri())
    assert files(tmp_path / "two") == []


def test_a_job_that_fails_leaves_no_file(spark, tmp_path):
    rows = spark.range(40).select(F.concat(F.col("id").cast("string"), F.lit(".md")).alias("name"), F.when(F.col("id") == 37, F.raise_error(F.lit("broken row"))).otherwise("x").alias("text")).repartition(4)
    with pytest.raises(Exception, match="broken row"):
        sinks.write_files(rows, str(tmp_path), "name", "text")
    assert os.listdir(tmp_path) == []


@pytest.mark.parametrize("names", [["a", "b", "a"], ["a", None], ["a", "../b"], ["a", "/b"], ["x/../../b"]])
def test_names_are_checked_before_anything_is_in_place(spark, tmp_path, names):
    rows = spark.createDataFrame([(n, "x") for n in names], "name string, text string")
    with pytest.raises(Exception, match="name"):
        sinks.write_files(rows, str(tmp_path / "in"), "name", "text")
    assert files(tmp_path) == []


def test_moving_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    """A file that an earlier attempt of the second phase has moved is no error."""
    rows = spark.createDataFrame([("a", "1"), ("b", "2")], "name string, text string").coalesce(1)
    kind = type(rows)
    real, made = kind.mapInPandas, []

    def twice(self, f, schema, *args, **kwargs):
        out = real(self, f, schema, *args, **kwargs)
        if schema == "n long":
            made.extend(real(self, f, schema, *args, **kwargs).collect())  # the moves, and then once more by the sink
        return out

    monkeypatch.setattr(kind, "mapInPandas", twice)
    assert sinks.write_files(rows, str(tmp_path), "name", "text") == 2 and made and files(tmp_path) == ["a", "b"]


def test_one_file_in_order_without_the_driver(spark, tmp_path, monkeypatch):
    rows = spark.range(2000).select((F.col("id") * 7 % 2000).alias("k")).withColumn("t", F.format_string("<p>%d\nline</p>", "k")).repartition(5)
    monkeypatch.setattr(type(rows), "toLocalIterator", lambda *_: 1 / 0)
    for path in (str(tmp_path / "a.html"), (tmp_path / "b.html").as_uri()):
        sinks.write_in_order(["<b>é", (rows, F.col("k"), "t"), "</b>", (rows.limit(0), F.col("k"), "t"), (rows.where("k < 3"), -F.col("k"), "t"), "end"], path)
    want = "<b>é" + "".join(f"<p>{k}\nline</p>\n" for k in range(2000)) + "</b>" + "".join(f"<p>{k}\nline</p>\n" for k in (2, 1, 0)) + "end"
    assert (tmp_path / "a.html").read_text() == want == (tmp_path / "b.html").read_text() and files(tmp_path) == ["a.html", "b.html"]
