"""A second run asks for what has changed, and for nothing else."""

import os

import pytest

from pagelake.config import RunConfig
from pagelake.operators import images
from pagelake.plans import documents, ledger
from tests.test_runs import ANSWER, page


@pytest.fixture()
def counted(tmp_path):
    """A client that logs its calls, and fails on pages of a width that the file `bad` names."""
    log, bad = str(tmp_path / "calls"), str(tmp_path / "bad")

    def client(policy):
        def answer(prompt, level, resolution, pixels):
            with open(log, "a") as f:
                f.write(policy.stage + "\n")
            if os.path.exists(bad) and policy.stage == "detect" and len(pixels) == int(open(bad).read()):
                raise OSError("no answer")
            return ANSWER if policy.stage == "detect" and prompt.startswith("List") else "Some text"

        return answer

    def calls():
        made = open(log).read().split() if os.path.exists(log) else []
        open(log, "w").close()
        return sorted(made)

    return client, calls, bad


def put(tmp_path, **widths):
    (tmp_path / "in").mkdir(exist_ok=True)
    for name, w in widths.items():
        (tmp_path / "in" / f"{name}.png").write_bytes(images.png(page(w)))


def test_only_changed_scans_are_asked_for(spark, tmp_path, counted):
    client, calls, _ = counted
    put(tmp_path, s_1=120, s_2=130, s_3=140)
    config = RunConfig(input_dir=str(tmp_path / "in"), output_dir=str(tmp_path / "out"), doc_type="map")
    assert documents.run(spark, config, client)["pages_processed"] == 3 and len(calls()) == 3
    before = {n: os.stat(tmp_path / "out/md" / n).st_mtime_ns for n in os.listdir(tmp_path / "out/md")}
    again = documents.run(spark, config, client)
    assert again["pages_processed"] == 3 and again["errors"] == [] and calls() == []
    assert before == {n: os.stat(tmp_path / "out/md" / n).st_mtime_ns for n in os.listdir(tmp_path / "out/md")}
    put(tmp_path, s_2=135)  # a changed scan
    assert documents.run(spark, config, client)["pages_processed"] == 3 and len(calls()) == 1
    put(tmp_path, s_4=150)  # a new one; one that has gone no longer counts
    os.remove(tmp_path / "in/s_1.png")
    assert documents.run(spark, config, client)["pages_processed"] == 3 and len(calls()) == 1
    # Other settings ask for all.
    assert documents.run(spark, RunConfig(**{**vars(config), "model_id": "other"}), client)["pages_processed"] == 3 and len(calls()) == 3


def test_failed_pages_are_asked_for_again_and_others_stay(spark, tmp_path, counted):
    client, calls, bad = counted
    put(tmp_path, s_1=120, s_2=130)
    (tmp_path / "in/broken.png").write_bytes(b"no image")
    open(bad, "w").write(str(page(130).size))
    config = RunConfig(input_dir=str(tmp_path / "in"), output_dir=str(tmp_path / "out"))
    first = documents.run(spark, config, client)
    assert [e["page"] for e in first["errors"]] == ["broken", "s_2"] and first["pages_processed"] == 1 and calls() == ["detect", "detect", "transcribe"]
    os.remove(bad)
    second = documents.run(spark, config, client)
    assert [e["page"] for e in second["errors"]] == ["broken"] and second["pages_processed"] == 2 and calls() == ["detect", "transcribe"]
    assert sorted(os.listdir(tmp_path / "out/md")) == ["s_1.md", "s_2.md"]
    # Every page's answers are there, each once.
    assert sorted(r.page_id for r in spark.read.parquet(str(tmp_path / "out/answers/detect")).collect()) == ["s_1", "s_2"]


def test_a_broken_run_goes_on_with_the_answers_that_it_has(spark, tmp_path, counted, monkeypatch):
    client, calls, _ = counted
    put(tmp_path, s_1=120, s_2=130)
    config = RunConfig(input_dir=str(tmp_path / "in"), output_dir=str(tmp_path / "out"))
    with monkeypatch.context() as m:
        m.setattr(documents.images, "crops", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            documents.run(spark, config, client)
    assert calls() == ["detect", "detect"]
    assert documents.run(spark, config, client)["pages_processed"] == 2 and calls() == ["transcribe", "transcribe"]


def test_rows_are_replaced_in_their_parts_only(spark, tmp_path):
    path = str(tmp_path / "table")
    frame = lambda rows: ledger.kept(spark.createDataFrame(rows, "k string, v int"), str(tmp_path / f"new{len(rows)}"))
    ledger.replace(frame([(str(i), 0) for i in range(300)]), path, ["k"])
    files = {os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}
    ledger.replace(frame([("7", 1), ("new", 1)]), path, ["k"])
    left = {os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}
    assert len(files - left) <= 2 * len(files) / len(os.listdir(path)) + 4
    got = {r.k: r.v for r in ledger.read(spark, path, "k string, v int").collect()}
    assert got == {str(i): int(i == 7) for i in range(300)} | {"new": 1}
    ledger.replace(frame([]), path, ["k"])
    assert ledger.read(spark, path, "k string, v int").count() == 301 and ledger.read(spark, path + "no", "k string").count() == 0


def test_scans_are_decoded_once(spark, tmp_path, counted):
    """Names and order come from the listing: the image reader is run for one job's tasks, once a scan."""
    client, _, _ = counted
    put(tmp_path, s_1=120, s_2=130, s_3=140)
    reads = []
    real = documents.scans.decoded
    documents.scans.decoded = lambda spark, paths: reads.append(paths) or real(spark, paths)
    try:
        documents.run(spark, RunConfig(input_dir=str(tmp_path / "in"), output_dir=str(tmp_path / "out"), doc_type="map"), client)
    finally:
        documents.scans.decoded = real
    assert len(reads) == 1 and len(reads[0]) == 3
