"""One file per row, named by the row, written by the executors in two phases; a summary by the driver.

First every task writes its files into a folder of the job and lists them in a table; that table is committed by Spark, so
it names the files of tasks that succeeded and of no others. Then the listed files are moved to their places, by the
executors too. What fails before the second phase leaves no file in place; what fails in it is run again and goes on.

Folders are paths or URIs of any file system that Arrow knows (file, hdfs, s3, gs, abfs); executors have to reach them.
"""

from __future__ import annotations

import json
import uuid

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names that an error lists.
_SHOWN = 5


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def _joined(folder: str, *parts: str) -> str:
    return "/".join([folder.rstrip("/"), *parts])


def write_files(rows: DataFrame, folder: str, name: str, content: str) -> int:
    """Write each row's content (text as UTF-8, or bytes) to folder/name and return how many.

    Names may have folders in them. Two rows of one name, a null name or one that leads out of the folder are an error
    before anything is in place. A row without content is an empty file.
    """
    job = _joined(folder, f"_staged-{uuid.uuid4().hex}")

    def stage(batches):
        system, at = opened(job)
        for batch in batches:
            files = []
            for row, data in zip(batch[name], batch[content], strict=True):
                if row is None or row.startswith("/") or ".." in row.split("/"):
                    raise ValueError(f"no name of a file in the folder: {row!r}")
                part = f"files/{uuid.uuid4().hex}"
                system.create_dir(_joined(at, "files"), recursive=True)
                with system.open_output_stream(_joined(at, part)) as f:
                    f.write(b"" if data is None else data.encode() if isinstance(data, str) else bytes(data))
                files.append((row, part))
            yield pd.DataFrame(files, columns=["name", "part"])

    def put(batches):
        system, at = opened(folder)
        staged = _joined(at, job.rsplit("/", 1)[1])
        for batch in batches:
            for row, part in zip(batch["name"], batch["part"], strict=True):
                target, source = _joined(at, row), _joined(staged, part)
                if system.get_file_info(source).type == fs.FileType.NotFound:
                    continue  # an earlier attempt has moved it
                system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                system.move(source, target)
            yield pd.DataFrame({"n": [len(batch)]})

    spark = rows.sparkSession
    system, at = opened(job)
    system.create_dir(at, recursive=True)
    try:
        rows.select(name, content).mapInPandas(stage, "name string, part string").write.parquet(_joined(job, "list"))
        listed = spark.read.schema("name string, part string").parquet(_joined(job, "list"))
        twice = listed.groupBy("name").count().where("count > 1").orderBy("name").limit(_SHOWN).collect()
        if twice:
            raise ValueError("several rows have one name: " + ", ".join(r.name for r in twice))
        return listed.mapInPandas(put, "n long").agg(F.sum("n")).first()[0] or 0
    finally:
        system.delete_dir(at)


def write_in_order(pieces: list[str | tuple[DataFrame, Column, str]], path: str) -> None:
    """One text file of pieces in a row: texts, and tables (rows, key, column) whose texts follow in ascending order of key.

    A table is sorted by ranges over all tasks and written as text parts, in order by their names; one task then copies the
    parts to the file, a block at a time, and moves it into place. No row comes to the driver.
    """
    job = f"{path}.parts-{uuid.uuid4().hex}"
    plan: list[tuple[str, str]] = []
    system, at = opened(job)
    system.create_dir(at, recursive=True)
    try:
        for i, piece in enumerate(pieces):
            if isinstance(piece, str):
                plan.append(("text", piece))
                continue
            rows, key, column = piece
            ordered = rows.select(key.alias("key"), F.col(column).alias("value")).repartitionByRange("key").sortWithinPartitions("key")
            ordered.select("value").write.text(_joined(job, str(i)))
            plan.append(("parts", _joined(job, str(i))))

        def copy(batches):
            system, target = opened(path)
            for batch in batches:
                with system.open_output_stream(f"{target}.part") as out:
                    for kind, what in plan:
                        if kind == "text":
                            out.write(what.encode())
                            continue
                        found = system.get_file_info(fs.FileSelector(opened(what)[1]))
                        for part in sorted(f.path for f in found if f.base_name.startswith("part-")):
                            with system.open_input_stream(part) as f:
                                while block := f.read(1 << 20):
                                    out.write(block)
                system.move(f"{target}.part", target)
                yield batch

        spark = next(p[0] for p in pieces if not isinstance(p, str)).sparkSession
        spark.range(1).coalesce(1).mapInPandas(copy, "id long").collect()
    finally:
        system.delete_dir(at)


def fresh_folder(folder: str) -> None:
    """An empty folder for assets; what an earlier run left in it goes."""
    system, at = opened(folder)
    if system.get_file_info(at).type == fs.FileType.Directory:
        system.delete_dir(at)
    system.create_dir(at, recursive=True)


def write_summary(folder: str, summary: dict) -> str:
    path = _joined(folder, "summary.json")
    system, at = opened(path)
    with system.open_output_stream(at) as f:
        f.write(json.dumps(summary, ensure_ascii=False, indent=2).encode())
    return path
