"""Helpers shared by the corpus operators: materialised tables, column packing, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the contracts define it: blank and the ASCII controls 9 to 13.
SPACE = "\\x20\\x09-\\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it.

    Only a session in one process (tests) gets a folder of its own where none is set; on a cluster that would be another
    folder on each machine, so it is an error.
    """
    if at := spark.conf.get("spark.checkpoint.dir", None):
        return at.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
    at = "file://" + tempfile.mkdtemp(prefix="pagelake-")
    spark.conf.set("spark.checkpoint.dir", at)
    return at


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Queries that end in here leave no shuffle files: else those stay until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, True)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def materialize(df: DataFrame, tag: str, *over: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, survives lost executors.

    Tables written before that nothing needs any more (over) are deleted once the new one is there, and so are the shuffle
    files that it was made with.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    with shuffles_end(spark):
        df.write.parquet(path)
    discard(spark, *over)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete what materialize wrote for these tables."""
    for df in tables:
        if path := getattr(df, "_written_at", None):
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


_HELD: dict[str, Any] = {}


def held(name: str, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task under a name. It keeps one such thing: workers outlive a query, so what
    the operators of a session keep would add up."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def sealed(df: DataFrame, **own: Column) -> DataFrame:
    """df with its columns renamed in_0, in_1, ... so that no name in it can clash with an operator's own columns."""
    return df.select(*[col(c).alias(f"in_{i}") for i, c in enumerate(df.columns)], *[v.alias(k) for k, v in own.items()])


def unsealed(df: DataFrame, columns: list[str], **outputs: Column) -> DataFrame:
    """The input's columns under their names again; an output of the same name takes a column's place, others follow."""
    same = {k.lower(): k for k in outputs}
    old = [outputs[same[c.lower()]].alias(c) if c.lower() in same else F.col(f"in_{i}").alias(c) for i, c in enumerate(columns)]
    names = {c.lower() for c in columns}
    return df.select(*old, *[v.alias(k) for k, v in outputs.items() if k.lower() not in names])


def hash_sample(df: DataFrame, key: str, n: int, limit: int) -> DataFrame:
    """Of n rows about nine tenths of limit, chosen by a hash of the key; all where there are no more than that.

    Each task filters its own rows, so no task and no driver sees more than the sample.
    """
    share = 0.9 * limit / max(1, n)
    return df if share >= 1 else df.where(F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 40)) < int(share * (1 << 40)))


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component, for the edges a[i]-b[i] over nodes 0..n-1."""
    label = np.arange(n)
    while len(a):
        x, y = label[a], label[b]
        low = np.minimum(x, y)
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        while not np.array_equal(jump := new[new], new):
            new = jump
        if np.array_equal(new, label):
            break
        label = new
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def connected_components(edges: DataFrame, tag: str = "cc") -> DataFrame:
    """(node, component) for every node of edges(a, b); component is the smallest node that can be reached.

    Alternates two star contractions until only stars are left (a logarithmic number of rounds in practice; there is no
    limit to them). Every step is a join or a minimum per key with map-side combination; both sides of a join are written
    tables, so that adaptive execution can split a hub, and go when the next round has been written. Nulls and loops are
    ignored.
    """
    oriented = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = materialize(oriented.distinct(), tag)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), tag)
        large = both.join(near, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), tag, now, near)
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), tag)
        small = large.join(least, "u")
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(small.select("u", F.col("m").alias("v")))
        now = materialize(moved.distinct(), tag, large, least)
        # Stars: no node has two parents, and no parent has a parent.
        twice = now.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
        chained = now.select(F.col("v").alias("u")).join(now.select("u"), "u", "left_semi")
        if twice.unionByName(chained).isEmpty():
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
