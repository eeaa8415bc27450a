"""What earlier runs have done: a ledger of scans by the digest of their content, and of the model's answers by request.

A scan whose content and settings are in the ledger is not decoded again; a request that was answered is not asked again,
so a run that was broken off goes on where it stopped. Both are tables in 64 parts by the hash of their keys; rows are
replaced by overwriting the parts that they lie in, and no others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagelake.config import RunConfig

PARTS = 64
SCANS = "file_name string, digest string, settings string, n_pages long"
#: Settings that no page depends on.
_ASIDE = ("input_dir", "output_dir", "workers", "listed_errors")


def settings_of(config: RunConfig) -> str:
    return repr(sorted((k, v) for k, v in vars(config).items() if k not in _ASIDE))


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The ledger at path; without rows if there is none yet."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).drop("part")


def kept(df: DataFrame, path: str) -> DataFrame:
    """df written once and read back: what a model said is asked for once, whatever is made of it and whoever is lost."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Put rows, a written table, in the place of those with the same keys; only their parts are written."""
    spark = rows.sparkSession
    part = F.pmod(F.xxhash64(*keys), F.lit(PARTS)).cast("int").alias("part")
    new = rows.select("*", part)
    if _exists(spark, path):
        touched = F.broadcast(new.select("part").distinct())  # at most 64
        old = spark.read.schema(rows.schema).parquet(path).join(touched, "part", "left_semi").join(rows.select(*keys), keys, "left_anti")
        new = old.select(new.columns).unionByName(new)
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def unchanged(listing: DataFrame, done: DataFrame, settings: str) -> DataFrame:
    """Of listing(file_name, digest): the scans that are done, with their number of pages."""
    return listing.join(done.where(F.col("settings") == settings).drop("settings"), ["file_name", "digest"])


def remembered(requests: DataFrame, keys: list[str], said: Column, path: str, ask: Callable[[DataFrame, list[str]], DataFrame]) -> DataFrame:
    """The answers to requests(keys, prompt, pixels): those at path that were successes, the others from ask(requests, keys).

    A request is told by said (what is asked with), its prompt and its pixels. New answers are written before anything is
    made of them, then put in the place of older ones to the same keys.
    """
    spark = requests.sparkSession
    one = F.sha2(F.concat(F.coalesce(said, F.lit("")).cast("binary"), F.lit(b"\0"), F.col("prompt").cast("binary"), F.lit(b"\0"), "pixels"), 256)
    requests = requests.withColumn("request", one)
    answers = ask(requests, [*keys, "request"])
    known = read(spark, path, answers.schema).where("status = 'success'")
    fresh = requests.join(known.select(*keys, "request"), [*keys, "request"], "left_anti")
    replace(kept(ask(fresh, [*keys, "request"]), f"{path}_asked"), path, keys)
    return read(spark, path, answers.schema).join(requests.select(*keys, "request"), [*keys, "request"], "left_semi").drop("request")
