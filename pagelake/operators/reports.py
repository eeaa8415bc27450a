"""Reports of a run in one pass: grouping sets, and sketches that are kept for each run and merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_sets(rows: DataFrame, sets: list[list[str]], aggregates: dict[str, Column]) -> DataFrame:
    """A row for each group of each of the sets: all columns of the sets (null where a set has not got them), `grouping`
    (a bit for each column that is not in the set, the first highest) and the aggregates. One pass over rows."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    out = rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns])
    return out.agg(F.grouping_id(*columns).cast("long").alias("grouping"), *[v.alias(k) for k, v in aggregates.items()])


def sketched(rows: DataFrame, keys: list[str], distinct: str, number: str, lg_k: int = 12, k: int = 200) -> DataFrame:
    """For each key n, and sketches that take up a few kilobytes whatever n is: of the distinct values of one column and of
    the quantiles of another (a whole number). Nulls are in neither."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.hll_sketch_agg(distinct, lg_k).alias("distinct_sketch"), F.kll_sketch_agg_bigint(number, k).alias("number_sketch"))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of parts (earlier runs, days, pages) as one of their union for each key."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_bigint("number_sketch").alias("number_sketch"))


def estimated(sketches: DataFrame, shares: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
    """The sketches' numbers: distinct values, and the quantiles as q50, q90, q99."""
    quantiles = [F.kll_sketch_get_quantile_bigint("number_sketch", F.lit(s)).alias(f"q{round(100 * s)}") for s in shares]
    rest = [c for c in sketches.columns if not c.endswith("_sketch")]
    return sketches.select(*rest, F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"), *quantiles)
