"""Joins by position: overlapping boxes of a page, and what was in force at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlaps(boxes: DataFrame, page: str = "page_id", key: str = "id", cell: int = 200, least_area: int = 1) -> DataFrame:
    """Pairs of a page's boxes(page, key, x, y, width, height) that overlap: page, a, b (a < b), x, y, width, height of what
    they share.

    A box lies in every cell of a grid that it touches, and boxes meet in cells, so a page is not squared. The home of a
    pair is the cell of its common part's upper left corner: there it is made, and in no other cell. Boxes without area, or
    with a null in their place, overlap with nothing; two boxes of one key are no pair.
    """
    b = boxes.where("width > 0 and height > 0 and x is not null and y is not null").select(F.col(page).alias("page"), F.col(key).alias("key"), "x", "y", (F.col("x") + F.col("width")).alias("r"), (F.col("y") + F.col("height")).alias("d"))
    to = lambda v: F.floor(v / cell)
    columns = F.sequence(to(F.col("x")), to(F.col("r") - 1))
    placed = b.withColumn("cx", F.explode(columns)).withColumn("cy", F.explode(F.sequence(to(F.col("y")), to(F.col("d") - 1))))
    one, two = placed.alias("a"), placed.alias("b")
    x, y = F.greatest("a.x", "b.x"), F.greatest("a.y", "b.y")
    w, h = F.least("a.r", "b.r") - x, F.least("a.d", "b.d") - y
    same_cell = (F.col("a.page") == F.col("b.page")) & (F.col("a.cx") == F.col("b.cx")) & (F.col("a.cy") == F.col("b.cy"))
    pair = (F.col("a.key") < F.col("b.key")) & (w > 0) & (h > 0) & (w * h >= least_area) & (to(x) == F.col("a.cx")) & (to(y) == F.col("a.cy"))
    return one.join(two, same_cell & pair).select(F.col("a.page").alias(page), F.col("a.key").alias("a"), F.col("b.key").alias("b"), x.alias("x"), y.alias("y"), w.alias("width"), h.alias("height"))


#: Cuts of a key's times: a key with more rows than HOT is dealt out by them.
CUTS, HOT = 64, 100_000


def as_of(left: DataFrame, right: DataFrame, by: str, ts: str, values: list[str], hot: int = HOT) -> DataFrame:
    """left with the values of the last row of right that has the same key and is not later; null where there is none.

    Both sides are one stream in order of time, and a row sees the last of right before it. Of several rows of right at
    one time the one of the greatest values counts. A key with more than `hot` rows is cut at quantiles of its times; each
    piece hands its last row of right on, so that no task sees more than a piece. Rows without a key or a time find
    nothing; other columns of left stay, and one named like a value gives its place to it.
    """
    kept = [c for c in left.columns if c not in values]
    now = F.struct(*[F.col(v) for v in values])
    one = left.select(F.col(by).alias("_by"), F.col(ts).alias("_ts"), F.lit(1).alias("_side"), F.struct(*kept).alias("_row"), F.lit(None).cast(right.select(now.alias("v")).schema["v"].dataType).alias("_value"))
    two = right.where(F.col(by).isNotNull() & F.col(ts).isNotNull()).select(F.col(by).alias("_by"), F.col(ts).alias("_ts"), F.lit(0).alias("_side"), F.lit(None).cast(one.schema["_row"].dataType).alias("_row"), now.alias("_value"))
    both = one.unionByName(two)
    micros = F.unix_micros(F.col("_ts").cast("timestamp"))
    shares = F.array(*[F.lit(i / CUTS) for i in range(1, CUTS)])
    sizes = both.where("_by is not null").groupBy("_by").agg(F.count("*").alias("_n"), F.percentile_approx(micros, shares, F.lit(10 * CUTS)).alias("_cuts")).where(F.col("_n") > hot).select("_by", "_cuts")
    both = both.join(sizes, "_by", "left").withColumn("_piece", F.coalesce(F.size(F.filter("_cuts", lambda c: c <= micros)), F.lit(0))).drop("_cuts")
    piece = Window.partitionBy("_by", "_piece").orderBy("_ts", "_side", "_value").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("_own", F.last("_value", ignorenulls=True).over(piece))
    ends = both.where("_side = 0").groupBy("_by", "_piece").agg(F.max(F.struct("_ts", "_value")).alias("_end"))
    after = Window.partitionBy("_by").orderBy("_piece").rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.join(sizes.select("_by"), "_by", "left_semi").withColumn("_end", F.max("_end").over(after))
    # A piece takes the last end before it: pieces without a row of right have none of their own.
    steps = ends.groupBy("_by").agg(F.array_sort(F.collect_list(F.struct("_piece", "_end"))).alias("_ends"))  # at most CUTS each
    found = seen.where("_side = 1").join(steps, "_by", "left")
    earlier = F.element_at(F.filter("_ends", lambda e: e["_piece"] < F.col("_piece")), -1)["_end"]["_value"]
    value: Column = F.when(F.col("_by").isNotNull() & F.col("_ts").isNotNull(), F.coalesce("_own", F.when(F.size(F.filter("_ends", lambda e: e["_piece"] < F.col("_piece"))) > 0, earlier)))
    return found.select("_row.*", *[value[v].alias(v) for v in values])
