"""Joins by position, grouping sets, sketches and the SQL catalog on small and odd rows, against brute force."""

import random

from pyspark.sql import functions as F

from pagelake.functions import catalog
from pagelake.functions import text as T
from pagelake.operators import joins, reports


def test_overlaps_against_all_pairs(spark):
    rng = random.Random(3)
    rows = [(rng.choice("pq"), f"r{i:03d}", rng.randrange(-300, 1200), rng.randrange(0, 1200), rng.choice([0, 1, 60, 500]), rng.choice([1, 90, 700])) for i in range(120)]
    rows += [("p", "none", None, 1, 5, 5), (None, "x", 0, 0, 9, 9), ("p", "r000", 5, 5, 900, 900)]
    df = spark.createDataFrame(rows, "page_id string, id string, x int, y int, width int, height int").repartition(3)
    want = []
    for a in rows:
        for b in rows:
            if a[0] == b[0] and a[0] and a[1] < b[1] and None not in a + b:
                x, y = max(a[2], b[2]), max(a[3], b[3])
                w, h = min(a[2] + a[4], b[2] + b[4]) - x, min(a[3] + a[5], b[3] + b[5]) - y
                if w > 0 and h > 0 and a[4] > 0 and b[4] > 0:
                    want.append((a[0], a[1], b[1], x, y, w, h))
    for cell in (37, 200, 5000):
        assert sorted(map(tuple, joins.overlaps(df, cell=cell).collect())) == sorted(want)
    big = joins.overlaps(df, least_area=20_000)
    assert sorted(map(tuple, big.collect())) == sorted(r for r in want if r[5] * r[6] >= 20_000)
    assert joins.overlaps(df.limit(0)).count() == 0


def test_as_of_with_hot_keys_ties_and_nulls(spark):
    rng = random.Random(5)
    left = [(i, rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([None] + list(range(200)) * 2), "old") for i in range(500)]
    right = [(rng.choice(["hot", "hot", "a", "c", None]), rng.choice([None] + list(range(30, 200, 7)) * 3), rng.choice([None, 1, 2, 3])) for _ in range(90)]
    stamp = lambda df: df.withColumn("ts", F.timestamp_seconds("ts"))
    a = stamp(spark.createDataFrame(left, "id int, k string, ts long, level string")).repartition(3)
    b = stamp(spark.createDataFrame(right, "k string, ts long, level int"))
    want = {}
    for i, k, t, _ in left:
        there = [(r[1], -1 if r[2] is None else r[2], r[2]) for r in right if k and t is not None and r[0] == k and r[1] is not None and r[1] <= t]
        want[i] = max(there)[2] if there else None
    for hot in (0, 50, 10**6):
        out = joins.as_of(a, b, "k", "ts", ["level"], hot=hot)
        assert out.columns == ["id", "k", "ts", "level"]
        rows = out.collect()
        assert len(rows) == len(left) and {r.id: r.level for r in rows} == want
    assert joins.as_of(a.limit(0), b, "k", "ts", ["level"]).count() == 0 and {r.level for r in joins.as_of(a, b.limit(0), "k", "ts", ["level"]).collect()} == {None}


def test_grouping_sets(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3), (None, "x", 4)], "k string, s string, v int")
    got = {(r.k, r.s, r.grouping): (r.n, r.total, r.kinds) for r in reports.by_sets(df, [["k", "s"], ["s"], []], {"n": F.count("*"), "total": F.sum("v"), "kinds": F.count_distinct("k")}).collect()}
    assert got[None, None, 3] == (4, 10, 2) and got[None, "x", 2] == (3, 8, 2) and got["b", "x", 0] == (1, 3, 1) and got[None, "x", 0] == (1, 4, 0) and len(got) == 7


def test_sketches_of_parts_are_the_sketch_of_all(spark):
    df = spark.range(20_000).select((F.col("id") % 7).alias("run"), (F.col("id") * 7919 % 3000).alias("page"), (F.col("id") * 104729 % 10_007).alias("size"))
    runs = reports.sketched(df, ["run"], "page", "size")
    one = reports.estimated(reports.merged(runs, [])).first()
    assert one.n == 20_000 and abs(one.n_distinct - 3000) < 0.05 * 3000
    exact = sorted(r.size for r in df.collect())
    for q, share in ((one.q50, 0.5), (one.q90, 0.9), (one.q99, 0.99)):
        assert abs(sum(v <= q for v in exact) / len(exact) - share) < 0.02
    none = reports.estimated(reports.sketched(df.withColumn("page", F.lit(None).cast("long")).where("run = 1"), ["run"], "page", "size")).first()
    assert none.n_distinct == 0 and none.n > 0 and reports.merged(runs.limit(0), ["run"]).count() == 0


def test_functions_of_sql_are_those_of_columns(spark):
    catalog.register(spark)
    names = ["s_2.PNG", "S_10.b.tif", "a/b.jpg", "007x8.webp", "", ".png"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    df.createOrReplaceTempView("some_names")
    got = spark.sql("SELECT name, page_natural_key(name) AS k, page_stem(name) AS s, page_mime(name) AS m FROM some_names")
    want = df.select("name", T.natural_key(F.col("name")).alias("k"), T.stem_of(F.col("name")).alias("s"), T.mime_of(T.suffix_of(F.col("name"))).alias("m"))
    assert got.collect() == want.collect()
    rows = spark.sql("""SELECT pos, region_type, reading_order FROM VALUES ('{"regions": [{"type": "A", "reading_order": 2}, {}]}'), ('no'), (NULL) AS t(a), LATERAL page_regions(a)""")
    assert sorted(map(tuple, rows.collect()), key=str) == [(0, "A", 2), (1, None, None)]
