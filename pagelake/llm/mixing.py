"""Mixing sources to target weights by iterative proportional fitting, with DataFrame operations only.

Token masses are summed per cell (source, language, topic), with map-side combination, so a hot source is a handful of
rows. Rounds of raking then scale the cells until the three marginals meet their targets; a cell never gets more of the
budget than its own mass, so what the limit takes from one cell the next steps give to others, and the expected sample
itself meets the targets. Targets are made reachable first: no value is asked for more than CEILING of what it has. A
document's probability is its cell's calibrated share of the budget over the cell's mass; it is sampled by a hash of its
id, so a rerun or a lost executor changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import col, materialize, sealed, unsealed

DIMS = ("source", "lang", "topic")
WORD = "[^\\x20\\x09-\\x0D]+"
#: Without given targets, a marginal's target is its own mass to this power.
TEMPER = 0.7
#: The most rounds of raking; each fits all three marginals in turn. They end early where no marginal is off by NEAR of its target.
ROUNDS, NEAR = 12, 1e-9
#: The largest share of its own mass that a value may be asked for (more where the budget itself is).
CEILING = 0.9
#: How often the SQL form makes targets reachable anew; the loop here ends by itself.
PASSES = 8


def topic_of(text: Column, tokens: Column) -> Column:
    """What a text looks like; the first rule that fits decides."""
    return (
        F.when(text.rlike("[A-Za-z0-9]@[A-Za-z0-9-]+[.]"), "contact")
        .when(text.contains("icensed under"), "license")
        .when(text.contains(" | "), "tabular")
        .when(tokens < 100, "brief")
        .when(tokens >= 1000, "long")
        .otherwise("prose")
    )


def reachable(cells: DataFrame, goals: DataFrame, budget: float) -> DataFrame:
    """Targets (dim, value, goal) under which no value needs more than the ceiling's share of its mass.

    Values over that get it; the others share the rest as before, until none is over. Values that are not in cells, or
    whose goal is not above zero, drop out; the dimensions are then scaled to the least of their sums, so that all can be met.
    """
    most = max(CEILING, (1 + budget) / 2) / budget
    total = cells.agg(F.sum("mass")).first()[0] or 1.0
    mass = None
    for dim in DIMS:
        one = cells.groupBy(F.lit(dim).alias("dim"), F.col(dim).alias("value")).agg((F.sum("mass") / total * most).alias("most"))
        mass = one if mass is None else mass.unionByName(one)
    now = goals.where("goal > 0").join(mass, ["dim", "value"]).select("dim", "value", "goal", "most", F.lit(False).alias("full"))
    n_full = 0
    while True:
        left = now.groupBy("dim").agg((1 - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0))).alias("left"), F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("goal"))).alias("open"))
        scaled = F.when(F.col("full"), F.col("most")).otherwise(F.col("goal") * F.greatest("left", F.lit(0.0)) / F.col("open"))
        now = now.join(left, "dim").withColumn("now", scaled).drop("left", "open").withColumn("full", F.col("full") | (F.col("now") >= F.col("most")))
        now = materialize(now, "mixing-goals")
        if (n := now.where("full").count()) == n_full:
            break
        n_full, now = n, now.drop("now")
    sums = now.groupBy("dim").agg(F.sum("now").alias("s"))
    least = sums.agg(F.min("s")).first()[0] or 1.0
    return materialize(now.join(sums, "dim").select("dim", "value", (F.col("now") / F.col("s") * min(1.0, least)).alias("goal")), "mixing-reachable")


def rake(cells: DataFrame, goals: DataFrame, budget: float, rounds: int = ROUNDS) -> DataFrame:
    """(source, lang, topic, mass, share): cells(source, lang, topic, mass) raked to reachable goals(dim, value, goal).

    A step scales the cells of each value of one dimension by goal / sum, but none over its mass's share of the budget;
    cells are written after each step, so plans stay small. Values without a goal get nothing; a dimension without goals is left alone.
    """
    total = cells.agg(F.sum("mass")).first()[0] or 1.0
    dims = [r.dim for r in goals.select("dim").distinct().collect()]
    now = cells.withColumn("share", F.col("mass") / total)
    for dim in dims:
        own = goals.where(F.col("dim") == dim).select(F.col("value").alias(dim), F.col("goal").alias(f"goal_{dim}"))
        now = now.join(own, dim, "left")
    for k in range(rounds):
        for dim in (d for d in DIMS if d in dims):
            held = now.groupBy(dim).agg(F.nullif(F.sum("share"), F.lit(0.0)).alias("held"))
            scaled = F.coalesce(F.col("share") * F.col(f"goal_{dim}") / F.col("held"), F.lit(0.0))
            last, now = now, now.join(held, dim).select(*cells.columns, *[f"goal_{d}" for d in dims], F.least(scaled, F.col("mass") / (total * budget)).alias("share"))
            now = materialize(now, "mixing-rake", last)
        if k % 4 == 3 and (residual(now, goals).agg(F.max("off")).first()[0] or 0.0) <= NEAR:
            break
    return now


def residual(fitted: DataFrame, goals: DataFrame) -> DataFrame:
    """(dim, value, goal, share, off): how far each marginal of raked cells is from its goal, as a share of the goal."""
    held = None
    for dim in DIMS:
        one = fitted.groupBy(F.lit(dim).alias("dim"), F.col(dim).alias("value")).agg(F.sum("share").alias("share"))
        held = one if held is None else held.unionByName(one)
    return goals.join(held, ["dim", "value"]).select("dim", "value", "goal", "share", F.abs(F.col("share") / F.col("goal") - 1).alias("off"))


def tempered(cells: DataFrame, power: float = TEMPER) -> DataFrame:
    """Targets (dim, value, goal): each marginal's mass to a power, as a share."""
    out = None
    for dim in DIMS:
        mass = cells.groupBy(F.lit(dim).alias("dim"), F.col(dim).alias("value")).agg(F.pow(F.sum("mass"), F.lit(power)).alias("p"))
        out = mass if out is None else out.unionByName(mass)
    return shares(out)


def shares(parts: DataFrame) -> DataFrame:
    """(dim, value, goal): parts(dim, value, p) as shares of their dimension; rows that repeat a value add up."""
    parts = parts.where("p > 0").groupBy("dim", F.coalesce("value", F.lit("")).alias("value")).agg(F.sum("p").alias("p"))
    total = parts.groupBy("dim").agg(F.sum("p").alias("total"))
    return parts.join(total, "dim").select("dim", "value", (F.col("p") / F.col("total")).alias("goal"))


def mix_sources(docs: DataFrame, targets: DataFrame | None = None, budget: float = 0.6, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic: Column | None = None, power: float = TEMPER) -> DataFrame:
    """docs with topic, n_tokens, weight, probability and kept.

    n_tokens counts words between ASCII white space; a text counts with at least one, so an empty or null text still
    belongs to a cell; long texts are counted whole. A null source, language or topic counts as ''. targets(dim, value,
    share) are scaled to sum to one in each dimension, rows that repeat a value add up, and shares that are not above zero
    count not at all; a value without one is dropped, a dimension without any is left alone. weight is a cell's calibrated
    mass over its mass, and probability = budget * weight, at most 1: the expected sample meets the targets as far as they
    can be reached (see reachable; residual() says how far off raked cells are). Rows that repeat an id share its draw; a
    null id draws as ''. An empty table gives an empty table. Input columns with the names of outputs give way to them.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    tokens = F.regexp_count(text, F.lit(WORD)).cast("long")
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    rows = sealed(docs, id=col(id_col), source=blank(col(source_col)), lang=blank(col(lang_col)), n_tokens=tokens, text=text)
    rows = rows.withColumn("topic", blank(topic_of(F.col("text"), F.col("n_tokens")) if topic is None else topic)).drop("text")
    cells = rows.groupBy(*DIMS).agg(F.sum(F.greatest("n_tokens", F.lit(1))).cast("double").alias("mass"))
    cells = materialize(cells, "mixing-cells")
    goals = tempered(cells, power) if targets is None else shares(targets.select("dim", "value", F.col("share").cast("double").alias("p")))
    total = cells.agg(F.sum("mass")).first()[0] or 1.0
    fitted = rake(cells, reachable(cells, goals, budget), budget)
    weights = materialize(fitted.select(*DIMS, (F.col("share") * total / F.col("mass")).alias("weight")), "mixing-weights")
    out = rows.join(weights, list(DIMS), "left").withColumn("probability", F.least(F.lit(1.0), budget * F.coalesce("weight", F.lit(0.0))))
    draw = F.conv(F.substring(F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0
    return unsealed(out, docs.columns, topic=F.col("topic"), n_tokens=F.col("n_tokens"), weight=F.coalesce("weight", F.lit(0.0)), probability=F.col("probability"), kept=draw < F.col("probability"))


def oracle(budget: float = 0.6, power: float = TEMPER, rounds: int = ROUNDS) -> str:
    """The same for the table documents in DuckDB, with the rounds written out."""
    steps = [
        f"""d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
            len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents)""",
        """t AS (SELECT doc_id, source, lang, n_tokens, CASE WHEN regexp_matches(text, '[A-Za-z0-9]@[A-Za-z0-9-]+[.]') THEN 'contact'
            WHEN contains(text, 'icensed under') THEN 'license' WHEN contains(text, ' | ') THEN 'tabular'
            WHEN n_tokens < 100 THEN 'brief' WHEN n_tokens >= 1000 THEN 'long' ELSE 'prose' END AS topic FROM d)""",
        "c AS MATERIALIZED (SELECT source, lang, topic, sum(greatest(n_tokens, 1))::DOUBLE AS mass FROM t GROUP BY ALL)",
        "s0 AS MATERIALIZED (SELECT *, mass / (SELECT sum(mass) FROM c) AS share FROM c)",
    ]
    most = max(CEILING, (1 + budget) / 2) / budget
    for dim in DIMS:
        own = f"SELECT {dim}, pow(sum(mass), {power}) AS p, sum(mass) / (SELECT sum(mass) FROM c) * {most} AS most, false AS sat FROM c GROUP BY ALL"
        for k in range(PASSES):
            scaled = "CASE WHEN sat THEN most ELSE goal * greatest(0, 1 - sum(CASE WHEN sat THEN most ELSE 0 END) OVER ()) / nullif(sum(CASE WHEN sat THEN 0 ELSE goal END) OVER (), 0) END"
            own = f"SELECT {dim}, goal, most, (sat OR now >= most) AS sat, now FROM (SELECT {dim}, goal, most, sat, {scaled} AS now FROM ({own if k else f'SELECT *, p / sum(p) OVER () AS goal FROM ({own})'}))"
        steps.append(f"g_{dim} AS MATERIALIZED (SELECT {dim}, now / sum(now) OVER () AS goal FROM ({own}))")
    n = 0
    for _ in range(rounds):
        for dim in DIMS:
            n += 1
            steps.append(f"s{n} AS MATERIALIZED (SELECT source, lang, topic, mass, least(share * goal / sum(share) OVER (PARTITION BY {dim}), mass / ((SELECT sum(mass) FROM c) * {budget})) AS share FROM s{n - 1} JOIN g_{dim} USING ({dim}))")
    return (
        "WITH " + ",\n".join(steps) + f""", w AS (SELECT source, lang, topic, share * (SELECT sum(mass) FROM c) / mass AS weight FROM s{n})
        SELECT doc_id, source, lang, topic, n_tokens::BIGINT AS n_tokens, round(weight, 6) AS weight, round(least(1.0, {budget} * weight), 6) AS probability,
            ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 < least(1.0, {budget} * weight) AS kept
        FROM t JOIN w USING (source, lang, topic)"""
    )
