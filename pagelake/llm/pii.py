"""Personal data: patterns, then information-theoretic sanitisation, with DataFrame functions only.

Patterns find protected values (email, ip, card, phone). Terms are runs of letters. From the whole corpus come the numbers
of documents that hold a value, that hold a term, and that hold both, the term outside of protected spans. Pointwise mutual
information over the value's own information content is the share of the value that the term discloses: 1 if the term
occurs only with the value, 0 if they are independent. Terms that disclose too much get spans of their own wherever they
occur, in documents without the value too, and are removed or generalised.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import col, materialize, sealed, unsealed

#: kind: what a document must hold at all, the pattern. The patterns find what the plain ones of the contract find, and
#: start a match only where a run starts, so that long runs take time in proportion to their length.
PATTERNS = {
    "email": ("@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (".", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (None, r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}(?![0-9])(?![\x20-][0-9])"),
    "phone": ("+", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
KINDS = list(PATTERNS)
REMOVE, GENERALISE = "remove", "generalise"
TERM = r"\p{L}++"
_SPAN = "array<struct<s:int,e:int,v:string>>"


#: Matches are laid end to end in parts of so many, so that a text with many takes time in proportion to them.
PART = 256


def spans(text: Column, pattern: str | Column) -> Column:
    """Start, end (in code points) and value of each match, from the matches and the gaps between them."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("v"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(x["gap"])
        e = s + F.length(x["v"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["v"].alias("v")))).alias("out"))

    def join(acc: Column, part: Column) -> Column:
        moved = F.transform(part["out"], lambda x: F.struct((x["s"] + acc["at"]).alias("s"), (x["e"] + acc["at"]).alias("e"), x["v"].alias("v")))
        return F.struct((acc["at"] + part["at"]).alias("at"), F.concat(acc["out"], moved).alias("out"))

    few = F.aggregate(pairs, start, step)["out"]
    parts = F.transform(F.sequence(F.lit(0), F.size(pairs) - 1, F.lit(PART)), lambda i: F.aggregate(F.slice(pairs, i + 1, F.lit(PART)), start, step))
    return F.when(F.size(pairs) <= PART, few).otherwise(F.aggregate(parts, start, join)["out"])


def luhn(digits: Column) -> Column:
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def valid(kind: str, v: Column) -> Column:
    digits = F.regexp_replace(v, "[^0-9]", "")
    part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
    return {
        "email": F.lit(True),
        "ip": v.rlike(f"^{part}(?:[.]{part}){{3}}$"),
        "card": F.length(digits).between(12, 19) & luhn(digits),
        "phone": F.length(digits).between(9, 15),
    }[kind]


def base_spans(text: Column) -> Column:
    """All valid matches as structs (s, k, e, v, kind), by start and then by kind as listed."""

    def of_kind(k: int, kind: str) -> Column:
        sign, pattern = PATTERNS[kind]
        may = text.contains(sign) if sign and kind != "ip" else text.rlike("[0-9][.][0-9]+[.][0-9]" if kind == "ip" else "[0-9](?:[\\x20-]?[0-9]){11}")
        found = F.when(may, spans(text, pattern)).otherwise(F.array().cast(_SPAN))
        found = F.filter(found, lambda x: valid(kind, x["v"]))
        return F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), x["v"].alias("v"), F.lit(kind).alias("kind")))

    return F.array_sort(F.concat(*[of_kind(k, kind) for k, kind in enumerate(KINDS)]))


def count_of(kind: str, found: str = "base") -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")


def written(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def _forms(text: Column) -> Column:
    """The distinct terms of a text as they are written."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(_forms(text), F.lower))


def _marked(text: Column, base: Column, levels: Column) -> Column:
    """Every occurrence of a form in levels (form: level), none inside a protected span.

    They are looked for in the text with its protected spans blanked out, length for length, so no occurrence has to be
    compared with every span.
    """
    pattern = F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join(F.map_keys(levels), "|"), F.lit(r")(?!\p{L})"))
    level = lambda t: F.element_at(levels, t["v"])
    return F.transform(spans(_blanked(text, base), pattern), lambda t: F.struct(t["s"].alias("s"), (F.lit(len(KINDS)) + 2 - level(t)).alias("k"), t["e"].alias("e"), F.lower(t["v"]).alias("v"), F.when(level(t) == 2, REMOVE).otherwise(GENERALISE).alias("kind")))


def _blanked(text: Column, base: Column) -> Column:
    """The text with a mark that is no letter in place of each code point of a protected span."""
    return sanitised(text, base, lambda acc, x: F.repeat(F.lit("#"), x["e"] - F.greatest(x["s"], acc["at"])))


def entity(x: Column) -> Column:
    """What names one protected value however it is written."""
    value = F.when(x["kind"].isin("card", "phone"), F.regexp_replace(x["v"], "[^0-9]", "")).otherwise(F.lower(x["v"]))
    return F.concat_ws(":", x["kind"], value)


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove: float = 0.95, generalise: float = 0.85, support: int = 2) -> DataFrame:
    """docs with base and spans (arrays of structs s, k, e, v, kind) and sanitised, the text without what they mark.

    base holds the valid pattern matches; spans holds them and all occurrences of the terms (kinds remove and generalise)
    that disclose at least that share of a value, both in at least `support` documents together. Values become [KIND],
    removed terms [TERM], generalised ones their first letter and an ellipsis. A null text is empty. Equal texts are one
    document in all counts, whatever their ids, and get the same spans: copies and repeated rows change none. Terms of any
    length are judged, in the scripts that write words apart and in those that do not, where a run of letters is a term.
    Long texts are judged whole. Empty tables give empty tables. Input columns named base, spans or sanitised give way to the operator's.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    none = F.array().cast("array<struct<s:int,k:int,e:int,v:string,kind:string>>")
    each = docs.select(col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    each = each.withColumn("base", F.when(F.col("text").rlike("[@0-9]"), base_spans(F.col("text"))).otherwise(none))
    # Equal texts count once, whatever their ids: in every number below a document is a distinct text. A text that n rows
    # hold weighs 1 / n in each; only the hashes of such texts are gathered.
    repeats = each.select("th").groupBy("th").agg(F.count("*").alias("n_rows")).where("n_rows > 1")
    repeats = materialize(repeats, "pii-repeats")
    more = repeats.agg(F.sum(F.col("n_rows") - 1)).first()[0] or 0
    n_docs = docs.count() - more
    terms = _terms(_blanked(F.col("text"), F.col("base")))
    found = each.where(F.size("base") > 0).select("th", F.array_distinct(F.transform("base", entity)).alias("entities"), terms.alias("terms"))
    found = materialize(found.dropDuplicates(["th"]), "pii-found")
    value = found.select("terms", F.explode("entities").alias("entity"))
    holds = materialize(value.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= support), "pii-values")
    # Counted by pair, so a term that all documents hold is no more than one row for each value.
    pairs = value.join(holds.select("entity"), "entity", "left_semi").select("entity", F.explode("terms").alias("term"))
    pairs = materialize(pairs.groupBy("entity", "term").agg(F.count("*").alias("n_both")).where(F.col("n_both") >= support), "pii-pairs", found)
    # Written before the join: else the filter to candidate terms moves below the count and every word is shuffled.
    weighed = each.join(repeats, "th", "left").select((1 / F.coalesce("n_rows", F.lit(1))).alias("weight"), F.explode(terms).alias("term"))
    held = materialize(weighed.groupBy("term").agg(F.round(F.sum("weight")).alias("n_term")), "pii-terms")
    pairs = pairs.join(holds, "entity").join(held, "term")
    own = F.log2(F.lit(float(max(1, n_docs))) / F.col("n_entity"))
    share = F.when(own > 0, F.log2(F.col("n_both") * F.lit(float(n_docs)) / (F.col("n_term") * F.col("n_entity"))) / own).otherwise(0.0)
    level = F.max(F.when(share >= remove, 2).when(share >= generalise, 1))
    flagged = materialize(pairs.groupBy("term").agg(level.alias("level")).where("level is not null"), "pii-flagged", held)
    forms = each.select("id", "th", F.explode(_forms(F.col("text"))).alias("form")).withColumn("term", F.lower("form"))
    marks = forms.join(flagged, "term").groupBy("id", "th").agg(F.map_from_entries(F.collect_set(F.struct("form", "level"))).alias("levels"))
    marks = materialize(marks, "pii-marks")
    known = marks.select(F.col("id").alias("known_id"), F.col("th").alias("known_th"), "levels")
    rows = sealed(docs, id=col(id_col), th=F.xxhash64(text), text=text)
    # Rows with marks grow with the table: a merge at every size, not a broadcast as long as they happen to be few.
    rows = rows.join(known.hint("merge"), F.col("id").eqNullSafe(F.col("known_id")) & (F.col("th") == F.col("known_th")), "left")
    rows = rows.withColumn("base", F.when(F.col("text").rlike("[@0-9]"), base_spans(F.col("text"))).otherwise(none))
    marked = F.when(F.col("levels").isNotNull(), _marked(F.col("text"), F.col("base"), F.col("levels"))).otherwise(none)
    rows = rows.withColumn("spans", F.array_sort(F.concat("base", marked)))
    return unsealed(rows, docs.columns, base=F.col("base"), spans=F.col("spans"), sanitised=sanitised(F.col("text"), F.col("spans")))


def sanitised(text: Column, found: Column, by: Callable[[Column, Column], Column] | None = None) -> Column:
    """The text with each span replaced, by by(state, span) if given; what overlaps an earlier span is part of its
    replacement (or, with by, adds what goes beyond)."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        new = by(acc, x) if by else F.when(x["kind"] == REMOVE, "[TERM]").when(x["kind"] == GENERALISE, F.concat(F.substring(x["v"], 1, 1), F.lit("…"))).otherwise(F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
        fresh = F.concat(acc["out"], F.array(F.concat(F.substring(text, acc["at"] + 1, F.greatest(x["s"] - acc["at"], F.lit(0))), new)))
        take = x["e"] > acc["at"] if by else x["s"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.when(take, fresh).otherwise(acc["out"]).alias("out"))

    return F.when(F.size(found) == 0, text).otherwise(F.aggregate(found, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text)))))


def oracle(remove: float = 0.95, generalise: float = 0.85, support: int = 2) -> str:
    """The same for the table documents in DuckDB, with the contract's plain patterns."""
    plain = {
        "email": "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+",
        "ip": "[0-9]+([.][0-9]+)([.][0-9]+)([.][0-9]+)",
        "card": "[0-9]([ -]?[0-9])+",
        "phone": "[+][0-9][ ().0-9-]+[0-9]",
    }
    part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
    fine = {
        "email": "true",
        "ip": f"regexp_full_match(v, '{part}([.]{part}){{3}}')",
        "card": "length(n) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(n) + 1), lambda i: CASE WHEN i % 2 = 1 THEN substr(reverse(n), i, 1)::INT WHEN substr(reverse(n), i, 1)::INT > 4 THEN substr(reverse(n), i, 1)::INT * 2 - 9 ELSE substr(reverse(n), i, 1)::INT * 2 END)) % 10 = 0",
        "phone": "length(n) BETWEEN 9 AND 15",
    }

    def matches(source: str, text: str, pattern: str) -> str:
        """Rows (source's th, v, e) of all matches, e the end in code points."""
        return f"""SELECT th, v, sum(length(v) + length(gap)) OVER (PARTITION BY th ORDER BY i) AS e FROM (
            SELECT th, unnest(m) AS v, unnest(g[1:len(m)]) AS gap, generate_subscripts(m, 1) AS i FROM (SELECT th, regexp_extract_all({text}, '{pattern}') AS m, string_split_regex({text}, '{pattern}') AS g FROM {source}))"""

    kinds = " UNION ALL ".join(f"SELECT th, (e - length(v))::INT AS s, {k} AS k, e::INT AS e, v, '{kind}' AS kind FROM (SELECT *, regexp_replace(v, '[^0-9]', '', 'g') AS n FROM ({matches('t', 'text', p)})) WHERE {fine[kind]}" for k, (kind, p) in enumerate(plain.items()))
    counts = ", ".join(f"count_if(kind = '{k}')::BIGINT AS n_{k}" for k in KINDS)
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS th FROM documents),
    t AS MATERIALIZED (SELECT th, any_value(text) AS text FROM d GROUP BY th),
    base AS MATERIALIZED ({kinds}),
    ch AS (SELECT th, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) - 1 AS i FROM t SEMI JOIN base USING (th)),
    hit AS (SELECT DISTINCT th, unnest(range(s, e)) AS i FROM base),
    bl AS MATERIALIZED (SELECT th, string_agg(CASE WHEN hit.i IS NULL THEN c ELSE '#' END, '' ORDER BY ch.i) AS text FROM ch LEFT JOIN hit USING (th, i) GROUP BY th),
    bt AS MATERIALIZED (SELECT th, coalesce(bl.text, t.text) AS text FROM t LEFT JOIN bl USING (th)),
    en AS (SELECT DISTINCT th, kind || ':' || CASE WHEN kind IN ('card', 'phone') THEN regexp_replace(v, '[^0-9]', '', 'g') ELSE lower(v) END AS entity FROM base),
    tm AS MATERIALIZED (SELECT DISTINCT th, lower(unnest(regexp_extract_all(text, '\\p{{L}}+'))) AS term FROM bt),
    ne AS (SELECT entity, count(*) AS n_entity FROM en GROUP BY entity HAVING count(*) >= {support}),
    nt AS (SELECT term, count(*) AS n_term FROM tm GROUP BY term),
    nb AS (SELECT entity, term, count(*) AS n_both FROM en JOIN ne USING (entity) JOIN tm USING (th) GROUP BY entity, term HAVING count(*) >= {support}),
    nd AS (SELECT count(*)::DOUBLE AS n_docs FROM t),
    sh AS (SELECT term, CASE WHEN n_docs > n_entity THEN log2(n_both * n_docs / (n_term * n_entity)) / log2(n_docs / n_entity) ELSE 0 END AS share FROM nb JOIN ne USING (entity) JOIN nt USING (term), nd),
    fl AS (SELECT term, CASE WHEN max(share) >= {remove} THEN 2 ELSE 1 END AS level FROM sh GROUP BY term HAVING max(share) >= {generalise}),
    al AS (SELECT th, s, k, e, v, kind FROM base UNION ALL
        SELECT w.th, (e - length(v))::INT, 6 - level, e::INT, lower(v), CASE WHEN level = 2 THEN 'remove' ELSE 'generalise' END FROM ({matches('bt', 'text', '\\p{L}+')}) AS w JOIN fl ON term = lower(v) JOIN t USING (th) WHERE list_contains(regexp_extract_all(t.text, '\\p{{L}}+'), v)),
    ag AS (SELECT th, {counts}, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 4) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans FROM al GROUP BY th)
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in KINDS)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN ag USING (th)"""
