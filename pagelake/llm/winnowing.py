"""Document fingerprints by winnowing, with DataFrame functions only.

A token is a word of at most WORD characters, or one code point of a longer run, so that texts without blanks have tokens
too and none depends on where its run began. Every run of GRAM tokens gives one hash; of every window of WINDOW such hashes
the least is chosen, the rightmost among equals, and kept with its position. Any passage of GRAM + WINDOW - 1 tokens that
two texts share therefore leaves a common entry in both. (SQL has no scan over an array, so the hash of a run is not
carried on from the run before it but made from its GRAM token hashes, in constant time as well.)
A chosen entry is one number: 32 bits of hash, then the position counted down from 2^31, so that the least number is the
least hash at its rightmost place; no text has more tokens than that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelake.llm.common import col, hash_sample

GRAM = 5
WINDOW = 8
WORD = 32
TOKEN = f"(?<![^\\x20\\x09-\\x0D])[^\\x20\\x09-\\x0D]{{1,{WORD}}}(?![^\\x20\\x09-\\x0D])|[^\\x20\\x09-\\x0D]"
_BITS = 31
_LAST = (1 << _BITS) - 1
#: Rows are put in order in buckets of about this many bytes, up to the most buckets there may be.
BUCKET_BYTES, BUCKETS = 16 << 20, 1 << 16
_MASK = ((1 << 63) - 1) ^ _LAST


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """df with the chosen entries of a text column, in text order. Fewer tokens than GRAM are one run."""
    words = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    h, g = f"_{name}_h", f"_{name}_g"
    df = df.withColumn(h, F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size(h)
    at = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - GRAM, F.lit(0)))).otherwise(F.array().cast("array<int>"))

    def run(i: Column) -> Column:
        return F.xxhash64(*[F.get(F.col(h), i + j) for j in range(GRAM)]).bitwiseAND(F.lit(_MASK)).bitwiseOR(F.lit(_LAST).cast("long") - i)

    df = df.withColumn(g, F.transform(at, run))
    m = F.size(g)
    starts = F.when(m > 0, F.sequence(F.lit(0), F.greatest(m - WINDOW, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    least = F.transform(starts, lambda i: F.least(*[F.get(F.col(g), i + j) for j in range(WINDOW)]))
    return df.withColumn(name, F.array_distinct(least)).drop(h, g)


def written(entries: str) -> Column:
    """Entries as text: hash in hexadecimal @ position of the run, blank-separated."""
    return F.array_join(F.transform(entries, lambda v: F.concat(F.lpad(F.hex(F.shiftright(v, _BITS)), 8, "0"), F.lit("@"), (F.lit(_LAST) - v.bitwiseAND(F.lit(_LAST))).cast("string"))), " ")


def likeness(a: str, b: str) -> Column:
    """Common share of two fingerprints' hashes wherever they stand; two empty ones are alike."""
    x, y = (F.array_distinct(F.transform(c, lambda v: F.shiftright(v, _BITS))) for c in (a, b))
    both = F.size(F.array_intersect(x, y))
    union = F.size(x) + F.size(y) - both
    return F.when(union == 0, 1.0).otherwise(both / union)


def _bucket(bounds: list[tuple[int, int]]) -> Column:
    """How many of the ascending bounds (id, th) a row is not below, by halving steps."""
    if not bounds:
        return F.lit(0)
    ids, ths = (F.array(*[F.lit(x).cast("long") for x in part]) for part in zip(*bounds, strict=True))
    steps = F.array(*[F.lit(1 << k) for k in range(len(bounds).bit_length() - 1, -1, -1)])

    def step(at: Column, by: Column) -> Column:
        i, t = F.get(ids, at + by - 1), F.get(ths, at + by - 1)
        return F.when((i < F.col("id")) | ((i == F.col("id")) & (t <= F.col("th"))), at + by).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def _bounds(keys: DataFrame, buckets: int) -> list[tuple[int, int]]:
    """Bounds (id, th) that part keys into about that many buckets of like size: quantiles of a bounded sample."""
    most = max(10_000, 16 * buckets)
    few = hash_sample(keys, "id", keys.count(), most).agg(F.array_sort(F.collect_list(F.struct("id", "th"))).alias("keys"))
    at = [F.get("keys", F.floor(F.size("keys") * k / buckets).cast("int")) for k in range(1, buckets)]
    found = few.select(F.array_distinct(F.array(*at)).alias("b")).first().b if buckets > 1 else []
    return [(x.id, x.th) for x in found if x is not None]


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """docs(id, text, fp) with next_text and next_fp of the next id; the last is followed by the first.

    Rows are dealt into ranges of ids of like size, whatever the ids are, and put in order within a range. The first row of
    each range is also sent to the end of the range before it, so no row has to look further. Equal ids follow in the order
    of their texts' hashes. There are at most BUCKETS ranges, so what is known of them (three numbers each) is bounded; a
    range of a larger table is larger, and is sorted with spilling, never held.
    """
    docs = docs.withColumn("th", F.xxhash64("text"))
    there = docs.where("id is not null")
    if buckets is None:
        n_bytes = there.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = min(BUCKETS, n_bytes // BUCKET_BYTES + 1)
    bounds = _bounds(there.select("id", "th"), buckets)
    there = there.withColumn("home", _bucket(bounds))
    least = there.select("id", "th", "home").groupBy("home").agg(F.min(F.struct("id", "th")).alias("head")).collect()  # at most BUCKETS rows
    homes = sorted((r.home, r.head.id, r.head.th) for r in least)
    heads = [(i, t, homes[k - 1][0]) for k, (_, i, t) in enumerate(homes)]
    heads = docs.sparkSession.createDataFrame(heads, "head long, head_th long, before int")
    rows = there.join(F.broadcast(heads), (F.col("id") == F.col("head")) & (F.col("th") == F.col("head_th")), "left")
    places = F.array_compact(F.array(F.struct(F.col("home").alias("bucket"), F.lit(0).alias("guest")), F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("bucket"), F.lit(1).alias("guest")))))
    rows = rows.select("id", "th", "text", "fp", F.explode(places).alias("at"))
    along = Window.partitionBy("at.bucket").orderBy("at.guest", "id", "th")
    rows = rows.select("id", "text", "fp", "at.guest", F.lead("text").over(along).alias("next_text"), F.lead("fp").over(along).alias("next_fp"))
    return rows.where("guest = 0").drop("guest")


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, text, fp, edited, edited_fp, next_text, next_fp (fingerprints as arrays of entries).

    The edited text has its last quarter of code points replaced by the first as many (or all) of the next document in
    ascending order of the integer ids. A null text is empty and has an empty fingerprint. Rows with a null id follow no
    order: each is its own next; so is an id that is no integer, which counts as null. Repeated ids follow each other. Very
    long texts are fingerprinted whole. Empty tables give empty tables; other columns of the input play no part.
    """
    rows = docs.select(col(id_col).try_cast("long").alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    rows = with_fingerprint(rows, "text", "fp")
    alone = rows.where("id is null").select("id", "text", "fp", F.col("text").alias("next_text"), F.col("fp").alias("next_fp"))
    rows = with_next(rows).unionByName(alone)
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)))
    return with_fingerprint(rows, "edited", "edited_fp")
