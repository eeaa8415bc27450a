"""Line dedup with two Bloom filters.

Chunks of documents send the hashes of their line keys to segments of the hash space. A segment's task adds them to a
once-seen filter and, if they were seen before, to a twice-seen one, and answers each chunk with what the second holds. So
only suspected repeats are shuffled with their whole keys, for the exact confirmation and the choice of the first document.
A false suspect costs a row and changes nothing. A segment's filters are sized from its own hashes and live in one task; no
filter is collected or broadcast, and the text is read once whatever the number of lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.chunks import Keys, expanded, judged_chunks, pressed, shape_for
from pagelake.llm.common import col, materialize, sealed, unsealed

STRIP = b" \t\n\x0b\x0c\r"
MIN_KEY = 10
BITS_PER_KEY = 12


def line_keys(text: str | None) -> list[bytes]:
    """The key of each line: A-Z in lower case, white space stripped at both ends."""
    return [x.strip(STRIP) for x in (text or "").encode("utf-8", "surrogatepass").lower().split(b"\n")]


def counted(key: bytes, least: int = MIN_KEY) -> bool:
    return len(key) >= 4 * least or len(key) >= least and len(key.decode("utf-8", "surrogatepass")) >= least


def seen_twice(lists: list[Keys]) -> list[np.ndarray]:
    """For the lists of one segment: 1 for each hash that two rows may hold, by a once-seen and a twice-seen Bloom filter.

    A hash that is new sets its bits of the first filter; one whose bits were all set before, or that several rows of one
    list hold, sets those of the second. No hash that two rows hold is missed.
    """
    bits = 1 << max(10, (BITS_PER_KEY * sum(len(x.q) for x in lists)).bit_length())
    once, twice = np.zeros(bits, bool), np.zeros(bits, bool)

    def places(q: np.ndarray) -> np.ndarray:
        h = (q ^ (q >> np.uint64(23))) * np.uint64(0x9E3779B97F4A7C15)
        g = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        low = np.uint64(64 - (bits.bit_length() - 1))
        return np.stack([h >> low, g >> low, (h + g) >> low]).astype(np.int64)

    for x in lists:
        at = places(x.q)
        again = once[at].all(axis=0) | x.many
        once[at] = True
        twice[at[:, again]] = True
    return [twice[places(x.q)].all(axis=0).astype(np.uint8) for x in lists]


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_keys: int = 1 << 20) -> DataFrame:
    """docs with every line removed whose key a smaller id holds too; n_lines (before) and n_dropped follow.

    Keys of at least ten code points that two or more ids hold lose all lines except in the smallest id. A null or empty
    text is one empty line. Rows with one id are one document. Rows with a null id stay whole and count as no document.
    Very long lines and texts are handled whole. An empty table gives an empty table. A column named n_lines or
    n_dropped in the input gives way to the operator's. segment_keys is about how many hashes one task filters at a time.
    """
    columns = docs.columns
    keyed = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    seen = keyed.where(F.col("id").isNotNull() & (F.octet_length("text") >= MIN_KEY))
    n_bytes = seen.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    # Hashes are of rows: rows that share an id can only add suspects.
    def keys_of(chunk: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        each = [[xxhash.xxh3_64_intdigest(k) for k in {k for k in line_keys(t) if counted(k)}] for t in chunk["text"].to_pylist()]
        return np.array([h for own in each for h in own], np.uint64), np.repeat(np.arange(len(each)), [len(own) for own in each])

    kind = keyed.schema["id"].dataType.simpleString()
    shape = shape_for(docs, n_bytes // 100 + 1, segment_keys)

    def suspects(chunk: pa.Table, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, row = [], []
        for i, text in enumerate(chunk["text"].to_pylist()):
            own = {k for k in line_keys(text) if counted(k)}
            keys += own
            row += [i] * len(own)
        q = shape.cut(np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64))
        pick = np.flatnonzero(codes[np.unique(q, return_inverse=True)[1]]) if keys else np.zeros(0, np.int64)
        picked, ids = [keys[i] for i in pick.tolist()], chunk["id"].combine_chunks()
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.array(row, np.int64)[pick])), pa.array([xxhash.xxh3_128_digest(k) for k in picked], pa.binary()), pa.array(picked, pa.binary())], ["id", "h", "key"])

    found = judged_chunks(seen, keys_of, seen_twice, shape, suspects, f"id {kind}, h binary, key binary", "line")
    found = materialize(found, "line-suspects", *found._made_from)
    first = found.groupBy("h", "key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where(F.col("first") < F.col("last")).select("h", "key", "first")
    first = materialize(first, "line-first")
    late = found.join(first, ["h", "key"]).where(F.col("id") > F.col("first")).groupBy("id").agg(F.collect_set("h").alias("late"))
    late = materialize(late, "line-late", found, first)

    @F.arrow_udf("struct<text string, n_lines bigint, n_dropped bigint>")
    def without(small: pa.Array, late: pa.Array) -> pa.Array:
        kept, before, dropped = [], [], []
        for part, hs in zip(small, late.to_pylist(), strict=True):
            t = None if (data := expanded(part)) is None else data.decode("utf-8", "surrogatepass")
            lines = (t or "").split("\n")
            stay = lines
            if hs:
                hs = set(hs)
                stay = [x for x, k in zip(lines, line_keys(t), strict=True) if not (counted(k) and xxhash.xxh3_128_digest(k) in hs)]
            kept.append(t if len(stay) == len(lines) else "\n".join(stay))
            before.append(len(lines))
            dropped.append(len(lines) - len(stay))
        return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(before, pa.int64()), pa.array(dropped, pa.int64())], ["text", "n_lines", "n_dropped"])

    # Never by a broadcast: between the two functions of texts is a shuffle, so a task takes one Python worker.
    rows = sealed(docs, id=col(id_col), pressed=pressed(col(text_col))).join(late.hint("merge"), "id", "left").withColumn("out", without("pressed", "late"))
    return unsealed(rows, columns, **{text_col: F.col("out.text"), "n_lines": F.col("out.n_lines"), "n_dropped": F.col("out.n_dropped")})
