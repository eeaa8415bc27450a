"""Exact removal of repeated 50-byte strings, by buckets of suffixes that are sorted one at a time.

Dealing out: any two equal 50-byte strings have the same representative, of a string's 31 grams of 20 bytes the one with the
least hash. (It is chosen by content, as in a synchronizing set; README says what an
arithmetic cover would ship.) Neighbouring starts mostly share their representative, so a text is a list of blocks: a gram,
a first start and the number of starts that belong to it. Grams that only one document holds are found by segments of
their hashes (chunks.py), and their blocks go no further.

A bucket holds the suffixes that share a representative. Where that would be more than `bucket` blocks, a bucket is of the
suffixes that share all 50 bytes, and of equal ones a chunk of documents sends those of its least id only. A task sorts one
run of buckets after the other, by the bytes of the suffixes; equal ones lie side by side, and all but those of the least
id are marked. Order comes from the first and last bytes of the suffixes, and ties, which run longer than those, are
resolved by precomputed ranks of a difference cover's sample, so a task holds two words and three ranks for each suffix
and no suffix itself. Hashes deal out, they decide nothing: suffixes are equal if their bytes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.chunks import Keys, expanded, judged_chunks, pressed, shape_for
from pagelake.llm.common import col, materialize, sealed, unsealed

LENGTH, GRAM = 50, 20
SPAN = LENGTH - GRAM + 1
CHUNK = 20_000
#: A difference cover: for any two places there is an offset below PERIOD that takes both to remainders in COVER. Sampled
#: suffixes are ranked to DEPTH bytes, which reach from the first eight bytes of a string to its last eight.
PERIOD, COVER, DEPTH = 7, (1, 2, 4), LENGTH - 8
OFFSETS = np.array([[k for k in range(PERIOD) if (r + k) % PERIOD in COVER] for r in range(PERIOD)])
ONCE, SHARED, CROWDED = 0, 1, 2
_U = np.uint64
_TABLE = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_B = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def rolling(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of each string of that length, by joining hashes of doubled lengths."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, _U)
    level, size, base = _TABLE[data], 1, _B
    out, done = None, 0
    left = length
    while left:
        if left & 1:
            part = level[done : done + n]
            out = part.copy() if out is None else out * base + part
            done += size
        left >>= 1
        if left:
            level = level[:-size] * base + level[size:]
            size *= 2
            with np.errstate(over="ignore"):
                base = base * base
    return _mix(out)


def blocks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gram hash, first start and number of starts (at most SPAN) of each block of a text."""
    low = rolling(data, GRAM)
    n = len(low) - SPAN + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = 1
    while size * 2 <= SPAN:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[:n], low[SPAN - size : SPAN - size + n])
    start = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    runs = np.diff(np.append(start, n))
    pieces = -(-runs // SPAN)  # texts with a short period have long runs
    of = np.repeat(np.arange(len(runs)), pieces)
    step = (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * SPAN
    return low[start][of], start[of] + step, np.minimum(SPAN, runs[of] - step)


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def starts_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For blocks of these sizes, laid end to end: the block and the offset in it of every 50-byte string."""
    counts = sizes - LENGTH + 1
    of = np.repeat(np.arange(len(sizes)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)


def cover_ranks(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For every place the rank, in suffix order to DEPTH bytes, of the cover sample of the suffixes that start at `at`.

    The sample is the places less than PERIOD behind a start whose remainder is in COVER. Equal strings have one rank.
    """
    near = np.zeros(len(words) + PERIOD, bool)
    for k in range(PERIOD):
        near[at + k] = True
    place = np.flatnonzero(near[: len(words)] & np.isin(np.arange(len(words)) % PERIOD, COVER))
    keys = [words[np.minimum(place + k, len(words) - 1)] for k in (*range(0, DEPTH - 8, 8), DEPTH - 8)]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(place), bool)
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    ranks = np.zeros(len(words), np.int64)
    ranks[place[order]] = np.cumsum(new)
    return ranks


def late(data: np.ndarray, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which of the 50-byte strings at these places also start in a document with a smaller id.

    Suffixes are put in order by their first and their last eight bytes. Ties are resolved by the ranks of a difference
    cover's sample: for any two places there is a k below PERIOD that takes both into the sample, and strings that agree in
    their ends and in the rank at k agree in all bytes. So a string has an entry for each k that takes it into the sample,
    equal strings meet in at least one, and unlike ones in none.
    """
    if not len(at):
        return np.zeros(0, bool)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(_U)
    words = np.zeros(len(data) + 1, _U)
    for k in range(8):
        words |= padded[k : k + len(words)] << _U(56 - 8 * k)
    head, tail = words[at], words[at + LENGTH - 8]
    order = np.lexsort([tail, head])
    new = np.zeros(len(at), np.int64)
    new[1:] = (head[order][1:] != head[order][:-1]) | (tail[order][1:] != tail[order][:-1])
    tie = np.empty(len(at), np.int64)
    tie[order] = np.cumsum(new)
    ranks = cover_ranks(words, at)
    wide = int(ranks.max()).bit_length()
    out = np.zeros(len(at), bool)
    steps = OFFSETS[at % PERIOD]  # for each start the offsets that take it into the sample
    entry = ((tie[:, None] * 8 + steps) << wide) | ranks[at[:, None] + steps]
    order = np.argsort(entry, axis=None)
    key, own = entry.ravel()[order], np.repeat(doc, steps.shape[1])[order]
    head = np.concatenate([[True], key[1:] != key[:-1]])
    least = np.minimum.reduceat(own, np.flatnonzero(head))
    out[order[own > least[np.cumsum(head) - 1]] // steps.shape[1]] = True
    return out


def _masks(of: np.ndarray, offset: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(of, np.left_shift(1, offset), n).astype(np.int64)


def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, id, th, start, part, mask) in order of bucket: those with strings that a smaller id holds, as a bit
    mask of starts. Rows that have a mask already pass."""
    fields = ["id", "th", "start", "mask"]

    def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
        parts = table["part"].to_pylist()
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        of, offset = starts_of(sizes)
        data = np.frombuffer(b"".join(parts), np.uint8)
        gone = np.flatnonzero(late(data, (np.cumsum(sizes) - sizes)[of] + offset, table["id"].to_numpy()[of]))
        mask = _masks(of[gone], offset[gone], len(sizes))
        keep = np.flatnonzero(mask)
        yield from table.set_column(table.schema.get_field_index("mask"), "mask", pa.array(mask)).select(fields).take(pa.array(keep)).to_batches()

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if batch["mask"].null_count < batch.num_rows:
            yield batch.filter(batch["mask"].is_valid()).select(fields)
            batch = batch.filter(batch["mask"].is_null())
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK:
            table = pa.Table.from_batches(held)
            bucket = table["bucket"].to_numpy()
            cut = int(np.flatnonzero(bucket != bucket[-1])[-1]) + 1 if bucket[0] != bucket[-1] else 0
            if cut:
                yield from done(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                rows = table.num_rows - cut
    if rows:
        yield from done(pa.Table.from_batches(held))


def judged(most: int):
    """For the gram lists of one segment: which grams one row holds (ONCE), several (SHARED), and which make over `most` blocks."""

    def judge(lists: list[Keys]) -> list[np.ndarray]:
        q = np.concatenate([x.q for x in lists])
        order = np.argsort(q, kind="stable")
        head = np.concatenate([[True], q[order][1:] != q[order][:-1]])
        group, first = np.cumsum(head) - 1, np.flatnonzero(head)
        blocks = np.add.reduceat(np.concatenate([x.n for x in lists]).astype(np.int64)[order], first)
        many = np.logical_or.reduceat(np.concatenate([x.many for x in lists])[order], first) | (np.diff(np.append(first, len(q))) > 1)
        codes = np.zeros(len(q), np.uint8)
        codes[order] = np.where(many, np.where(blocks > most, CROWDED, SHARED), ONCE)[group]
        return np.split(codes, np.cumsum([len(x.q) for x in lists])[:-1])

    return judge


def _laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram, row, start and number of starts of every block of some texts."""
    each = [blocks(t) for t in texts]
    gram, start, count = (np.concatenate([x[k] for x in each] or [np.zeros(0, np.int64)]) for k in range(3))
    return gram, np.repeat(np.arange(len(each)), [len(x[0]) for x in each]), start, count


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int | None = None, segment_keys: int = 1 << 21) -> DataFrame:
    """docs with kept (binary: the UTF-8 bytes that stay), n_bytes, n_removed and n_spans (removed runs).

    A byte goes if a 50-byte string that covers it also starts in a document with a smaller id; strings are judged on the
    input and never cross documents. A null text is empty; under 50 bytes nothing goes. Ids are integers. Rows that share
    an id never remove each other's bytes; a row with a null id stays whole and counts as no document. Very long and
    periodic texts are handled whole. An empty table gives an empty table. Columns named like outputs give way to them.
    bucket is the number of blocks above which a bucket is split by whole strings (by default one in 8,000 of all blocks,
    1,000 at least and 50,000 at most, which a task holds with ease); segment_keys is about how many grams one task judges
    at a time. Neither changes a result.
    """
    text = col(text_col)
    keyed = docs.select(col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"), text.alias("text")).where(F.col("id").isNotNull() & (F.octet_length("text") >= LENGTH))
    digest = keyed.select("id", "th", F.sha2("text", 256).alias("sha"))
    first = digest.groupBy("sha").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    copies = materialize(digest.join(materialize(first.select("sha", "first"), "substring-equal"), "sha").where("id > first").select("id", "th").distinct(), "substring-copies")
    own = keyed.join(copies.select("id", "th"), ["id", "th"], "left_anti").select("id", "th", "text")
    n_blocks = (keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 16 + 1
    shape = shape_for(docs, n_blocks, segment_keys)

    def grams(chunk: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return _laid_out([_bytes(t) for t in chunk["text"].to_pylist()])[:2]

    def placed(chunk: pa.Table, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        texts = [_bytes(t) for t in chunk["text"].to_pylist()]
        gram, of, start, count = _laid_out(texts)
        if not len(gram):
            return
        code = codes[np.unique(shape.cut(gram), return_inverse=True)[1]]
        ids, ths = chunk["id"].to_numpy(), chunk["th"].to_numpy()
        raw, begins = b"".join([t.tobytes() for t in texts]), np.cumsum([0, *map(len, texts)])

        def bytes_of(pick: np.ndarray) -> list[bytes]:
            a = begins[of[pick]] + start[pick]
            return [raw[x:y] for x, y in zip(a.tolist(), (a + count[pick] + LENGTH - 1).tolist(), strict=True)]

        def batch(bucket, row, at, part, mask):
            arrays = [pa.array(bucket.view(np.int64)), pa.array(ids[row]), pa.array(ths[row]), pa.array(at.astype(np.int32)), pa.array(part, pa.binary()), pa.array(mask, pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, ["bucket", "id", "th", "start", "part", "mask"])

        pick = np.flatnonzero(code == SHARED)
        yield batch(gram[pick], of[pick], start[pick], bytes_of(pick), [None] * len(pick))
        pick = np.flatnonzero(code == CROWDED)
        if len(pick):
            joined = b"".join(bytes_of(pick))
            data, sizes = np.frombuffer(joined, np.uint8), count[pick] + LENGTH - 1
            block, offset = starts_of(sizes)
            at, row = (np.cumsum(sizes) - sizes)[block] + offset, of[pick][block]
            gone = late(data, at, ids[row])
            mask = _masks(block[gone], offset[gone], len(pick))
            marked = np.flatnonzero(mask)
            yield batch(_mix(ths[of[pick[marked]]].view(_U)), of[pick[marked]], start[pick[marked]], [None] * len(marked), mask[marked])
            stay = np.flatnonzero(~gone)
            yield batch(rolling(data, LENGTH)[at[stay]], row[stay], start[pick][block[stay]] + offset[stay], [joined[x : x + LENGTH] for x in at[stay].tolist()], [None] * len(stay))

    rows = judged_chunks(own, grams, judged(int(np.clip(n_blocks // 8000, 1000, 50_000)) if bucket is None else bucket), shape, placed, "bucket long, id long, th long, start int, part binary, mask long", "substring")
    marks = rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(resolve, "id long, th long, start int, mask long")
    cuts = marks.groupBy("id", "th").agg(F.collect_list(F.struct("start", "mask")).alias("runs"), F.lit(False).alias("copy"))
    cuts = cuts.unionByName(copies.select("id", "th", F.array().cast("array<struct<start:int,mask:bigint>>").alias("runs"), F.lit(True).alias("copy")))

    @F.arrow_udf("struct<kept binary, n_bytes bigint, n_removed bigint, n_spans bigint>")
    def cut(small: pa.Array, runs: pa.Array, copy: pa.Array) -> pa.Array:
        out: list[tuple[bytes, int, int, int]] = []
        flat = runs.flatten()
        starts, masks = flat.field("start").to_numpy(zero_copy_only=False), flat.field("mask").to_numpy(zero_copy_only=False)
        ends = np.cumsum(np.array([len(r) if r.is_valid else 0 for r in runs], np.int64))
        for k, (data, gone) in enumerate(zip(small, copy.to_pylist(), strict=True)):
            data = expanded(data) or b""
            n = len(data)
            own = slice(ends[k - 1] if k else 0, ends[k])
            if gone:
                out.append((b"", n, n, 1))
            elif own.start == own.stop:
                out.append((data, n, 0, 0))
            else:
                bits = (masks[own][:, None] >> np.arange(SPAN)[None]) & 1
                row, bit = np.nonzero(bits)
                at = starts[own][row] + bit
                edge = np.zeros(n + 1, np.int32)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + LENGTH, -1)
                hit = np.cumsum(edge[:n]) > 0
                out.append((np.frombuffer(data, np.uint8)[~hit].tobytes(), n, int(hit.sum()), int(hit[0]) + int((hit[1:] & ~hit[:-1]).sum())))
        kept, *numbers = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.StructArray.from_arrays([pa.array(kept, pa.binary()), *[pa.array(x, pa.int64()) for x in numbers]], ["kept", "n_bytes", "n_removed", "n_spans"])

    rows = sealed(docs, id=col(id_col).cast("long"), th=F.xxhash64(text), pressed=pressed(text))
    cuts = cuts.select(F.col("id").alias("cut_id"), F.col("th").alias("cut_th"), "runs", "copy")
    rows = rows.join(cuts, (F.col("id") == F.col("cut_id")) & (F.col("th") == F.col("cut_th")), "left").withColumn("out", cut("pressed", "runs", "copy"))
    return unsealed(rows, docs.columns, **{k: F.col(f"out.{k}") for k in ("kept", "n_bytes", "n_removed", "n_spans")})
