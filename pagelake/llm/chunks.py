"""Which hashes do two rows share? Found by segments of the hash space, without a filter at the driver or in a broadcast.

Rows are packed into chunks of some megabytes. A chunk sends each segment the sorted list of its hashes there, cut to as
many bits as the table needs and coded as differences, two to three bytes each. The task of a segment judges every hash
and answers each list with a code for each entry. Chunks meet their answers in a shuffle by chunk number, so the text is
read once from its table and moved once, whatever the size of the table. A hash that all rows hold is one entry in each chunk.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import materialize

_LAST = 1 << 62


@dataclass
class Shape:
    """Bits that are kept of a hash, and the number of segments."""

    bits: int
    segments: int

    def cut(self, h: np.ndarray) -> np.ndarray:
        return h.astype(np.uint64) >> np.uint64(64 - self.bits)

    def segment(self, q: np.ndarray) -> np.ndarray:
        """Ascending with q."""
        low = self.bits - min(self.bits, 32)
        return ((q >> np.uint64(low)) * np.uint64(self.segments)) >> np.uint64(self.bits - low)


def shape_for(df: DataFrame, n_keys: int, segment_keys: int) -> Shape:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return Shape(min(60, max(24, n_keys.bit_length() + 10)), int(max(2 * partitions, n_keys // segment_keys + 1)))


@dataclass
class Keys:
    """The ascending hashes of one list: how often each occurs in the chunk, and whether in several rows of it."""

    q: np.ndarray
    n: np.ndarray
    many: np.ndarray


def coded(keys: Keys) -> bytes:
    gaps = np.diff(keys.q, prepend=np.uint64(0))
    n = np.minimum(keys.n, 2**32 - 1).astype("<u4")
    wide, tall = (max(1, -(-int(x.max()).bit_length() // 8)) for x in (gaps, n))
    parts = [np.array([len(n), wide, tall], "<u4").tobytes()]
    parts += [np.ascontiguousarray(x.astype(f"<u{s}").view(np.uint8).reshape(len(x), s)[:, :w].T).tobytes() for x, s, w in ((gaps, 8, wide), (n, 4, tall))]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([*parts, np.packbits(keys.many).tobytes()]))


def decoded(data: bytes) -> Keys:
    data = zstandard.ZstdDecompressor().decompress(data)
    size, wide, tall = np.frombuffer(data, "<u4", 3).tolist()
    at, out = 12, []
    for s, w in ((8, wide), (4, tall)):
        x = np.zeros((size, s), np.uint8)
        x[:, :w] = np.frombuffer(data, np.uint8, size * w, at).reshape(w, size).T
        out.append(x.reshape(-1).view(f"<u{s}"))
        at += size * w
    return Keys(np.cumsum(out[0], dtype=np.uint64), out[1], np.unpackbits(np.frombuffer(data, np.uint8, offset=at), count=size).astype(bool))


def listed(q: np.ndarray, row: np.ndarray) -> Keys:
    """The hashes of a chunk, from one entry (hash, row) for each time that a row holds it; rows ascend."""
    order = np.argsort(q, kind="stable")
    q, row = q[order], row[order]
    head = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
    ends = np.append(head[1:], len(q))
    return Keys(q[head], ends - head, row[head] != row[ends - 1])


def pressed(text: Column) -> Column:
    """A text's UTF-8 bytes in less room, for a shuffle; null where the text is."""

    @F.arrow_udf("binary")
    def small(text: pa.Array) -> pa.Array:
        press = zstandard.ZstdCompressor(level=3).compress
        return pa.array([None if t is None else press(t.encode("utf-8", "surrogatepass")) for t in text.to_pylist()], pa.binary())

    return small(text)


def opened(rows: pa.Scalar) -> pa.Table:
    """A packed chunk's rows."""
    return pa.ipc.open_stream(rows.as_buffer()).read_all()


def expanded(data: pa.Scalar) -> bytes | None:
    return zstandard.ZstdDecompressor().decompress(data.as_py()) if data.is_valid else None


Judge = Callable[[list[Keys]], list[np.ndarray]]


def judged_chunks(frame: DataFrame, keys_of: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]], judge: Judge, shape: Shape, use: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]], schema: str, tag: str, chunk_bytes: int = 4 << 20) -> DataFrame:
    """What use(chunk, codes) yields for every chunk of frame's rows.

    keys_of(chunk) gives a 64-bit hash and a row number, ascending, for each time that a row holds a hash. judge(lists)
    gives a code (0 to 255) for each entry of all chunks' lists of one segment. codes are those of the chunk's distinct
    hashes, cut to the shape's bits, in ascending order. A row larger than a chunk is a chunk of its own.
    """

    def packed(batches):
        held: list[pa.RecordBatch] = []
        size = 0

        def out():
            table = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as writer:
                writer.write_table(table)
            return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "rows"])

        for batch in batches:
            step = max(1, int(batch.num_rows * chunk_bytes / 4 / max(1, batch.nbytes)))
            for i in range(0, batch.num_rows, step):
                held.append(part := batch.slice(i, step))
                size += part.nbytes
                if size >= chunk_bytes:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    def listing(batches):
        for batch in batches:
            for chunk, rows in zip(batch["chunk"].to_pylist(), batch["rows"], strict=True):
                hashes, row = keys_of(opened(rows))
                keys = listed(shape.cut(hashes), row)
                segment = shape.segment(keys.q)
                cuts = [0, *(np.flatnonzero(np.diff(segment)) + 1).tolist(), len(segment)] if len(segment) else [0]
                lists = [coded(Keys(keys.q[a:b], keys.n[a:b], keys.many[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(lists), pa.int64()), pa.array([int(segment[a]) for a in cuts[:-1]], pa.int64()), pa.array(lists, pa.binary())], ["chunk", "segment", "keys"])

    def answered(batches):
        held: list[tuple[int, bytes]] = []
        now = None

        def out():
            codes = judge([decoded(data) for _, data in held])
            press = zstandard.ZstdCompressor(level=1).compress
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in held], pa.int64()), pa.array([now] * len(held), pa.int64()), pa.array([press(x.astype(np.uint8).tobytes()) for x in codes], pa.binary())], ["chunk", "segment", "data"])

        for batch in batches:
            for chunk, segment, data in zip(*(batch[c].to_pylist() for c in ("chunk", "segment", "keys")), strict=True):
                if segment != now and held:
                    yield from out()
                    held = []
                now = segment
                held.append((chunk, data))
        if held:
            yield from out()

    def used(batches):
        codes: list[bytes] = []
        for batch in batches:
            for segment, data in zip(batch["segment"].to_pylist(), batch["data"], strict=True):
                if segment != _LAST:
                    codes.append(zstandard.ZstdDecompressor().decompress(data.as_py()))
                else:
                    yield from use(opened(data), np.frombuffer(b"".join(codes), np.uint8))
                    codes = []

    chunks = materialize(frame.mapInArrow(packed, "chunk long, rows binary"), f"{tag}-chunks")
    lists = chunks.mapInArrow(listing, "chunk long, segment long, keys binary").repartition("segment").sortWithinPartitions("segment")
    answers = materialize(lists.mapInArrow(answered, "chunk long, segment long, data binary"), f"{tag}-answers")
    both = answers.unionByName(chunks.select("chunk", F.lit(_LAST).alias("segment"), F.col("rows").alias("data")))
    out = both.repartition("chunk").sortWithinPartitions("chunk", "segment").mapInArrow(used, schema)
    out._made_from = (chunks, answers)
    return out
