"""SimHash near-dedup with vantage-point trees.

A fingerprint has one bit for each of 64 positions, set if over half of the shingles' XXH64 values have it set. Distinct
fingerprints are partitioned by a vantage-point tree fitted on a bounded sample: a node holds a vantage point and a
distance; fingerprints nearer than it go one way, the others the other way. Every fingerprint has one home shard. As
linked fingerprints differ in at most `radius` bits, the triangle inequality prunes every branch farther than that from
the boundary; a fingerprint of the near side that lies at the boundary also goes, as a guest, wherever its links on the
far side can be. Each shard then searches its guests and homes with a tree of its own, so every pair is found once and
exactly. Shards send a forest over the links found, not the pairs; components are joined by star contraction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import col, connected_components, hash_sample, local_components, materialize, sealed, unsealed

_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
BRUTE = 192


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of a text: A-Z in lower case, words between ASCII white space, shingles with repeats."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().translate(_SPACES).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    n = len(words) - k + 1
    first, last = starts[:n].tolist(), ends[k - 1 :].tolist()
    for at in range(0, n, 65536):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(first[at : at + 65536], last[at : at + 65536], strict=True)], np.uint64)
        h = np.concatenate([h, np.zeros(-len(h) % 255, np.uint64)]).reshape(-1, 255)
        for j in range(8):  # bit j of all eight bytes at once, in lanes that 255 values can't overflow
            total[j::8] += ((h >> np.uint64(j)) & np.uint64(0x0101010101010101)).sum(axis=1).view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def _vantage(sample: np.ndarray) -> tuple[np.uint64, int] | None:
    """Of a few candidates the point whose distances spread most, and its median distance; None if nothing splits."""
    best = None
    for point in sample[:: max(1, len(sample) // 8)][:8]:
        d = _distance(sample, point)
        mid = int(np.median(d))
        if (mid := mid if (d > mid).any() else mid - 1) >= 0 and (d <= mid).any() and (best is None or d.std() > best[0]):
            best = (d.std(), point, mid)
    return best and (best[1], best[2])


def fit_tree(sample: np.ndarray, n: int, capacity: int) -> list[tuple]:
    """Nodes (point, distance, near node, far node), or (shard,) for a leaf; the root is the first."""
    nodes, leaves = [], 0
    todo = [(sample, None)]
    while todo:
        own, parent = todo.pop()
        at = len(nodes)
        if parent is not None:
            nodes[parent[0]][parent[1]] = at
        split = _vantage(own) if len(own) * n > capacity * len(sample) and len(own) > 8 else None
        if split is None:
            nodes.append([leaves])
            leaves += 1
        else:
            d = _distance(own, split[0])
            nodes.append([*split, 0, 0])
            todo += [(own[d > split[1]], (at, 3)), (own[d <= split[1]], (at, 2))]
    return [tuple(x) for x in nodes]


def route(nodes: list[tuple], fp: np.ndarray, radius: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, rows, home?) for each shard that has a part in fp: homes go one way, guests wherever a link may be."""
    out, todo = [], [(0, np.arange(len(fp)), np.ones(len(fp), bool))]
    while todo:
        at, rows, home = todo.pop()
        if not len(rows):
            continue
        if len(nodes[at]) == 1:
            out.append((nodes[at][0], rows, home))
            continue
        point, mid, near, far = nodes[at]
        d = _distance(fp[rows], point)
        inner = d <= mid
        into = (home & inner) | (~home & (d <= mid + radius))
        todo.append((near, rows[into], home[into]))
        beyond = (home & ~inner) | (d > mid - radius)
        todo.append((far, rows[beyond], (home & ~inner)[beyond]))
    return out


def links(homes: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (home, query) at most radius bits apart, by a tree over the homes."""
    found, todo = [], [(np.arange(len(homes)), np.arange(len(queries)))]
    while todo:
        h, q = todo.pop()
        if not len(h) or not len(q):
            continue
        split = _vantage(homes[h]) if len(h) > BRUTE else None
        if split is None:
            for part in np.array_split(q, max(1, len(h) * len(q) // 4_000_000)):
                a, b = np.nonzero(np.bitwise_count(homes[h][:, None] ^ queries[part][None, :]) <= radius)
                found.append((h[a], part[b]))
            continue
        dh, dq = _distance(homes[h], split[0]), _distance(queries[q], split[0])
        todo += [(h[dh <= split[1]], q[dq <= split[1] + radius]), (h[dh > split[1]], q[dq > split[1] - radius])]
    return tuple(np.concatenate([x[i] for x in found]) if found else np.zeros(0, int) for i in (0, 1))


def near_duplicates(fps: DataFrame, radius: int = 2, sample_limit: int = 65_536) -> DataFrame:
    """(fp, component) for the distinct fingerprints of fps(id, fp): the smallest id that links of radius bits lead to.

    The tree is fitted on at most sample_limit fingerprints (a bounded index sample); every one is routed and searched.
    """
    distinct = materialize(fps.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-distinct")
    n = distinct.count()
    sample = hash_sample(distinct.select("fp"), "fp", n, sample_limit).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    sample = sample[np.argsort(sample * np.uint64(0x9E3779B97F4A7C15), kind="stable")]
    nodes = fit_tree(sample, n, int(np.clip(n // 64, 256, 8192)))

    def routed(batches):
        for batch in batches:
            fp = batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            for shard, rows, home in route(nodes, fp, radius):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), shard), pa.int64()), batch["fp"].take(pa.array(rows)), batch["rep"].take(pa.array(rows)), pa.array(home)], ["shard", "fp", "rep", "home"])

    def searched(table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")  # then the smallest index is the smallest id
        fp, rep = table["fp"].combine_chunks().to_numpy(zero_copy_only=False).view(np.uint64), table["rep"].combine_chunks()
        home = table["home"].to_numpy(zero_copy_only=False)
        homes = np.flatnonzero(home)
        a, b = links(fp[homes], fp, radius)
        label = local_components(len(fp), homes[a], b)
        moved = np.flatnonzero(label != np.arange(len(fp)))
        return pa.table({"a": rep.take(pa.array(moved)), "b": rep.take(pa.array(label[moved]))})

    kind = fps.schema["id"].dataType.simpleString()
    shards = distinct.where(F.col("rep").isNotNull()).mapInArrow(routed, f"shard long, fp long, rep {kind}, home boolean")
    edges = shards.groupBy("shard").applyInArrow(searched, f"a {kind}, b {kind}")
    components = materialize(connected_components(edges, "simhash-cc"), "simhash-components")
    return distinct.join(components, distinct["rep"] == components["node"], "left").select("fp", F.coalesce("component", "rep").alias("component"))


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """(id, th, fp, component) for each id and text (th is its xxhash64) of docs, as simhash_dedup says."""

    @F.arrow_udf("long")
    def fp_of(text: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t, shingle) for t in text.to_pylist()], np.uint64).view(np.int64))

    keyed = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("th"), fp_of(col(text_col)).alias("fp"))
    fps = materialize(keyed, "simhash-fps")
    component = materialize(near_duplicates(fps.where(F.col("id").isNotNull()), radius), "simhash-component")
    return fps.join(component, "fp", "left").groupBy("id", "th").agg(F.first("fp").alias("fp"), F.first("component").alias("component"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """docs with fingerprint (16 hex digits) and component_id, the smallest id that links lead to, its own included.

    Fingerprints link if at most radius bits differ; equal texts always do. A null, empty or blank text has fingerprint
    zero and is linked like any other. Rows that share an id are rows of one document. A row with a null id gets its
    fingerprint, takes the component of its fingerprint's group, if any, and links nothing itself. Very long texts are
    read whole, in blocks of shingles. Columns named fingerprint or component_id give way to the operator's.
    """
    known = simhash_classes(docs, id_col, text_col, shingle, radius)
    rows = sealed(docs, own=col(id_col), own_th=F.xxhash64(col(text_col)))
    rows = rows.join(known, rows["own"].eqNullSafe(known["id"]) & (rows["own_th"] == known["th"]), "left")
    return unsealed(rows, docs.columns, fingerprint=F.lower(F.lpad(F.hex("fp"), 16, "0")), component_id=F.col("component"))
