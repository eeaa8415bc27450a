"""Embedding near-dedup with an inverted multi-index.

Vectors are normalised and cut in halves; each half has a codebook of its own, and pairs of codes make the cells of a
product grid. A query walks the cells in order of the summed distances to both codes (multi-sequence order) until the
number of cells that reaches the recall wanted: for pairs exactly at the threshold, of vectors that the codebooks were not
fitted on. Pairs of a query and an entry at home in a visited cell are verified by their cosine in double precision.

Codebooks are fitted on nine tenths of at most sample_limit vectors and visits on the last tenth; every vector is indexed
and every vector queries. Equal vectors are one entry with a weight. A full cell is dealt out in tiles of some homes and some queries, so no
task gets a whole cell; links are counted, not listed, and each tile sends a forest over the links it found.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import col, connected_components, hash_sample, local_components, materialize, sealed, unsealed


#: A copy of a query, which is written, moved and read, costs as much as so many verifications.
_COPY = 1000


def normal(flat: np.ndarray, dim: int) -> np.ndarray:
    """Rows of unit length in double precision."""
    x = flat.astype(np.float64).reshape(-1, dim)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means centres, from a spread start, with a fixed order of everything."""
    rng = np.random.default_rng(7)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = _square(x, centres).argmin(axis=1)
        for c in range(len(centres)):
            if (mine := own == c).any():
                centres[c] = x[mine].mean(axis=0)
    return centres


def _square(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None])


def _nearest(distance: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n columns of least distance of each row, nearest first, and their distances."""
    n = min(n, distance.shape[1])
    some = np.sort(np.argpartition(distance, n - 1, axis=1)[:, :n], axis=1)
    order = np.take_along_axis(some, np.argsort(np.take_along_axis(distance, some, 1), axis=1, kind="stable"), 1)
    return order, np.take_along_axis(distance, order, 1)


class Grid:
    """Two codebooks and the number of cells that a query visits."""

    def __init__(self, first: np.ndarray, second: np.ndarray, visits: int = 1):
        self.first, self.second, self.visits = first, second, visits

    def order(self, x: np.ndarray, visits: int) -> np.ndarray:
        """For each row the `visits` nearest cells, nearest first; some rows at a time, so that ranks stay within bounds."""
        half = self.first.shape[1]
        # A cell at rank (i, j) of the two sorted lists comes after all (i', j') at or below it, so ranks with
        # (i + 1) * (j + 1) > visits can't be among the first ones.
        ka, kb = min(visits, len(self.first)), min(visits, len(self.second))
        ranks = np.concatenate([np.stack([np.full(m := min(kb, visits // (i + 1)), i), np.arange(m)], 1) for i in range(ka)])
        out = []
        for at in range(0, len(x), step := max(1, (1 << 22) // len(ranks))):
            some = x[at : at + step]
            (ia, sa), (ib, sb) = _nearest(_square(some[:, :half], self.first), ka), _nearest(_square(some[:, half:], self.second), kb)
            total = sa[:, ranks[:, 0]] + sb[:, ranks[:, 1]]
            best = np.argsort(total, axis=1, kind="stable")[:, :visits]
            out.append(np.take_along_axis(ia, ranks[best, 0], 1) * len(self.second) + np.take_along_axis(ib, ranks[best, 1], 1))
        return np.concatenate(out) if out else np.zeros((0, min(visits, len(self.first) * len(self.second))), np.int64)

    def rank(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """The place of a cell in each row's order, from 1, among all cells; of equally near ones the last."""
        half = self.first.shape[1]
        a, b = _square(x[:, :half], self.first), np.sort(_square(x[:, half:], self.second), axis=1)
        own = np.take_along_axis(_square(x[:, half:], self.second), (cell % len(self.second))[:, None], 1)[:, 0]
        limit = (np.take_along_axis(a, (cell // len(self.second))[:, None], 1)[:, 0] + own) * (1 + 1e-9)
        return np.array([np.searchsorted(nearest, s - first, side="right").sum() for nearest, s, first in zip(b, limit, a, strict=True)])

    def home(self, x: np.ndarray) -> np.ndarray:
        return self.order(x, 1)[:, 0]


def partners(x: np.ndarray, cosine: float) -> np.ndarray:
    """For each unit row one at this cosine: every other row moved in any direction, the rest towards another row.

    Where vectors fill few of their dimensions, so do the differences of near ones, and those cross more cells.
    """
    rng = np.random.default_rng(11)
    away = rng.standard_normal(x.shape)
    away[1::2] = x[rng.permutation(len(x))][1::2]
    away -= (away * x).sum(1)[:, None] * x
    size = np.sqrt((away * away).sum(1))[:, None]
    away = np.where(size > 1e-9, away / np.maximum(size, 1e-9), 0.0)
    return cosine * x + math.sqrt(1 - cosine**2) * away


def visits_for(grid: Grid, held: np.ndarray, threshold: float, recall: float) -> int:
    """Cells to visit so that this share of pairs at the threshold is found from either side, of each kind of partner."""
    y = partners(held, threshold)
    rank = np.minimum(grid.rank(held, grid.home(y)), grid.rank(y, grid.home(held)))
    need = max(np.quantile(rank[k::2], recall, method="higher") for k in range(min(2, len(rank))))
    return int(max(need, min(2, len(grid.first) * len(grid.second))))


def fit_grid(sample: np.ndarray, held: np.ndarray, n: int, threshold: float, recall: float) -> Grid:
    """Codebooks of the sample, and the visits that `held`, vectors that no codebook has seen, need at n vectors.

    Finer grids verify fewer vectors a cell and visit more cells. Of grids with 32 entries a cell and coarser ones the
    one of least work is taken: a visit costs the verifications of its cell's entries and a copy of the query. Codebooks
    have a code for eight vectors of the sample at most.
    """
    finest = min(math.sqrt(n / 32), len(sample) / 8)
    half = sample.shape[1] // 2
    best, least = None, math.inf
    for k in dict.fromkeys(max(1, round(finest / 2 ** (i / 2))) for i in range(8)):
        grid = Grid(_codebook(sample[:, :half], k), _codebook(sample[:, half:], k))
        grid.visits = visits_for(grid, held, threshold, recall)
        if (work := grid.visits * (_COPY + n / (len(grid.first) * len(grid.second)))) < least:
            best, least = grid, work
    return best


def embedding_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, recall: float = 0.98, sample_limit: int = 20_000) -> DataFrame:
    """vectors with n_links, component_id (smallest id that links lead to) and kept (the id is its component's).

    Pairs at or above the threshold that the index finds are links; none below it is. Vectors that are null, zero, hold
    null or non-finite components, or differ in length from most of the sample, link with nothing and are kept; so are
    rows with a null id (component null, not kept). Codebooks and visits are fitted on at most sample_limit vectors; from
    32 * (sample_limit / 8) ** 2 vectors on (200 million by default) cells grow with the table unless the limit does,
    which costs time and loses nothing. Rows that repeat an id should hold one vector: each counts as a
    vector of its own in n_links. Empty tables give empty tables. Input columns named like outputs give way to them.
    """
    id_, v = col(id_col), col(vector_col)
    d = F.transform(v, lambda x: x.cast("double"))
    finite = v.isNotNull() & ~F.coalesce(F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False)) & F.coalesce(F.exists(d, lambda x: x != 0), F.lit(False))
    good = vectors.where(finite & id_.isNotNull()).select(id_.alias("id"), v.alias("v"))
    sizes = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = sealed(vectors, id=id_)
    if sizes is None:
        return _with_links(rows, vectors.columns, None, id_col)
    dim = sizes.n
    distinct = good.where(F.size("v") == dim).groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
    distinct = materialize(distinct, "grid-distinct")
    n = distinct.count()
    sample = hash_sample(distinct.select("id", "v"), "id", n, sample_limit).toArrow().sort_by("id")["v"].combine_chunks()
    sample = normal(sample.flatten().to_numpy(), dim)
    sample = sample[np.random.default_rng(5).permutation(len(sample))]
    held = len(sample) // 10
    grid = fit_grid(sample[held:], sample[:held] if held else sample, n, threshold, recall)

    def unit(column: pa.Array) -> np.ndarray:
        return normal(column.flatten().to_numpy(zero_copy_only=False), dim)

    kind = vectors.schema[id_col].dataType.simpleString()
    out = f"cell long, home boolean, id {kind}, weight long, v {vectors.schema[vector_col].dataType.simpleString()}"

    def placed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                cells = grid.order(unit(part["v"]), grid.visits)
                row = np.repeat(np.arange(part.num_rows), cells.shape[1])
                home = np.zeros(cells.shape, bool)
                home[:, 0] = True
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(cells.ravel().astype(np.int64)), pa.array(home.ravel()), part["id"].take(take), part["weight"].take(take), part["v"].take(take)], ["cell", "home", "id", "weight", "v"])

    entries = materialize(distinct.select("id", "weight", "v").mapInArrow(placed, out), "grid-entries")
    size = int(np.clip(n // 20, 512, 4096))
    tiles = entries.groupBy("cell").agg(F.ceil(F.count_if("home") / size).cast("int").alias("h"), F.ceil(F.count("*") / (2 * size)).cast("int").alias("q")).where("h > 0")
    entries = entries.join(materialize(tiles, "grid-tiles"), "cell")
    own_h, own_q = (F.pmod(F.xxhash64("id", F.lit(k)), F.col(k)).cast("int") for k in ("h", "q"))
    # An entry at home lies in one row of its cell's tiles; a query in one column.
    as_query = F.transform(F.sequence(F.lit(0), F.col("h") - 1), lambda i: F.struct(i.alias("h"), own_q.alias("q"), F.lit(False).alias("home")))
    as_home = F.transform(F.sequence(F.lit(0), F.col("q") - 1), lambda i: F.struct(own_h.alias("h"), i.alias("q"), F.lit(True).alias("home")))
    entries = entries.select("cell", "id", "weight", "v", F.explode(F.when(F.col("home"), F.concat(as_query, as_home)).otherwise(as_query)).alias("at"))
    entries = entries.select("cell", "at.h", "at.q", "at.home", "id", "weight", "v")

    def verified(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")  # then a smaller number is a smaller id
        coded = table["id"].combine_chunks().dictionary_encode()
        number, weight = coded.indices.to_numpy(), table["weight"].to_numpy()
        x, home = unit(table["v"].combine_chunks()), table["home"].to_numpy()
        homes, queries = np.flatnonzero(home), np.flatnonzero(~home)
        n_links, pairs = np.zeros(len(coded.dictionary), np.int64), [np.zeros((2, 0), int)]
        visited, lives = grid.order(x[homes], grid.visits), grid.home(x[queries])
        for at in range(0, len(queries), 1024):
            own = queries[at : at + 1024]
            q, h = np.nonzero(x[own] @ x[homes].T >= threshold)
            other = number[own[q]] != number[homes[h]]
            q, h = q[other] + at, h[other]
            np.add.at(n_links, number[queries[q]], weight[homes[h]])
            # A home that does not visit the query's own cell can't find the query: it gets its side of the link here.
            blind = ~(visited[h] == lives[q][:, None]).any(axis=1)
            np.add.at(n_links, number[homes[h[blind]]], weight[queries[q[blind]]])
            pairs.append(np.stack([number[queries[q]], number[homes[h]]]))
        label = local_components(len(n_links), *np.concatenate(pairs, axis=1))
        keep = np.flatnonzero(n_links > 0)
        return pa.table({"id": coded.dictionary.take(pa.array(keep)), "links": pa.array(n_links[keep]), "root": coded.dictionary.take(pa.array(label[keep]))})

    parts = materialize(entries.groupBy("cell", "h", "q").applyInArrow(verified, f"id {kind}, links long, root {kind}"), "grid-links")
    links = parts.groupBy("id").agg(F.sum("links").alias("links"))
    components = connected_components(parts.select(F.col("id").alias("a"), F.col("root").alias("b")), "grid-cc")
    found = distinct.join(materialize(links, "grid-counts"), "id", "left").join(materialize(components, "grid-components"), F.col("id") == F.col("node"), "left")
    found = found.select("v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "id").alias("component"))
    found = good.join(materialize(found, "grid-entries-found"), "v").select(F.col("id").alias("of"), "links", "component")
    return _with_links(rows, vectors.columns, found.groupBy("of").agg(F.max("links").alias("links"), F.min("component").alias("component")), id_col)


def _with_links(rows: DataFrame, columns: list[str], found: DataFrame | None, id_col: str) -> DataFrame:
    if found is None:
        links, component = F.lit(0).cast("long"), F.col("id")
    else:
        rows = rows.join(materialize(found, "grid-found"), F.col("id") == F.col("of"), "left")
        links, component = F.coalesce("links", F.lit(0)).cast("long"), F.coalesce("component", "id")
    return unsealed(rows, columns, n_links=links, component_id=component, kept=F.coalesce(F.col("id") == component, F.lit(False)))

