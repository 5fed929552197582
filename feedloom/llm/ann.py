"""Approximate nearest neighbours: one navigable small-world graph per shard.

Equal vectors are one node.  Nodes are dealt to shards of bounded size by a hash
of their id; found nodes become rows again at the end.  A shard's graph
has levels of geometrically fewer nodes; each level is one flat array of
neighbours.  Candidates of a node come from exact products with its own level
and, for long links, with the levels above; the diversity rule keeps a
candidate only if it is closer to the node than to those already kept, and
links are then made mutual.

A shard is cut into bands of vectors of like length, each with a graph of its own:
inner products become distances by one extra dimension that lifts all vectors of
a band to one norm, which tells little where norms differ much.  Blocks of
queries take the bands from the longest on, and leave out those whose length
cannot give a better product than the ones found.  Small bands are scanned.

In a graph queries walk in step (greedy on the upper levels, a beam on the
lowest).  Where clusters are so tight that the lowest level falls into several
components, the beam also begins at nodes of each.  All of a beam is scored in
double precision on the original vectors, and the best of all shards are merged
by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import stored
from feedloom.llm.embed_dedup import clean_vectors, matrix

SHARD = 8192
DEGREE = 32
RATIO = 16
CANDIDATES = 96
# Recall of the 20 nearest is 0.999; 0.97 with a beam of 64, 0.99 with 96 (51,282 vectors, 7 shards).
BEAM = 160
QUERY_BLOCK = 2048
TOP = 20
# The longest vector of a band over the shortest, and bands too small for a graph.
BAND = 1.25
SCANNED = 256
# Nodes of a component for each begin of a walk, and begins a query takes.
BEGIN_EVERY, BEGINS = 64, 16


def _lifted(x: np.ndarray) -> np.ndarray:
    """One more dimension, so that nearer means a larger inner product with a query."""
    norm = (x * x).sum(axis=1)
    scale = np.sqrt(norm.max()) if norm.max() > 0 else 1.0
    x = x / scale
    rest = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))
    return np.column_stack([x, rest]).astype(np.float32)


def _nearest(x: np.ndarray, rows: np.ndarray, pool: np.ndarray, k: int) -> np.ndarray:
    """Positions in ``pool`` order of each row's k nearest in the pool (itself last)."""
    near = x[rows] @ x[pool].T
    near[rows[:, None] == pool[None, :]] = -np.inf
    k = min(k, len(pool))
    best = np.argpartition(near, len(pool) - k, axis=1)[:, -k:]
    return pool[best]


def _diverse(x: np.ndarray, rows: np.ndarray, found: np.ndarray, degree: int) -> np.ndarray:
    """At most ``degree`` neighbours per row, chosen by the diversity rule; -1 pads."""
    near = np.einsum("nd,nkd->nk", x[rows], x[found])
    near[found == rows[:, None]] = -np.inf
    order = np.argsort(-near, axis=1, kind="stable")
    found, near = np.take_along_axis(found, order, 1), np.take_along_axis(near, order, 1)
    out = np.full((len(rows), degree), -1, np.int32)
    count, closest = np.zeros(len(rows), int), np.full(found.shape, -np.inf, np.float32)
    for c in range(found.shape[1]):
        keep = (near[:, c] > closest[:, c]) & (count < degree) & np.isfinite(near[:, c])
        keep &= ~(out == found[:, c][:, None]).any(axis=1)
        at = np.flatnonzero(keep)
        out[at, count[at]] = found[at, c]
        count[at] += 1
        if c + 1 < found.shape[1] and len(at):
            to_kept = np.einsum("nd,nkd->nk", x[found[at, c]], x[found[at, c + 1 :]])
            closest[at, c + 1 :] = np.maximum(closest[at, c + 1 :], to_kept)
    return out


def _mutual(links: np.ndarray, nodes: np.ndarray, x: np.ndarray, degree: int) -> np.ndarray:
    """Links in both directions, the nearest ``2 * degree`` of each node kept."""
    place = np.full(len(x), -1, np.int64)
    place[nodes] = np.arange(len(nodes))
    source = np.repeat(nodes, links.shape[1])
    target = links.ravel()
    source, target = source[target >= 0], target[target >= 0]
    both = np.unique(np.concatenate([source * np.int64(len(x)) + target, target * np.int64(len(x)) + source]))
    source, target = both // len(x), both % len(x)
    near = np.einsum("nd,nd->n", x[source], x[target])
    order = np.lexsort((-near, source))
    source, target = source[order], target[order]
    start = np.searchsorted(source, nodes)
    rank = np.arange(len(source)) - start[place[source]]
    keep = rank < 2 * degree
    out = np.full((len(nodes), 2 * degree), -1, np.int32)
    out[place[source[keep]], rank[keep]] = target[keep]
    return out


def build_graph(vectors: np.ndarray, degree: int = DEGREE, seed: int = 7) -> list[tuple]:
    """Levels from the lowest to the top: (nodes, neighbours as a flat array).

    A level's neighbours are 2 * degree positions per node, -1 where fewer.
    """
    x, n = _lifted(vectors), len(vectors)
    order = np.random.default_rng(seed).permutation(n)
    sizes = [n]
    while sizes[-1] > 2 * RATIO:
        sizes.append(sizes[-1] // RATIO)
    levels = [np.sort(order[:size]) for size in sizes]
    out = []
    for depth, nodes in enumerate(levels):
        links = []
        for at in range(0, len(nodes), 1024):
            rows = nodes[at : at + 1024]
            found = [_nearest(x, rows, nodes, CANDIDATES if depth == 0 else degree * 2)]
            found += [_nearest(x, rows, pool, degree // 2) for pool in levels[depth + 1 :]]
            links.append(_diverse(x, rows, np.concatenate(found, axis=1), degree))
        out.append((nodes, _mutual(np.concatenate(links), nodes, x, degree).ravel()))
    return out


def _least(x: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's k least values, in their order."""
    k = min(k, x.shape[1])
    at = np.argpartition(x, k - 1, axis=1)[:, :k]
    return np.take_along_axis(at, np.argsort(np.take_along_axis(x, at, 1), axis=1), 1)


def begins(levels: list[tuple]) -> np.ndarray:
    """Nodes of every component of the lowest level; none if it is connected."""
    n = len(levels[0][0])
    links = levels[0][1].reshape(n, -1)
    source, column = np.nonzero(links >= 0)
    target, label = links[source, column], np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, source, label[target])
        np.minimum.at(low, target, label[source])
        low = low[low]
        if (low == label).all():
            break
        label = low
    order = np.argsort(label, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(label[order]) > 0]))
    if len(first) == 1:
        return np.zeros(0, np.int32)
    place = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    return order[place % BEGIN_EVERY == 0].astype(np.int32)


def search_graph(
    vectors: np.ndarray,
    levels: list[tuple],
    queries: np.ndarray,
    k: int,
    beam: int,
    extra: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Positions and approximate scores of each query's nearest; -1 where fewer.

    All queries walk together; each step opens every query's best unopened node.
    ``extra`` are further nodes to begin at; each query takes its best ones.
    """
    x, q, n = vectors.astype(np.float32), queries.astype(np.float32), len(vectors)
    rows = np.arange(len(q))
    top = levels[-1][0]
    at = top[np.argmax(q @ x[top].T, axis=1)]
    for nodes, flat in levels[-2:0:-1]:
        links, place = flat.reshape(len(nodes), -1), np.full(n, -1)
        place[nodes] = np.arange(len(nodes))
        now = np.einsum("nd,nd->n", q, x[at])
        while True:
            near = links[place[at]]
            score = np.einsum("nd,nkd->nk", q, x[near])
            score[near < 0] = -np.inf
            best = score.argmax(axis=1)
            better = score[rows, best] > now
            if not better.any():
                break
            at = np.where(better, near[rows, best], at)
            now = np.maximum(now, score[rows, best])
    links = levels[0][1].reshape(n, -1)
    beam = max(beam, k)
    seen = np.zeros((len(q), n), bool)
    ids = np.full((len(q), beam), -1, np.int32)
    score = np.full((len(q), beam), -np.inf, np.float32)
    opened = np.ones((len(q), beam), bool)
    ids[:, 0], score[:, 0], opened[:, 0] = at, np.einsum("nd,nd->n", q, x[at]), False
    seen[rows, at] = True
    if extra is not None and len(extra):
        near = q @ x[extra].T
        for c, best in enumerate(_least(-near, min(BEGINS, beam - 1)).T, 1):
            node = extra[best]
            new = np.flatnonzero(~seen[rows, node])
            ids[new, c], score[new, c], opened[new, c] = node[new], near[new, best[new]], False
            seen[new, node[new]] = True
    live = rows
    while len(live):
        best = np.where(opened[live], -np.inf, score[live]).argmax(axis=1)
        opened[live, best] = True
        near = links[ids[live, best]]
        fresh = (near >= 0) & ~seen[live[:, None], near]
        value = np.full(near.shape, -np.inf, np.float32)
        row, column = np.nonzero(fresh)
        seen[live[row], near[row, column]] = True
        value[row, column] = np.einsum("nd,nd->n", q[live[row]], x[near[row, column]])
        # The best new ones take the places of the worst in the beam that they beat.
        now = score[live]
        width = int((value > now.min(axis=1)[:, None]).sum(axis=1).max())
        if width:
            low = _least(now, width)
            high = _least(-value, width)
            value, now = np.take_along_axis(value, high, 1), np.take_along_axis(now, low, 1)
            row, column = np.nonzero(value > now)
            at = live[row], low[row, column]
            ids[at], score[at], opened[at] = near[row, high[row, column]], value[row, column], False
        live = live[~opened[live].all(axis=1)]
    ids[~np.isfinite(score)] = -1
    return ids, score


def bands(vectors: np.ndarray) -> list[np.ndarray]:
    """Positions by band of like length, longest first; one band if all are alike."""
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    low, high = norm.min(), norm.max()
    if high <= low * BAND:
        return [np.arange(len(vectors))]
    band = np.floor(np.log(high / norm) / np.log(BAND)).astype(int)
    order = np.argsort(band, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(band[order])) + 1)


class Shard:
    """The vectors of a shard and, per band, its graph (none where it is scanned)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        own = bands(vectors)
        order = np.concatenate(own)
        self.ids, self.vectors = ids[order], vectors[order]
        self.ends = np.cumsum([len(b) for b in own])
        self.graphs: list[list[tuple]] = []
        self.begins: list[np.ndarray] = []
        for at, end in zip(self.ends - [len(b) for b in own], self.ends, strict=True):
            levels = [] if end - at <= SCANNED < len(ids) else build_graph(self.vectors[at:end])
            self.graphs.append(levels)
            self.begins.append(begins(levels) if levels else np.zeros(0, np.int32))

    def packed(self) -> dict:
        levels = [level for graph in self.graphs for level in graph]
        none = np.zeros(0, np.int32)
        return {
            "ids": self.ids.astype(np.int64).tobytes(),
            "vectors": self.vectors.tobytes(),
            "ends": self.ends.tolist(),
            "nodes": np.concatenate([none, *(n for n, _ in levels)]).astype(np.int32).tobytes(),
            "neighbours": np.concatenate([none, *(f for _, f in levels)]).astype(np.int32).tobytes(),
            "sizes": [[len(n) for n, _ in graph] for graph in self.graphs],
            "begins": [b.tobytes() for b in self.begins],
        }

    @classmethod
    def unpacked(cls, row: dict) -> Shard:
        self = cls.__new__(cls)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(len(self.ids), -1)
        self.ends = np.array(row["ends"])
        self.begins = [np.frombuffer(b, np.int32) for b in row["begins"]]
        nodes, flat = np.frombuffer(row["nodes"], np.int32), np.frombuffer(row["neighbours"], np.int32)
        width, at, self.graphs = len(flat) // max(1, len(nodes)), 0, []
        for sizes in row["sizes"]:
            graph = []
            for size in sizes:
                graph.append((nodes[at : at + size], flat[at * width : (at + size) * width]))
                at += size
            self.graphs.append(graph)
        return self

    def search(self, queries: np.ndarray, top: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and exact scores of each query's ``top`` best; -1 where fewer."""
        n, x = len(queries), self.vectors
        found, score = np.full((n, top), -1, np.int64), np.full((n, top), -np.inf)
        length = np.sqrt((queries * queries).sum(axis=1))
        start = 0
        for end, graph, extra in zip(self.ends, self.graphs, self.begins, strict=True):
            band = x[start:end]
            most = np.sqrt((band * band).sum(axis=1).max())
            # No product in the band exceeds the two lengths'; later bands are shorter still.
            open_at = np.flatnonzero(length * most * (1 + 1e-9) >= score.min(axis=1))
            step = max(1, (1 << 22) // (max(beam, top, len(band) if not graph else 0) * x.shape[1]))
            if graph and len(open_at):
                near, _ = search_graph(band, graph, queries[open_at], top, beam, extra)
            for at in range(0, len(open_at), step):
                own = open_at[at : at + step]
                if graph:
                    new = near[at : at + step].astype(np.int64)
                    # Rounding may swap close ones, so the whole beam is measured exactly.
                    value = np.einsum("nd,nkd->nk", queries[own], band[new])
                    value[new < 0] = -np.inf
                else:
                    new = np.broadcast_to(np.arange(len(band)), (len(own), len(band)))
                    value = np.einsum("nd,kd->nk", queries[own], band)
                new = np.concatenate([found[own], np.where(new < 0, -1, new + start)], axis=1)
                value = np.concatenate([score[own], value], axis=1)
                best = np.lexsort((self.ids[new], -value), axis=1)[:, :top]
                found[own], score[own] = np.take_along_axis(new, best, 1), np.take_along_axis(value, best, 1)
            start = end
        return found, score


GRAPH = (
    "dim long, shard long, ids binary, vectors binary, ends array<long>, nodes binary, neighbours binary,"
    " sizes array<array<long>>, begins array<binary>"
)


def _build(key, table):
    dim = int(key[0].as_py())
    table = table.sort_by("vec_id").combine_chunks()
    ids = table.column("vec_id").to_numpy()
    x = np.asarray(table.column("vec").combine_chunks().flatten(), np.float64).reshape(-1, dim)
    row = Shard(ids, x).packed()
    longs = pa.list_(pa.int64())
    types = {"ends": longs, "sizes": pa.list_(longs), "begins": pa.list_(pa.binary())}
    columns = {k: pa.array([v], types.get(k, pa.binary())) for k, v in row.items()}
    head = {"dim": pa.array([dim], pa.int64()), "shard": pa.array([key[1].as_py()], pa.int64())}
    return pa.table(head | columns)


def build_index(vectors: DataFrame, shard_rows: int = SHARD) -> DataFrame:
    """One row per shard of (vec_id, vec): ids, vectors, nodes and flat neighbours."""
    shards = max(1, -(-vectors.count() // shard_rows))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard")
    rows = vectors.select(F.size("vec").cast("long").alias("dim"), shard, "vec_id", "vec")
    return rows.groupBy("dim", "shard").applyInArrow(_build, GRAPH)


def _query_blocks(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            size = np.asarray(batch.column("dim"))
            for dim in np.unique(size):
                part = batch.filter(pa.array(size == dim))
                for at in range(0, part.num_rows, rows):
                    cut = part.slice(at, rows)
                    block += 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(dim)], pa.int64()),
                            pa.array([block], pa.int64()),
                            pa.array([cut.column("vec_id").to_numpy().astype(np.int64).tobytes()]),
                            pa.array([matrix(cut.column("vec"), int(dim)).tobytes()]),
                        ],
                        ["dim", "block", "query_ids", "queries"],
                    )

    return run


def _search(top: int, beam: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {k: batch.column(k)[r].as_py() for k in batch.schema.names}
                shard = Shard.unpacked(row)
                query_ids = np.frombuffer(row["query_ids"], np.int64)
                q = np.frombuffer(row["queries"], np.float64).reshape(-1, row["dim"])
                # One more than ``top``: the query's own vector may have no copy.
                found, score = shard.search(q, top + 1, beam)
                good = np.isfinite(score)
                owner = np.broadcast_to(query_ids[:, None], found.shape)[good]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner), pa.array(shard.ids[found][good]), pa.array(score[good])],
                    ["query_id", "node", "score"],
                )

    return run


def nearest(
    table: DataFrame,
    every: int = 20,
    top: int = TOP,
    beam: int = BEAM,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found of each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all
    rows with another id, of the same vector length.  Vectors that are null,
    empty, zero, or hold null or non-finite components, and rows with a null
    id, take no part.  Rows that repeat an id count once, by the smallest vector.
    """
    vectors = clean_vectors(table, id_column, vector_column)
    vectors = stored(vectors.groupBy("vec_id").agg(F.min("vec").alias("vec")))
    # Equal vectors are one node, named by the smallest id; no result needs more copies.
    copies = W.partitionBy("vec").orderBy("vec_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    members = vectors.select(
        "vec_id", "vec", F.row_number().over(copies).alias("copy"), F.min("vec_id").over(copies).alias("node")
    ).where(F.col("copy") <= top + 1)
    members = stored(members.select("node", "vec_id", F.when(F.col("copy") == 1, F.col("vec")).alias("vec")))
    index = stored(build_index(members.where("vec IS NOT NULL").select("vec_id", "vec")))
    asked = vectors.where(F.col("vec_id") % every == 0)
    asked = asked.select(F.size("vec").cast("long").alias("dim"), "vec_id", "vec").coalesce(
        max(1, vectors.count() // (every * QUERY_BLOCK))
    )
    blocks = asked.mapInArrow(
        _query_blocks(QUERY_BLOCK), "dim long, block long, query_ids binary, queries binary"
    )
    # A stated query set in blocks against every shard: one row per block and shard.
    shards = index.groupBy("dim").agg(F.collect_set("shard").alias("shard"))
    blocks = blocks.join(shards, "dim").withColumn("shard", F.explode("shard"))
    work = blocks.join(index, ["dim", "shard"]).repartition("shard", "block")
    found = work.mapInArrow(_search(top, beam), "query_id long, node long, score double")
    nodes = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "node"))
    found = found.withColumn("rank", nodes).where(F.col("rank") <= top + 1).drop("rank")
    found = found.join(members.select("node", "vec_id"), "node").where("vec_id <> query_id")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
