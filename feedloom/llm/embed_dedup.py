"""Near-duplicate embeddings by a PCA-ordered tiled comparison.

Vectors are ordered along the first principal axis and cut into tiles.  A pair
of tiles is compared in one task: first on the leading principal dimensions,
where the rest of each product is bounded by the norms of both suffixes; the
next dimensions are added only for vector pairs that can still reach the
threshold.  Survivors are measured on the original vectors in double precision.

A task returns, per vector, how many links it found and a spanning forest of
them, never the links themselves, so a group of copies stays linear.  Tiles
whose intervals on the first axis lie too far apart are never compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import components, need_columns, stored

THRESHOLD = 0.9
TILE = 4096
LEAD = 16
DENSE = 0.02
SLACK = 1e-9


def usable(column: str):
    """Not null, not empty, no null or non-finite component, not all zero."""
    x = F.col(column)
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return x.isNotNull() & (F.size(x) > 0) & F.forall(x, finite) & F.exists(x, lambda v: v != 0)


def clean_vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    need_columns(table, id_column, vector_column)
    rows = table.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vec")
    )
    return rows.where(F.col("vec_id").isNotNull() & usable("vec"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _moments(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, outer, n = np.zeros(dim), np.zeros((dim, dim)), 0
        for batch in batches:
            if batch.num_rows:
                x = _unit(matrix(batch.column("vec"), dim))
                total, outer, n = total + x.sum(axis=0), outer + x.T @ x, n + len(x)
        flat = np.concatenate([[n], total, outer.ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat))), pa.array(flat)], ["at", "value"]
        )

    return run


def principal_axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """Principal axes of all unit vectors, most variance first (columns).

    Tasks add up moments, dim * dim numbers each; sums meet once per position.
    """
    moments = vectors.select("vec").mapInArrow(_moments(dim), "at long, value double")
    rows = moments.groupBy("at").agg(F.sum("value").alias("value")).toPandas().sort_values("at")
    flat = rows["value"].to_numpy()
    n, mean = max(flat[0], 1), flat[1 : dim + 1] / max(flat[0], 1)
    axes = np.linalg.eigh(flat[dim + 1 :].reshape(dim, dim) / n - np.outer(mean, mean))[1]
    return axes[:, ::-1].copy()


def _axis(first: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                place = _unit(matrix(batch.column("vec"), len(first))) @ first
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("vec"), pa.array(place)],
                    ["vec_id", "vec", "place"],
                )

    return run


def _blocks(dim: int):
    """A sorted partition to rows of at most TILE vectors, with their interval."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                cut = batch.slice(at, TILE)
                place = cut.column("place").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int64()),
                        pa.array([place[0]]),
                        pa.array([place[-1]]),
                        pa.array([cut.column("vec_id").to_numpy().astype(np.int64).tobytes()]),
                        pa.array([matrix(cut.column("vec"), dim).tobytes()]),
                    ],
                    ["part", "low", "high", "ids", "vecs"],
                )

    return run


def linked(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float) -> np.ndarray:
    """Boolean matrix: which rows of ``x`` and ``y`` have cosine >= threshold."""
    ux, uy = _unit(x), _unit(y)
    px, py = ux @ axes, uy @ axes
    lead = min(LEAD, x.shape[1])
    rx = np.sqrt(np.maximum(0, 1 - (px[:, :lead] ** 2).sum(axis=1)))
    ry = np.sqrt(np.maximum(0, 1 - (py[:, :lead] ** 2).sum(axis=1)))
    out = np.zeros((len(x), len(y)), bool)
    for at in range(0, len(x), 512):
        rows = slice(at, at + 512)
        part = px[rows, :lead] @ py[:, :lead].T
        i, j = np.nonzero(part + np.outer(rx[rows], ry) >= threshold - SLACK)
        if len(i) > DENSE * part.size:
            near = ux[rows] @ uy.T
            i, j = np.nonzero(near >= threshold - SLACK)
        else:
            # Add the next dimensions step by step, for what is left.
            near = part[i, j]
            for d in range(lead, x.shape[1], LEAD):
                e = min(d + LEAD, x.shape[1])
                near = near + np.einsum("ij,ij->i", px[at + i, d:e], py[j, d:e])
                sx = np.sqrt(np.maximum(0, (px[at + i, e:] ** 2).sum(axis=1)))
                sy = np.sqrt(np.maximum(0, (py[j, e:] ** 2).sum(axis=1)))
                ok = near + sx * sy >= threshold - SLACK
                i, j, near = i[ok], j[ok], near[ok]
        for cut in range(0, len(i), 1 << 16):
            a, b = i[cut : cut + (1 << 16)], j[cut : cut + (1 << 16)]
            cosine = np.einsum("ij,ij->i", ux[at + a], uy[b])
            out[at + a[cosine >= threshold], b[cosine >= threshold]] = True
    return out


def _forest(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what ``links`` connects: one fewer than the ids of a component."""
    edges, rows, cols = [], links.any(axis=1), links.any(axis=0)
    while rows.any():
        first = int(np.argmax(rows))
        rows[first] = False
        new_rows = np.array([first])
        while len(new_rows):
            new_cols = np.flatnonzero(links[new_rows].any(axis=0) & cols)
            cols[new_cols] = False
            edges += [(left[first], right[c]) for c in new_cols]
            new_rows = np.flatnonzero(links[:, new_cols].any(axis=1) & rows) if len(new_cols) else []
            rows[new_rows] = False
            edges += [(left[first], left[r]) for r in new_rows]
    return edges


def _compare(axes: np.ndarray, threshold: float):
    dim = len(axes)

    def load(rows):
        ids = np.frombuffer(b"".join(rows["ids"]), np.int64)
        return ids, np.frombuffer(b"".join(rows["vecs"]), np.float64).reshape(-1, dim)

    def run(key, rows):
        import pandas as pd

        left, x = load(rows[rows["group"] == key[0]])
        right, y = (left, x) if key[0] == key[1] else load(rows[rows["group"] == key[1]])
        links = linked(x, y, axes, threshold)
        if key[0] == key[1]:
            links |= links.T
            links[left[:, None] == right[None, :]] = False
        else:
            same = np.isin(left, right)
            if same.any():
                links[left[:, None] == right[None, :]] = False
        found = [(int(v), int(n), None) for v, n in zip(left, links.sum(axis=1), strict=True) if n]
        if key[0] != key[1]:
            found += [(int(v), int(n), None) for v, n in zip(right, links.sum(axis=0), strict=True) if n]
        found += [(int(a), 0, int(b)) for a, b in _forest(links, left, right)]
        table = pd.DataFrame(found, columns=["vec_id", "links", "other"])
        return table.astype({"vec_id": "int64", "links": "int64", "other": "Int64"})

    return run


def tile_links(vectors: DataFrame, dim: int, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (vec_id, links, other) of all tile pairs: link counts and forest edges."""
    n = vectors.count()
    groups = max(1, -(-n // TILE))
    axes = principal_axes(vectors, dim)
    placed = vectors.mapInArrow(_axis(axes[:, 0].copy()), "vec_id long, vec array<double>, place double")
    ordered = placed.repartitionByRange(groups, "place", "vec_id").sortWithinPartitions("place", "vec_id")
    blocks = stored(
        ordered.mapInArrow(_blocks(dim), "part long, low double, high double, ids binary, vecs binary")
    )
    # Partitions (their number is Spark's choice) fold into ``groups`` of neighbours.
    parts = blocks.agg(F.max("part")).first()[0]
    if parts is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, links long, other long")
    group = F.expr(f"part * {groups} div {parts + 1}")
    blocks = blocks.withColumn("group", group)
    reach = float(np.sqrt(2 - 2 * threshold)) + 1e-9
    span = blocks.groupBy("group").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    # Groups follow the axis, so partners within reach are a stretch of numbers.
    # The driver sees one interval per TILE vectors.
    spans = span.orderBy("group").toPandas()
    last = np.searchsorted(spans["low"], spans["high"] + reach, "right") - 1
    pairs = vectors.sparkSession.createDataFrame(
        [(int(g), int(spans["group"][h])) for g, h in zip(spans["group"], last, strict=True)],
        "group long, last long",
    )
    pairs = pairs.select(F.col("group").alias("lo"), F.explode(F.sequence("group", "last")).alias("hi"))
    member = F.explode(F.array_distinct(F.array("lo", "hi")))
    pairs = pairs.select("lo", "hi", member.alias("group"))
    rows = blocks.select("group", "ids", "vecs").join(pairs, "group")
    return rows.groupBy("lo", "hi").applyInPandas(
        _compare(axes, threshold), "vec_id long, links long, other long"
    )


def near_duplicates(
    table: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing, as do rows with a null id; vectors link only with those
    of their own length.  Rows that repeat an id are one vector, the least of
    them, and each gets its result.  A null id has a null component and is not kept.
    """
    vectors = clean_vectors(table, id_column, vector_column)
    vectors = stored(vectors.groupBy("vec_id").agg(F.min("vec").alias("vec")))
    dims = [r[0] for r in vectors.select(F.size("vec")).distinct().collect()]
    found = None
    for dim in sorted(dims):
        part = tile_links(vectors.where(F.size("vec") == dim), dim, threshold)
        found = part if found is None else found.union(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "vec_id long, links long, other long")
    found = stored(found)
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("n_links"))
    label = components(found.where("other IS NOT NULL").select(F.col("vec_id").alias("a"), F.col("other").alias("b")))
    counts = counts.join(label, counts.vec_id == label.id, "left").select("vec_id", "n_links", "component")
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"))
    rows = rows.join(counts, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return rows.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
