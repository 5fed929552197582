"""Hard-negative mining by exact integer products in a residue number system.

Components become integers.  Score matrices are computed modulo a few primes, in
float32: residues are balanced around zero and a stretch of dimensions is so
short that every partial sum is a whole number below 2**24, so each product is
exact.  Balanced mixed-radix digits (Chinese remaindering) give back the signed
score; as many primes are taken as the lengths of the vectors at hand call for.

Rows are sorted by (dimensions, label) into tiles; anchors likewise into stripes.
A task holds one stripe and streams tiles past it, keeping only the best rows of
each window.  The first pass finds positives and compares only tiles that share a
label with the stripe; the second finds negatives inside the windows the
positives set, and leaves out tiles of the stripe's one label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import need_columns, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
# Window of a negative's score, in percent of the positive's.
LOW, HIGH = 30, 90
TILE = 4096
STRIPE = 1 << 15
# Tiles of a task, unless a stripe then had more than MOST_TASKS tasks.
TASK_TILES, MOST_TASKS = 4, 4096
# Anchors multiplied at once.
SLICE = 512
# Scores are 64-bit, so squared lengths must stay below this.
LONGEST = float(1 << 62)
NONE = np.iinfo(np.int64).min
TOP = np.iinfo(np.int64).max


def primes_below(limit: int) -> Iterator[int]:
    for n in range(limit - 1 - limit % 2, 2, -2):
        if all(n % d for d in range(3, int(n**0.5) + 1, 2)):
            yield n


def residue_system(dim: int, bound: float) -> tuple[list[int], int]:
    """Primes whose product exceeds 2 * bound, and the dimensions per float32 sum.

    With residues up to h = (p - 1) / 2, sums of ``step`` products stay below
    step * h * h < 2**24.
    """
    step = max(1, min(dim, 64))
    limit = 2 * int((((1 << 24) - 1) // step) ** 0.5)
    primes, product = [], 1
    for p in primes_below(limit):
        primes.append(p)
        product *= p
        if product > 2 * int(bound) + 1:
            return primes, step
    raise ValueError("scores do not fit")


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Whole numbers to residues between -(p - 1) / 2 and (p - 1) / 2."""
    r = np.mod(x, p)
    return r - p * (r > p // 2)


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """``np.mod`` of whole doubles is exact, however large they are."""
    return [_balanced(x, p).astype(np.float32) for p in primes]


def exact_products(a: list[np.ndarray], b: list[np.ndarray], primes: list[int], step: int) -> np.ndarray:
    """All inner products of the rows of two matrices given by their residues."""
    digits: list[np.ndarray] = []
    out = None
    radix = 1
    for i, p in enumerate(primes):
        total = None
        for at in range(0, a[i].shape[1], step):
            part = a[i][:, at : at + step] @ b[i][:, at : at + step].T
            part = part.astype(np.int32)
            part %= p
            total = part if total is None else (total + part) % p
        # Take off the digits before, one radix at a time.
        for q, digit in zip(primes, digits, strict=False):
            total = (total - digit) % p * pow(q, -1, p) % p
        total = total - p * (total > p // 2)
        digits.append(total)
        more = total.astype(np.int64) * np.int64(np.uint64(radix % (1 << 64)).view(np.int64))
        out = more if out is None else out + more  # modulo 2**64; the end result fits
        radix *= p
    return out


class Best:
    """The first ``keep`` rows of each window of each anchor: highest score, then smallest id."""

    def __init__(self, low: np.ndarray, high: np.ndarray, keep: int) -> None:
        self.low, self.high, self.keep = low, high, keep  # anchors x windows; empty if low > high
        self.floor = low.copy()
        self.rows: dict[int, list[np.ndarray]] = {}

    def add(self, first: int, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        """Rows of one tile for the anchors from ``first`` on; ``scores`` is overwritten."""
        scores[~allowed] = NONE
        own = slice(first, first + len(scores))
        found = [self.rows[first]] if first in self.rows else []
        for w in range(self.low.shape[1]):
            high, floor = self.high[own, w], self.floor[own, w]
            fits = (scores <= high[:, None]) & (scores >= floor[:, None]) & (scores > NONE)
            many = np.flatnonzero(fits.sum(axis=1) > 4 * self.keep)
            if len(many):
                inside = np.where(fits[many], scores[many], NONE)
                cut = np.partition(inside, -self.keep, axis=1)[:, -self.keep]
                fits[many] &= scores[many] >= cut[:, None]
            i, j = np.nonzero(fits)
            if len(i):
                found.append(np.stack([i, np.full(len(i), w), scores[i, j], ids[j], labels[j]]))
        if not found:
            return
        rows = np.concatenate(found, axis=1)
        order = np.lexsort((rows[4], rows[3], ~rows[2], rows[1], rows[0]))
        rows = rows[:, order]
        new = np.ones(rows.shape[1], bool)
        new[1:] = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
        starts = np.flatnonzero(new)
        rank = np.arange(rows.shape[1]) - starts[np.cumsum(new) - 1]
        last = rank == self.keep - 1
        self.floor[first + rows[0, last], rows[1, last]] = rows[2, last]
        self.rows[first] = rows[:, rank < self.keep]


def clean_rows(table: DataFrame) -> DataFrame:
    """Rows that take part: dim, label, vec_id, q (whole numbers as doubles)."""
    need_columns(table, "vec_id", "embedding", "label")
    rows = table.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vec"),
    )
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull())
    rows = rows.where(F.forall("vec", finite))
    # Multiplying by a power of two and rounding down are exact in doubles.
    scaled = F.transform("vec", lambda v: v * F.lit(float(SCALE)))
    rows = rows.select("vec_id", "label", F.size("vec").alias("dim"), scaled.alias("q"))
    square = F.aggregate("q", F.lit(0.0), lambda s, v: s + v * v)
    return rows.where(square < LONGEST)


def _tiles(size: int):
    """Sorted rows to blocks of at most ``size``; a repeated (dim, label, vec_id) counts once."""
    names = ("block", "dim", "low", "high", "ids", "labels", "q")

    def block(part: int, at: int, dim: int, labels, ids, q) -> pa.RecordBatch:
        kind = next(t for t in (np.int16, np.int32, np.float64) if t is np.float64 or np.abs(q).max(initial=0) < np.iinfo(t).max)
        values = [(part << 32) + at, dim, labels[0], labels[-1], ids.tobytes(), labels.tobytes(), q.astype(kind).tobytes()]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at, last = TaskContext.get().partitionId(), 0, None
        held, held_dim = [], None

        def flush(all_of_them: bool):
            nonlocal held, at
            if not held:
                return
            labels, ids, q = (np.concatenate(x) for x in zip(*held, strict=True))
            end = len(ids) if all_of_them else len(ids) // size * size
            for s in range(0, end, size):
                e = min(s + size, end)
                yield block(part, at, held_dim, labels[s:e], ids[s:e], q[s:e])
                at += 1
            held = [(labels[end:], ids[end:], q[end:])] if end < len(ids) else []

        for batch in batches:
            if not batch.num_rows:
                continue
            dims, labels, ids = (batch.column(c).to_numpy() for c in ("dim", "label", "vec_id"))
            flat, ends = np.asarray(batch.column("q").flatten(), np.float64), np.cumsum(dims)
            cuts = np.concatenate([[0], np.flatnonzero(dims[1:] != dims[:-1]) + 1, [len(dims)]])
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                dim = int(dims[s])
                q = np.floor(flat[ends[s] - dim : ends[e - 1]].reshape(e - s, dim))
                key = np.stack([np.full(e - s, dim), labels[s:e], ids[s:e]])
                before = np.concatenate([key[:, :1] - 1 if last is None else last, key[:, :-1]], axis=1)
                new, last = (key != before).any(axis=0), key[:, -1:]
                if dim != held_dim:
                    yield from flush(True)
                    held_dim = dim
                held.append((labels[s:e][new].astype(np.int64), ids[s:e][new].astype(np.int64), q[new]))
                if sum(len(h[1]) for h in held) >= size:
                    yield from flush(False)
        yield from flush(True)

    return run


BLOCK = "block long, dim int, low long, high long, ids binary, labels binary, q binary"


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows in blocks of neighbours by (dim, label, vec_id)."""
    key = ("dim", "label", "vec_id")
    ordered = rows.select(*key, "q").repartitionByRange(*key).sortWithinPartitions(*key, "q")
    return ordered.mapInArrow(_tiles(size), BLOCK)


class Block:
    def __init__(self, dim, ids, labels, q) -> None:
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        n = len(self.ids)
        kind = {2: np.int16, 4: np.int32, 8: np.float64}[len(q) // (n * dim)] if dim else np.int16
        # A vector without components has score 0 with its like.
        self.q = np.frombuffer(q, kind).reshape(n, dim).astype(np.float64) if dim else np.zeros((n, 1))
        self.square = float((self.q**2).sum(axis=1).max())


FOUND = "anchor_id long, anchor_label long, dim int, stripe long, place int, positive_id long, positive_score long, vec_id long, score long"


def _compare(keep: int, negatives: bool):
    """Sorted rows (stripe, chunk, kind, ...) to the best rows per anchor and window.

    Kind 0 is the stripe, kind 1 (second pass) its positives, kind 2 a tile.
    """
    names = [c.split()[0] for c in FOUND.split(", ")]
    types = [pa.int32() if c.endswith(" int") else pa.int64() for c in FOUND.split(", ")]

    def windows(stripe: Block, given: dict | None):
        """Low and high scores, and the positives, as anchors x windows."""
        shape = (len(stripe.ids), POSITIVES if negatives else 1)
        if not negatives:
            return np.full(shape, NONE + 1), np.full(shape, TOP), None
        low, high, ids, score = np.full(shape, TOP), np.full(shape, NONE), np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        if given is not None:
            at, rank = given["place"], given["rank"]
            s = given["score"]
            # 100 n >= LOW s and 100 n <= HIGH s, without leaving 64 bits.
            low[at, rank] = s // 100 * LOW + -(-(s % 100 * LOW) // 100)
            high[at, rank] = s // 100 * HIGH + s % 100 * HIGH // 100
            ids[at, rank], score[at, rank] = given["id"], s
        return low, high, (ids, score)

    def result(number: int, dim: int, stripe: Block, best: Best, positives) -> Iterator[pa.RecordBatch]:
        for first, rows in best.rows.items():
            i, w, score, ids, _ = rows
            i = i + first
            none = np.zeros(len(i), np.int64)
            given = (none, none) if positives is None else (positives[0][i, w], positives[1][i, w])
            columns = [stripe.ids[i], stripe.labels[i], none + dim, none + number, i, *given, ids, score]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)).cast(t) for c, t in zip(columns, types, strict=True)], names
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, stripe, best, positives, systems = None, None, None, None, {}
        given = None
        for batch in batches:
            for row in range(batch.num_rows):
                r = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                if r["kind"] == 0:
                    if best is not None:
                        yield from result(*now, stripe, best, positives)
                    now, stripe = (r["stripe"], r["dim"]), Block(r["dim"], r["ids"], r["labels"], r["q"])
                    best, given, systems = None, None, {}
                    continue
                if r["kind"] == 1:
                    found = r["found"]
                    given = {k: np.array([f[k] for f in found], np.int64) for k in ("place", "rank", "id", "score")}
                    continue
                if best is None:
                    low, high, positives = windows(stripe, given)
                    best = Best(low, high, keep)
                tile = Block(r["dim"], r["ids"], r["labels"], r["q"])
                bound = 1.001 * (stripe.square * tile.square) ** 0.5 + 1
                primes, step = residue_system(stripe.q.shape[1], bound)
                if len(primes) not in systems:
                    systems[len(primes)] = residues(stripe.q, primes)
                a, b = systems[len(primes)], residues(tile.q, primes)
                for at in range(0, len(stripe.ids), SLICE):
                    own = slice(at, at + SLICE)
                    scores = exact_products([x[own] for x in a], b, primes, step)
                    same = stripe.labels[own, None] == tile.labels
                    allowed = (~same if negatives else same) & (stripe.ids[own, None] != tile.ids)
                    best.add(at, scores, allowed, tile.ids, tile.labels)
        if best is not None:
            yield from result(*now, stripe, best, positives)

    return run


def _pass(stripes: DataFrame, tiles: DataFrame, tasks: int, positives: DataFrame | None, keep: int) -> DataFrame:
    """Every stripe against the tiles it can have partners in."""
    s = stripes.select(F.col("block").alias("stripe"), "dim", F.col("low").alias("from"), F.col("high").alias("to"))
    if positives is None:
        meets = "from <= high AND low <= to"
    else:
        meets = "NOT (from = to AND low = high AND from = low)"
    chunk = F.pmod(F.xxhash64("block"), F.lit(tasks)).cast("int")
    body = ("stripe", "chunk", "kind", "dim", "ids", "labels", "q")
    # One short row per STRIPE anchors; past a million of them Spark chooses the join.
    s = F.broadcast(s) if stripes.count() <= 1 << 20 else s
    facing = tiles.join(s, "dim").where(meets).withColumn("chunk", chunk).withColumn("kind", F.lit(2))
    every = F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("chunk")
    held = stripes.select(F.col("block").alias("stripe"), every, F.lit(0).alias("kind"), "dim", "ids", "labels", "q")
    rows = held.select(*body).union(facing.select(*body))
    found = "array<struct<place:int,rank:int,id:bigint,score:bigint>>"
    rows = rows.withColumn("found", F.lit(None).cast(found))
    if positives is not None:
        none = F.lit(None)
        given = positives.groupBy("stripe").agg(F.collect_list(F.struct("place", "rank", "id", "score")).alias("found"))
        given = given.select(
            "stripe", every, F.lit(1).alias("kind"), none.cast("int"), none.cast("binary"), none.cast("binary"),
            none.cast("binary"), F.col("found").cast(found),
        )
        rows = rows.union(given)
    rows = rows.repartition("stripe", "chunk").sortWithinPartitions("stripe", "chunk", "kind")
    return rows.mapInArrow(_compare(keep, positives is not None), FOUND)


def mine_hard_negatives(table: DataFrame, relabel_every: int = 7, anchor_every: int = 100) -> DataFrame:
    """Rows anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null id, label or vector, or with null or non-finite components,
    take no part, nor do vectors too long for 64-bit scores (squared length 2**62
    after scaling).  Vectors meet only those of their own number of components; of
    none at all, all scores are 0.  Rows that repeat vec_id and label count once
    (the least vector); a vec_id with several labels is a row per label, and none
    of them is a partner of another.  Ties go to the smaller vec_id.  Other
    columns are ignored.
    """
    rows = clean_rows(table)
    if relabel_every:
        changed = F.when(F.col("vec_id") % relabel_every == 0, (F.col("label") + 1) % 10)
        rows = rows.withColumn("label", changed.otherwise(F.col("label")))
    tiles = stored(blocks(rows, TILE))
    stripes = stored(blocks(rows.where(F.col("vec_id") % anchor_every == 0), STRIPE))
    count = tiles.count()
    tasks = max(1, min(-(-count // TASK_TILES), MOST_TASKS))
    best = _pass(stripes, tiles, tasks, None, POSITIVES)
    # The tasks' lists meet in a bounded rank.
    by_anchor = ("stripe", "place")
    order = W.partitionBy(*by_anchor).orderBy(F.desc("score"), "vec_id")
    positives = best.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < POSITIVES)
    positives = stored(positives.select(*by_anchor, "rank", F.col("vec_id").alias("id"), "score"))
    found = _pass(stripes, tiles, tasks, positives, NEGATIVES)
    order = W.partitionBy("stripe", "place", "positive_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEGATIVES)
    return found.select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
