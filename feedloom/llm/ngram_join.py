"""N-gram Jaccard join by signature trees.

A document is its set of word shingles.  Two documents link when the sets'
Jaccard similarity reaches the threshold.  The join is exact:

1. Equal sets fold into one representative (a join on a 128-bit set hash).
2. Every set is ordered by one global order, shared shingles last.  Sets that
   link have their first common shingle within a short prefix, so the runs of
   documents that share a prefix shingle hold every link.
3. A few lowest hashes name a leader per shingle; verified links to leaders
   give first components.  They only save work: inside one component nothing
   is left to find.
4. Runs that span components and have the same two ends, by hash of the member,
   are one run with the members of all: shingles of one passage have much the same
   documents, which would else meet in a run for each shingle.
5. For each such run a signature tree is built: leaves are documents, nodes hold
   OR-combined bitmaps and size ranges, and a dual traversal drops node pairs
   whose largest possible overlap is too small.  What lies before a document's
   first shingle of the run is no part of an overlap that begins there.
6. Surviving pairs are verified on whole sets; links become components.

Runs over ``BLOCK`` documents are cut into blocks, and all pairs of blocks are
traversed, so no task holds an unbounded run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import WordHasher, components, long_rows, need_columns, shingles, stored

WORDS = 3
PERCENT = 90
# Bits of a bitmap: LEAST_BITS, and four times as many while a set is larger.
LEAST_BITS = 1024
MOST_BITS = 1 << 16
LEADERS = 4
BLOCK = 2048
FAN = 8
# Shingles of at least HOT documents come last in the global order, the most
# frequent at the very end.  The list is an ordering hint of bounded size; it
# cannot change a result.
HOT = 8
HOT_LIMIT = 1 << 18
# Words of 64 places of the filter that keeps documents without a candidate out of
# the verification's shuffle; the broadcast never has more rows than this.
PLACE_WORDS = 1 << 18


def required(total, percent: int):
    """Smallest overlap of two sets with ``total`` elements together."""
    return -((-percent * total) // (100 + percent))


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[bytes]:
    for text in batch.column(column).cast(pa.large_binary()):
        yield text.as_py() or b""


def _count_hot(words: int, floor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = WordHasher(), [], 0

        def flush():
            token, count = np.unique(np.concatenate(held), return_counts=True)
            token, count = token[count >= floor], count[count >= floor]
            return pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64)), pa.array(count.astype(np.int64))],
                ["token", "docs"],
            )

        for batch in batches:
            for data in _texts(batch, "text"):
                held.append(shingles(hasher.words(data), words))
                size += len(held[-1])
                if size > 1_000_000:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def hot_shingles(docs: DataFrame, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and their ranks by frequency; at most ``HOT_LIMIT``.

    All texts are counted.  Tasks leave out shingles seen once in a million,
    so the counts are lower bounds.
    """
    counted = docs.select("text").mapInArrow(_count_hot(words, 2), "token long, docs long")
    rows = (
        counted.groupBy("token")
        .agg(F.sum("docs").alias("docs"))
        .where(F.col("docs") >= HOT)
        .orderBy(F.desc("docs"), "token")
        .limit(HOT_LIMIT)
        .toPandas()
    )
    token = rows["token"].to_numpy(np.int64).view(np.uint64)
    rank = np.lexsort((token, rows["docs"].to_numpy(np.int64))).argsort()
    order = np.argsort(token)
    return token[order], rank[order]


def bitmap(s: np.ndarray) -> bytes:
    """One bit per element's hash; four times as many bits for four times the elements."""
    bits = LEAST_BITS
    while bits < min(len(s), MOST_BITS):
        bits *= 4
    out = np.zeros(bits, bool)
    out[(s >> np.uint64(7)) % np.uint64(bits)] = True
    return np.packbits(out).tobytes()


def folded(signs: np.ndarray, width: int) -> np.ndarray:
    """The same bitmaps at a smaller width, in 64-bit words."""
    return np.bitwise_or.reduce(signs.reshape(len(signs), -1, width), axis=1)


def _facts(words: int, percent: int, hot_list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, (hot, rank) = WordHasher(), hot_list.value
        for batch in batches:
            n, h1, h2, lead, rare, prefix, signs = [], [], [], [], [], [], []
            for data in _texts(batch, "text"):
                s = shingles(hasher.words(data), words)
                n.append(len(s))
                h1.append(int(np.sum(s * s + s, dtype=np.uint64).view(np.int64)))
                h2.append(int(np.bitwise_xor.reduce(s).view(np.int64)) if len(s) else 0)
                lead.append(s[:LEADERS].view(np.int64))
                rare.append(len(s))
                keep = len(s) - (percent * len(s) + 99) // 100 + 1 if len(s) else 0
                first = s
                if len(hot) and len(s):
                    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                    is_hot = hot[at] == s
                    rare[-1] -= int(is_hot.sum())
                    last = s[is_hot][np.argsort(rank[at[is_hot]])]
                    first = np.concatenate([s[~is_hot], last])
                prefix.append(first[:keep].view(np.int64))
                signs.append(bitmap(s))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(h1, pa.int64()),
                    pa.array(h2, pa.int64()),
                    pa.array(lead, longs),
                    pa.array(rare, pa.int64()),
                    pa.array(prefix, longs),
                    pa.array(signs, pa.binary()),
                ],
                ["doc_id", "n", "h1", "h2", "lead", "rare", "prefix", "sign"],
            )

    return run


def _ones(signs: np.ndarray) -> np.ndarray:
    return np.bitwise_count(signs).sum(axis=-1, dtype=np.int64)


class SignatureTree:
    """Levels from documents to the root; each node covers ``FAN`` nodes below.

    Per node: OR of the bitmaps, smallest and largest set size, most elements
    beyond one per bit, the range of component labels, and the most elements
    that may be shared (``rest``; without it, the whole sets).
    """

    def __init__(
        self, n: np.ndarray, signs: np.ndarray, label: np.ndarray, rest: np.ndarray | None = None
    ) -> None:
        self.order = np.lexsort((label, n))
        rest = (n if rest is None else rest)[self.order]
        n, signs, label = n[self.order], signs[self.order], label[self.order]
        level = (signs, n, n, n - _ones(signs), label, label, rest)
        self.levels = [level]
        ways = (np.bitwise_or, np.minimum, np.maximum, np.maximum, np.minimum, np.maximum, np.maximum)
        while len(level[1]) > 1:
            at = np.arange(0, len(level[1]), FAN)
            level = tuple(f.reduceat(x, at, axis=0) for f, x in zip(ways, level, strict=True))
            self.levels.append(level)


def _possible(a, i, b, j, percent: int) -> np.ndarray:
    """Which node pairs can hold a link between different components."""
    (sa, la, ha, xa, ca, da, ra), (sb, lb, hb, xb, cb, db, rb) = a, b
    most = _ones(sa[i] & sb[j]) + np.minimum(xa[i], xb[j])
    most = np.minimum(most, np.minimum(ra[i], rb[j]))
    fits = most >= required(la[i] + lb[j], percent)
    fits &= (100 * ha[i] >= percent * lb[j]) & (100 * hb[j] >= percent * la[i])
    return fits & ~((ca[i] == da[i]) & (cb[j] == db[j]) & (ca[i] == cb[j]))


def traverse(a: SignatureTree, b: SignatureTree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of document pairs that survive the dual traversal.

    With ``a is b`` each unordered pair comes once.  The frontier is taken in
    slices depth first, so it stays small.
    """
    same, found = a is b, []
    piece = max(64, (1 << 19) // a.levels[0][0].shape[1])  # 4 MB of bitmaps
    todo = [(len(a.levels) - 1, len(b.levels) - 1, np.zeros(1, int), np.zeros(1, int))]
    while todo:
        p, q, i, j = todo.pop()
        ok = _possible(a.levels[p], i, b.levels[q], j, percent)
        if same and p == 0 and q == 0:
            ok &= i < j
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if p == 0 and q == 0:
            found.append((a.order[i], b.order[j]))
            continue
        step = np.arange(FAN)
        if p >= q:
            i = (i[:, None] * FAN + step).ravel()
            j = np.repeat(j, FAN)
            j, i = j[i < len(a.levels[p - 1][1])], i[i < len(a.levels[p - 1][1])]
            down_p = p - 1
        else:
            down_p = p
        down_q = q
        if q >= p:
            i = np.repeat(i, FAN)
            j = (j[:, None] * FAN + step).ravel()
            i, j = i[j < len(b.levels[q - 1][1])], j[j < len(b.levels[q - 1][1])]
            down_q = q - 1
        if same:
            i, j = i[i <= j], j[i <= j]
        for cut in range(0, len(i), piece):
            todo.append((down_p, down_q, i[cut : cut + piece], j[cut : cut + piece]))
    none = np.zeros(0, int)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none)


def _tree_pairs(percent: int):
    """Sorted rows (run, lo, hi, part, doc_id, n, rest, label, sign) to candidate pairs."""

    def one(rows: dict) -> tuple[np.ndarray, np.ndarray]:
        """Traverses the trees of each two bitmap widths; the wider is folded."""
        lo, hi = rows["lo"][0], rows["hi"][0]
        sides = []
        for part in [lo] if lo == hi else [lo, hi]:
            own = np.flatnonzero(rows["part"] == part)
            size = np.array([len(rows["sign"][r]) for r in own])
            sides.append({w: own[size == w] for w in np.unique(size)})
        left, right = [], []
        for w, x in sides[0].items():
            for v, y in sides[-1].items():
                if lo == hi and v < w:
                    continue
                width = min(w, v) // 8
                trees = [
                    SignatureTree(
                        rows["n"][r],
                        folded(np.frombuffer(b"".join(rows["sign"][r]), np.uint64).reshape(len(r), -1), width),
                        rows["label"][r],
                        rows["rest"][r],
                    )
                    for r in ([x] if x is y else [x, y])
                ]
                i, j = traverse(trees[0], trees[-1], percent)
                left.append(rows["doc_id"][x][i])
                right.append(rows["doc_id"][y][j])
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *left]), np.concatenate([none, *right])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = ("run", "lo", "hi", "part", "doc_id", "n", "rest", "label"), None

        def pairs(rows: dict, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
            left, right, size = [], [], 0
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                a, b = one({k: v[s:e] for k, v in rows.items()})
                left.append(np.minimum(a, b))
                right.append(np.maximum(a, b))
                size += len(a)
                if size > 100_000 or e == cuts[-1]:
                    found = [pa.array(np.concatenate(x)) for x in (left, right)]
                    yield pa.RecordBatch.from_arrays(found, ["a", "b"])
                    left, right, size = [], [], 0

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {k: batch.column(k).to_numpy() for k in names}
            rows["sign"] = np.array(batch.column("sign").to_pylist(), object)
            if held is not None:
                rows = {k: np.concatenate([held[k], v]) for k, v in rows.items()}
            change = np.zeros(len(rows["n"]), bool)
            for k in names[:3]:
                change[1:] |= rows[k][1:] != rows[k][:-1]
            cuts = np.concatenate([[0], np.flatnonzero(change)])
            if len(cuts) > 1:
                yield from pairs(rows, cuts)
            held = {k: v[cuts[-1] :] for k, v in rows.items()}
        if held is not None:
            yield from pairs(held, np.array([0, len(held["n"])]))

    return run


def _bounded(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keep = np.zeros(batch.num_rows, bool)
            signs = [np.array(batch.column(f"sign_{s}").to_pylist(), object) for s in "ab"]
            sizes = np.array([[len(x) for x in side] for side in signs])
            for w, v in np.unique(sizes, axis=1).T:
                own, sides = np.flatnonzero((sizes[0] == w) & (sizes[1] == v)), []
                for s, side in zip("ab", signs, strict=True):
                    sign = np.frombuffer(b"".join(side[own]), np.uint64).reshape(len(own), -1)
                    sign = folded(sign, min(w, v) // 8)
                    n, label = (batch.column(c).to_numpy()[own] for c in (f"n_{s}", s))
                    sides.append((sign, n, n, n - _ones(sign), label, label, n))
                at = np.arange(len(own))
                keep[own] = _possible(sides[0], at, sides[1], at, percent)
            keep = pa.array(keep)
            yield batch.select(["a", "b"]).filter(keep)

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            sets = [shingles(hasher.words(d), words).tobytes() for d in _texts(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sets, pa.binary())],
                ["doc_id", "elements"],
            )

    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def verified(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    place = F.xxhash64("doc_id")
    word, bit = F.pmod(place, F.lit(PLACE_WORDS)).alias("word"), F.expr("int(shiftrightunsigned(xxhash64(doc_id), 58))")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
    mask = F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")
    places = ids.select(word, bit.alias("bit")).groupBy("word").agg(mask)
    # At most PLACE_WORDS rows, whatever the input.
    docs = docs.withColumn("word", word).join(F.broadcast(places), "word").where(F.bit_get("mask", bit) == 1)
    sets = docs.select("doc_id", "text").mapInArrow(_sets(words), "doc_id long, elements binary")
    for s in "ab":
        side = sets.select(F.col("doc_id").alias(s), F.col("elements").alias(f"set_{s}"))
        # Shuffled, so that no task needs two Python workers, which stay in memory.
        pairs = pairs.join(side.hint("shuffle_merge"), s)
    return pairs.select("a", "b", "set_a", "set_b").mapInArrow(
        _linked(percent), "a long, b long"
    ).distinct()


def _leader_pairs(reps: DataFrame, percent: int) -> DataFrame:
    """Each document with the leaders of its lowest hashes.

    A shingle's leader has the fewest rare shingles: of a group of copies with edits
    of their own that is the text they come from, which links with more of them than
    they do with each other.
    """
    low = reps.select("doc_id", "rare", F.explode("lead").alias("token"))
    leader = low.groupBy("token").agg(
        F.min(F.struct("rare", "doc_id"))["doc_id"].alias("b"), F.count("*").alias("docs")
    )
    pairs = low.join(leader.where("docs > 1"), "token").where("doc_id <> b")
    pairs = pairs.select(F.col("doc_id").alias("a"), "b").distinct()
    for s in "ab":
        side = reps.select(
            F.col("doc_id").alias(s), F.col("n").alias(f"n_{s}"), F.col("sign").alias(f"sign_{s}")
        )
        pairs = pairs.join(side, s)
    return pairs.mapInArrow(_bounded(percent), "a long, b long").distinct()


def _run_members(reps: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Members (run, k, n, rest, label) of the runs of prefix shingles that span components.

    A run's members are set classes, each once, however many rows have the set.
    ``rest`` counts a member's elements from the first that it shares with the run.
    """
    reps = reps.join(label, reps.doc_id == label.id, "left").withColumn("label", F.coalesce("component", "doc_id"))
    rows = reps.select("k", "n", "label", F.posexplode("prefix").alias("at", "token"))
    rows = rows.select("token", "k", "n", "label", (F.col("n") - F.col("at")).alias("rest"))
    # Dealt by shingle once, for the count and for the join.
    rows = rows.where("token IS NOT NULL").repartition("token")
    runs = rows.groupBy("token").agg(
        F.count("*").alias("docs"),
        F.max(_short(percent)).alias("short"),
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        # Of a hash that took two runs for one, there would only be more pairs to drop.
        F.xxhash64(F.min(F.xxhash64("k")), F.max(F.xxhash64("k"))).alias("run"),
    )
    runs = runs.where("docs > 1 AND low < high AND short").select("token", "run")
    return rows.join(runs, "token").groupBy("run", "k").agg(
        F.first("n").alias("n"), F.max("rest").alias("rest"), F.first("label").alias("label")
    )


def _short(percent: int) -> Column:
    """Whether a member can be the smaller set of a link that begins in its run."""
    return (100 + percent) * F.col("rest") >= 2 * percent * F.col("n")


def _run_pairs(reps: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs from the runs of prefix shingles that span components."""
    members = stored(_run_members(reps, label, percent))
    sizes = members.groupBy("run").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    members = members.join(sizes, "run")
    members = members.withColumn("part", F.pmod(F.xxhash64("k"), F.col("parts")))
    # Of a run in one part, only documents with one of like size beside them matter.
    beside = W.partitionBy("run", "part").orderBy("n", "k")
    smaller = F.max(F.when(_short(percent), F.col("n"))).over(beside.rowsBetween(W.unboundedPreceding, -1))
    near = (100 * smaller >= percent * F.col("n")) | (
        _short(percent) & (100 * F.col("n") >= percent * F.lead("n").over(beside))
    )
    members = members.withColumn("near", near).where("near OR parts > 1")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    members = members.withColumn("other", other).select(
        "run",
        F.least("part", "other").alias("lo"),
        F.greatest("part", "other").alias("hi"),
        "part",
        "k",
        "rest",
        "label",
    )
    full = members.join(reps.select("k", "doc_id", "n", "sign"), "k")
    full = full.select("run", "lo", "hi", "part", "doc_id", "n", "rest", "label", "sign")
    full = full.repartition("run", "lo", "hi").sortWithinPartitions("run", "lo", "hi")
    return full.mapInArrow(_tree_pairs(percent), "a long, b long").distinct()


def jaccard_components(
    documents: DataFrame, words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles, component_id.

    Null and empty texts have no shingles and link with nothing.  A null doc_id
    gets a null component and links with nothing.  Rows that repeat a doc_id
    are one document for links and keep a row each.  Other columns are ignored.
    """
    need_columns(documents, "doc_id", "text")
    docs = long_rows(documents).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hot = docs.sparkSession.sparkContext.broadcast(hot_shingles(docs, words))
    facts = stored(
        docs.mapInArrow(
            _facts(words, percent, hot),
            "doc_id long, n long, h1 long, h2 long, lead array<long>, rare long, prefix array<long>, sign binary",
        )
    )
    known = facts.where("doc_id IS NOT NULL AND n > 0")
    # Equal sets have equal leads, prefixes and bitmaps; the smallest doc_id stands for them.
    classes = known.groupBy("h1", "h2", "n").agg(
        F.min("doc_id").alias("doc_id"),
        F.first("lead").alias("lead"),
        F.first("rare").alias("rare"),
        F.first("prefix").alias("prefix"),
        F.first("sign").alias("sign"),
    )
    # Texts that share a doc_id are classes of their own, so classes are numbered.
    classes = stored(classes.withColumn("k", F.monotonically_increasing_id()))
    reps = classes.select("k", "doc_id", "n", "lead", "rare", "prefix", "sign")
    classes = classes.select("h1", "h2", "n", F.col("doc_id").alias("rep"))
    texts = docs.where("doc_id IS NOT NULL")
    near = verified(texts, stored(_leader_pairs(reps, percent)), words, percent)
    label = components(near)
    rest = verified(texts, stored(_run_pairs(reps, label, percent)), words, percent)
    texts_of = F.struct("h1", "h2", "n")
    repeated = known.groupBy("doc_id").agg(F.min(texts_of).alias("x"), F.max(texts_of).alias("y"))
    repeated = known.join(repeated.where("x < y").select("doc_id"), "doc_id", "left_semi")
    repeated = repeated.join(classes, ["h1", "h2", "n"]).select("doc_id", "rep")
    label = components(label.toDF("a", "b").union(rest).union(repeated))
    classes = classes.join(label, classes.rep == label.id, "left").select(
        "h1", "h2", "n", F.coalesce("component", "rep").alias("class_component")
    )
    out = facts.select("doc_id", "n", "h1", "h2").join(classes, ["h1", "h2", "n"], "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNull(), None)
        .otherwise(F.coalesce("class_component", "doc_id"))
        .alias("component_id"),
    )
