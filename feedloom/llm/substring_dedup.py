"""Removal of repeated passages: runs of ``size`` words that occur earlier.

1. Every task counts windows in a count-min sketch; the merged sketch
   overestimates every window's count.  To spare cells, a window is counted by
   its least run of ``size // 2`` words: windows with equal words have equal least
   runs, so that run occurs at least as often as the window, and neighbouring
   windows share it.
2. A second pass takes the windows whose estimate is 2 or more and groups them
   exactly, by two 64-bit hashes.  A task first groups its own: only the earliest
   occurrence it saw of each window is shuffled as a candidate, so a passage that
   all documents share costs a row per task.
3. All occurrences but the first are later ones; the words they cover go.

The sketch has a fixed size (``BITS``, ``LINES``).  It prunes well up to about a
hundred million windows; beyond that more windows reach the exact grouping, with
the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import WordHasher, mix, need_columns
from feedloom.llm.sketch import CHUNKS, CountSketch, merged

SIZE = 20
BITS = 26
LINES = 2
# Items a task holds before it counts or groups them.
HELD = 1 << 20
LAST = np.iinfo(np.int64).max


class CaseHasher(WordHasher):
    """Hashes of words as written."""

    def __init__(self) -> None:
        super().__init__()
        code = np.arange(256, dtype=np.uint64)
        self.value = mix(code + np.uint64(0x632BE59BD9B4E019))
        self.value[self.gap] = 0

    def runs(self, words: np.ndarray, size: int) -> np.ndarray:
        """Hashes of all runs of ``size`` words."""
        count = len(words) - size + 1
        if count < 1:
            return np.zeros(0, np.uint64)
        self._reach(len(words) + 1)
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * self.power[: len(words)], out=sums[1:])
        return mix((sums[size:] - sums[:-size]) * self.inverse[:count])


def least(values: np.ndarray, span: int, way=np.minimum) -> np.ndarray:
    """Smallest (or largest) of every ``span`` neighbours."""
    out, have = values, 1
    while have < span:
        step = min(have, span - have)
        out = way(out[:-step], out[step:])
        have += step
    return out


def least_runs(hasher: CaseHasher, words: np.ndarray, size: int) -> np.ndarray:
    """Per window of ``size`` words the least hash of its runs of half that size."""
    half = max(1, size // 2)
    return least(hasher.runs(words, half), size - half + 1)


def chosen_runs(hasher: CaseHasher, words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs that are the least of some window, once per place."""
    half = max(1, size // 2)
    span = size - half + 1
    runs = hasher.runs(words, half)
    if len(runs) < span:
        return runs[:0]
    # A run is chosen if it equals the greatest minimum of the windows around it.
    edge = np.zeros(span - 1, np.uint64)
    around = least(np.concatenate([edge, least(runs, span), edge]), span, np.maximum)
    return runs[runs == around]


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for at in range(0, batch.num_rows, 256):
        for text in batch.column("text").slice(at, 256).cast(pa.large_binary()):
            yield text.as_py() or b""


def _count(size: int, bits: int, lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sketch, held, n = CaseHasher(), CountSketch(bits, lines), [], 0
        for batch in batches:
            for data in _texts(batch):
                held.append(chosen_runs(hasher, hasher.words(data), size))
                n += len(held[-1])
                if n > HELD:
                    sketch.add(np.concatenate(held))
                    held, n = [], 0
        if held:
            sketch.add(np.concatenate(held))
        yield from sketch.chunks()

    return run


# What is known to be a later occurrence has 0 for h2.
OCCURRENCE = "h1 long, h2 long, doc long, place long"


def _grouped(held: list[tuple]) -> pa.RecordBatch:
    """Occurrences of one task: the earliest of each window stay open, the others are later."""
    h1, h2, doc, place = (np.concatenate(x) for x in zip(*held, strict=True))
    h2 = np.maximum(h2, np.uint64(1))
    order = np.lexsort((place, doc, h1))
    a, b, d, p = h1[order], h2[order], doc[order], place[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    once = new.copy()  # equal rows are at one place
    once[1:] |= (p[1:] != p[:-1]) | (d[1:] != d[:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    later, keep = np.empty(len(a), bool), np.empty(len(a), bool)
    later[order], keep[order] = (d != d[first]) | (p >> 32 != p[first] >> 32), once
    # In the order of the texts, so that shuffled rows resemble their neighbours.
    h1 = np.where(later, mix(doc.view(np.uint64)), h1)
    h2 = np.where(later, np.uint64(0), h2)
    columns = [pa.array(x[keep]) for x in (h1.view(np.int64), h2.view(np.int64), doc, place)]
    return pa.RecordBatch.from_arrays(columns, ["h1", "h2", "doc", "place"])


def _occurrences(size: int, repeated: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, bits, held, n = CaseHasher(), repeated.value, [], 0
        for batch in batches:
            docs = batch.column("doc").to_numpy()
            prints = batch.column("print").to_numpy() & 0xFFFFFFFF
            for doc, own, data in zip(docs, prints, _texts(batch), strict=True):
                words = hasher.words(data)
                if len(words) < size:
                    continue
                at = np.flatnonzero(bits.may_reach(least_runs(hasher, words, size)))
                if not len(at):
                    continue
                h1 = hasher.runs(words, size)[at]
                h2 = hasher.runs(mix(words + np.uint64(0x5851F42D4C957F2D)), size)[at]
                held.append((h1, h2, np.full(len(at), doc), (at.astype(np.int64) << 32) | own))
                n += len(at)
                if n > HELD:
                    yield _grouped(held)
                    held, n = [], 0
        if held:
            yield _grouped(held)

    return run


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted occurrences to those that are not the first of their window."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, doc, place = (c.to_numpy() for c in batch.columns)
        out = h2 == 0
        open_at = np.flatnonzero(~out)
        if len(open_at):
            h1, h2, d, p = h1[open_at], h2[open_at], doc[open_at], place[open_at] >> 32
            if last is not None:
                h1, h2, d, p = (np.concatenate([[x], y]) for x, y in zip(last, (h1, h2, d, p), strict=True))
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            found = (d != d[first]) | (p != p[first])
            out[open_at] = found[-len(open_at) :]
            last = tuple(x[first[-1]] for x in (h1, h2, d, p))
        yield pa.RecordBatch.from_arrays([pa.array(doc[out]), pa.array(place[out])], ["doc", "place"])


def covered(count: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Which of ``count`` words the windows that begin at ``starts`` cover."""
    step = np.zeros(count + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + size, -1)
    return np.cumsum(step[:-1]) > 0


def _kept(size: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n, gone, digest, kept = [], [], [], []
                for data, starts in zip(_texts(part), part.column("starts"), strict=True):
                    words = data.split()  # at the six ASCII white-space bytes
                    n.append(len(words))
                    if starts.is_valid:
                        cover = covered(len(words), np.asarray(starts.values, np.int64), size)
                        gone.append(int(cover.sum()))
                        words = [w for w, c in zip(words, cover.tolist(), strict=True) if not c]
                    else:
                        gone.append(0)
                    text = b" ".join(words)
                    digest.append(hashlib.sha256(text).hexdigest())
                    if with_text:
                        kept.append(text.decode())
                columns = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest)]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    columns, names = [*columns, pa.array(kept, pa.string())], [*names, "kept_text"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def remove_repeated(
    documents: DataFrame,
    size: int = SIZE,
    with_text: bool = False,
    bits: int = BITS,
    lines: int = LINES,
) -> DataFrame:
    """Per row of ``documents``: doc_id, n_words, n_removed, kept_sha256 (and kept_text).

    A word goes if a window of ``size`` words covers it whose words also start
    earlier: in a smaller doc_id, or earlier in the same document.  Null and empty
    texts have no words.  A null doc_id comes after all others.  Rows that share a
    doc_id are at the same place, so none of two equal rows is earlier and both
    keep the same words.  Ties cannot occur otherwise; other columns are ignored.
    """
    need_columns(documents, "doc_id", "text")
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST)))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        doc.alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"),
        "text",
    )
    chunks = rows.select("text").mapInArrow(_count(size, bits, lines), CHUNKS)
    repeated = rows.sparkSession.sparkContext.broadcast(merged(chunks, 2, bits, lines))
    seen = rows.select("doc", "print", "text").mapInArrow(_occurrences(size, repeated), OCCURRENCE)
    seen = seen.repartition("h1").sortWithinPartitions("h1", "h2", "doc", "place")
    later = seen.mapInArrow(_later, "doc long, place long")
    own = F.col("place").bitwiseAND(0xFFFFFFFF)
    starts = F.shiftright("place", 32).cast("int")
    later = later.groupBy("doc", own.alias("own")).agg(F.collect_set(starts).alias("starts"))
    rows = rows.withColumn("own", F.col("print").bitwiseAND(0xFFFFFFFF))
    rows = rows.join(later, ["doc", "own"], "left").select("doc_id", "text", "starts")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return rows.mapInArrow(_kept(size, with_text), schema + (", kept_text string" if with_text else ""))
