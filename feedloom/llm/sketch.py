"""Count-min sketches of one fixed size, merged over all partitions.

A sketch has ``lines`` rows of ``1 << bits`` cells of one byte, which stop
counting at 255.  Every task adds what it sees to a sketch of its own; the
sketches are cut into chunks, shuffled by chunk and added up.  Of the sums only
one bit per cell is kept: whether it reached the floor.  So what reaches the
driver and goes out to the tasks has ``lines << bits`` bits, whatever the input.
A cell's sum is never below the count of any item in it: ``may_reach`` errs only
towards true.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedloom.llm.common import mix

MOST = 255
CHUNK_BITS = 20
CHUNKS = "line int, chunk int, cells binary"
_SALTS = (0x9D5C3A2F61E874B3, 0x3F84D5B5B5470917, 0xA24BAED4963EE407, 0x71C18A0D2B6F9E55)


def cells_of(hashes: np.ndarray, line: int, bits: int) -> np.ndarray:
    return (mix(hashes ^ np.uint64(_SALTS[line])) >> np.uint64(64 - bits)).astype(np.int64)


class CountSketch:
    def __init__(self, bits: int, lines: int) -> None:
        self.bits = bits
        self.counts = np.zeros((lines, 1 << bits), np.uint8)

    def add(self, hashes: np.ndarray, times: np.ndarray | None = None) -> None:
        """Count items by 64-bit hash; ``times`` are whole numbers."""
        for line, counts in enumerate(self.counts):
            cell = cells_of(hashes, line, self.bits)
            if times is None:
                cell, more = np.unique(cell, return_counts=True)
            else:
                cell, at = np.unique(cell, return_inverse=True)
                more = np.bincount(at, times)
            counts[cell] = np.minimum(counts[cell] + more, MOST).astype(np.uint8)

    def chunks(self) -> Iterator[pa.RecordBatch]:
        """The chunks that hold any count, compressed."""
        step = 1 << min(CHUNK_BITS, self.bits)
        for line, counts in enumerate(self.counts):
            for chunk, at in enumerate(range(0, len(counts), step)):
                part = counts[at : at + step]
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([line], pa.int32()),
                            pa.array([chunk], pa.int32()),
                            pa.array([zlib.compress(part, 1)], pa.binary()),
                        ],
                        ["line", "chunk", "cells"],
                    )


def _reached(floor: int):
    """Sorted chunks to one row per chunk: a bit per cell whose sum is at least ``floor``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(key, total):
            bits = np.packbits(total >= floor, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([bits], pa.binary())],
                ["line", "chunk", "cells"],
            )

        last, total = None, None
        for batch in batches:
            for line, chunk, cells in zip(*batch.columns, strict=True):
                key = (line.as_py(), chunk.as_py())
                part = np.frombuffer(zlib.decompress(cells.as_py()), np.uint8)
                if key != last:
                    if last is not None:
                        yield row(last, total)
                    last, total = key, np.zeros(len(part), np.uint16)
                total = np.minimum(total + part, MOST)
        if last is not None:
            yield row(last, total)

    return run


class Reached:
    """One bit per cell of a merged sketch."""

    def __init__(self, bits: int, lines: int) -> None:
        self.bits = bits
        self.cells = np.zeros((lines, max(1, (1 << bits) // 8)), np.uint8)

    def may_reach(self, hashes: np.ndarray) -> np.ndarray:
        """False only for items counted less than the floor."""
        out = np.ones(len(hashes), bool)
        for line, cells in enumerate(self.cells):
            cell = cells_of(hashes, line, self.bits)
            out &= (cells[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
        return out


def merged(chunks: DataFrame, floor: int, bits: int, lines: int) -> Reached:
    """Add up the ``chunks`` of all tasks; ``floor`` is at most 255."""
    if not 1 <= floor <= MOST or not 3 <= bits <= 40 or not 1 <= lines <= len(_SALTS):
        raise ValueError(f"floor {floor}, bits {bits} or lines {lines} out of range")
    ordered = chunks.repartition("line", "chunk").sortWithinPartitions("line", "chunk")
    out = Reached(bits, lines)
    for row in ordered.mapInArrow(_reached(floor), CHUNKS).collect():
        part = np.frombuffer(row["cells"], np.uint8)
        at = row["chunk"] << (min(CHUNK_BITS, bits) - 3)
        out.cells[row["line"], at : at + len(part)] = part
    return out
