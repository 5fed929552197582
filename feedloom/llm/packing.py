"""Sum-of-squares online packing of token sequences.

Documents are tokenised and cut at the window length; full pieces are windows of
their own.  Every other piece goes, in order, to the fill level that makes the
sum of squared counts of partially filled windows smallest.  The level array
holds, per fill level, the windows at that level.

Tasks pack what they read, so no text is shuffled.  A task that holds too many
open windows, or ends, empties the least filled into the fullest, cutting a
piece where it must; at most one window of a task stays partly empty.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import long_rows, need_columns

WINDOW = 2048
END_ID = 1
OPEN_WINDOWS = 4096
CACHE_WORDS = 400_000
TOKENIZER = "word_bpe_49k.json"
# A full stop or comma after a word, which the tokenizer sets apart anyway.
MARK = re.compile(rb"(?<=[a-z])([.,])(?=[ \n])")
# Marks after a word are set apart too, whatever their number.
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Known(dict):
    """Words with their ids; one that is missing has its place in ``new``."""

    def __missing__(self, word: bytes) -> bytearray:
        return self.new[word]


class WordTokens:
    """Ids of a text as little-endian 32-bit bytes, as the tokenizer gives them.

    The tokenizer lower-cases and never joins over white space, so each distinct
    word is encoded once and kept, up to ``CACHE_WORDS``.  Plain words are
    encoded together: each ends with the one id that carries a word end.
    """

    END = "</w>"

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(self.END)]] = True
        # Kept as long as the Python process, which runs many tasks.
        kept = sys.modules.setdefault("_feedloom_tokens", types.ModuleType("_feedloom_tokens"))
        self.known: Known = kept.__dict__.setdefault(path, Known())

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()

    @staticmethod
    def _plain(word: str) -> bool:
        """One run of Latin letters, which the tokenizer takes as one word."""
        return word.isalpha() and max(word) < "ɐ" and "İ" not in word

    def _learn(self, words: set[bytes]) -> None:
        plain, other, marked = [], [], []
        for word in words:
            if self._plain(word.decode()):
                plain.append(word)
            elif (head := word.rstrip(MARKS)) != word and self._plain(head.decode()):
                marked.append((word, head, word[len(head) :]))
            else:
                other.append(word)
        parts = {x for _, head, tail in marked for x in (head, tail)}
        parts = parts.difference(self.known, words)
        plain += (x for x in parts if self._plain(x.decode()))
        other += (x for x in parts if not self._plain(x.decode()))
        for at in range(0, len(plain), 512):
            part = plain[at : at + 512]
            ids = self.tokenizer.encode(b" ".join(part).decode(), add_special_tokens=False).ids
            ids = np.asarray(ids, "<u4")
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(cuts) != len(part):
                other += part
                continue
            raw, start = ids.tobytes(), 0
            for word, end in zip(part, cuts.tolist(), strict=True):
                self.known[word] = raw[start:end]
                start = end
        for word in other:
            self.known[word] = self.whole(word.decode())
        for word, head, tail in marked:
            self.known[word] = self.known[head] + self.known[tail]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > 1 << 20:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        # A word not known yet is a place in its texts, which is filled once all are learnt.
        self.known.new = new = defaultdict(bytearray)
        get, ids = self.known.__getitem__, []
        for text in texts:
            # Special tokens are matched as written, so such texts go as they are.
            # A full stop or comma after a letter is a word of its own.
            odd = "<|" in text
            words = None if odd else MARK.sub(rb" \1", text.encode().lower()).split()
            ids.append([self.whole(text)] if odd else list(map(get, words)))
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
        self._learn(set(new))
        for word, place in new.items():
            place += self.known[word]
        yield from map(b"".join, ids)


class Packer:
    """Windows under construction of one task; gives (sequence, pieces) when one is full.

    A piece is (doc_id, start, ids, doc_tokens).
    """

    def __init__(self, window: int, first: int, open_windows: int = OPEN_WINDOWS) -> None:
        self.window, self.next, self.limit = window, first, open_windows
        self.count = np.zeros(window + 1, np.int64)  # the level array
        self.at: dict[int, list] = defaultdict(list)

    def _close(self, pieces: list) -> tuple[int, list]:
        self.next += 1
        return self.next - 1, pieces

    def level(self, size: int) -> int:
        """The fill level whose growth by ``size`` makes the squares' sum smallest."""
        room = self.window - size
        count = self.count
        grown = 2 * count[size:] + 1
        grown[-1] = 0  # a full window is no longer counted
        cost = grown - 2 * count[: room + 1] + 1
        cost[count[: room + 1] == 0] = np.iinfo(np.int64).max
        cost[0] = grown[0]
        return room - int(np.argmin(cost[::-1]))  # of equals the fullest

    def _place(self, piece: tuple) -> Iterator[tuple[int, list]]:
        size = len(piece[2]) // 4
        level = self.level(size)
        pieces = self.at[level].pop() if level else []
        if level:
            self.count[level] -= 1
        pieces.append(piece)
        if level + size == self.window:
            yield self._close(pieces)
        else:
            self.at[level + size].append(pieces)
            self.count[level + size] += 1

    def add(self, doc_id, ids: bytes) -> Iterator[tuple[int, list]]:
        total, step = len(ids) // 4, self.window
        for start in range(0, total, step):
            piece = (doc_id, start, ids[4 * start : 4 * (start + step)], total)
            if len(piece[2]) == 4 * step:
                yield self._close([piece])
            else:
                yield from self._place(piece)
        if self.count.sum() > self.limit:
            yield from self.settle(all_of_them=False)

    def settle(self, all_of_them: bool = True) -> Iterator[tuple[int, list]]:
        """Empty the least filled windows into the fullest."""
        levels = [(level, pieces) for level in sorted(self.at) for pieces in self.at[level]]
        self.at.clear()
        self.count[:] = 0
        low, spare = 0, []
        while levels[low:] or spare:
            fill, pieces = levels.pop() if levels[low:] else (0, [])
            while fill < self.window and (spare or low < len(levels)):
                if not spare:
                    spare = levels[low][1]
                    low += 1
                doc_id, start, ids, total = spare.pop()
                take = min(len(ids) // 4, self.window - fill)
                pieces.append((doc_id, start, ids[: 4 * take], total))
                if 4 * take < len(ids):
                    spare.append((doc_id, start + take, ids[4 * take :], total))
                fill += take
            if fill == self.window or all_of_them:
                yield self._close(pieces)
            else:
                self.at[fill].append(pieces)
                self.count[fill] += 1


PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def _pack(path: str, window: int, with_ids: bool):
    def rows(done: Iterator[tuple[int, list]]) -> Iterator[tuple]:
        for sequence, pieces in done:
            offset = 0
            for doc_id, start, ids, total in pieces:
                size = len(ids) // 4
                row = (doc_id, start, size, zlib.crc32(ids), total, sequence, offset)
                yield (*row, np.frombuffer(ids, "<u4").astype(np.int64)) if with_ids else row
                offset += size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens = WordTokens(path)
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        end = np.asarray([END_ID], "<u4").tobytes()
        names = [c.split()[0] for c in PIECE.split(", ")] + ["ids"] * with_ids
        types = [pa.int64()] * 7 + [pa.list_(pa.int64())] * with_ids

        def batch_of(done: list) -> pa.RecordBatch:
            columns = zip(*done, strict=True) if done else [[]] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names
            )

        for batch in batches:
            done, ids = [], batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, raw in zip(ids, tokens.encode(texts), strict=True):
                done += rows(packer.add(doc_id, raw + end))
                if len(done) > 20_000:
                    yield batch_of(done)
                    done = []
            yield batch_of(done)
        yield batch_of(list(rows(packer.settle())))

    return run


def pack_documents(
    documents: DataFrame, window: int = WINDOW, path: str | None = None, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its text (null: empty), then the end id; a row of
    any doc_id, null or repeated, is a document of its own.  ``with_ids`` adds
    the ids.  Sequences hold ``window`` ids; at most one per task has fewer and
    is padded.
    """
    need_columns(documents, "doc_id", "text")
    rows = long_rows(documents).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = PIECE + (", ids array<long>" if with_ids else "")
    return rows.mapInArrow(_pack(path or tokenizer_path(), window, with_ids), schema)
