"""Sum-of-squares online packing of token ids into fixed windows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm import bpe
from larkspur.llm.common import give_back

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class Packer:
    """Open windows by how full they are.

    ``count[h]`` is the number of open windows that hold h ids. A piece of s ids goes to
    the level h (0: a new window) for which the sum of the squared counts is least
    afterwards: that takes 2 count[h] - 1 away and adds 2 count[h + s] + 1, or nothing if
    the window is then full. Ties go to the fuller window. ``leave`` and ``enter`` hold
    these two numbers per level, so one sum and one argmin place a piece.
    """

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open, self.n_open = capacity, most_open, 0
        self.windows: list[list[list]] = [[] for _ in range(capacity + 1)]
        self.leave = np.full(capacity + 1, 1 << 40, np.int64)
        self.leave[0] = 0
        self.enter = np.ones(capacity + 1, np.int64)
        self.enter[capacity] = 0

    def _changed(self, level: int) -> None:
        n = len(self.windows[level])
        self.leave[level] = 1 - 2 * n if n else 1 << 40
        self.enter[level] = 2 * n + 1

    def place(self, piece: tuple, size: int) -> list[list]:
        """Puts a piece of ``size`` < capacity ids; returns the windows that this closes."""
        cost = self.leave[: self.capacity - size + 1] + self.enter[size:]
        level = len(cost) - 1 - int(np.argmin(cost[::-1]))
        window = self.windows[level].pop() if level else []
        window.append(piece)
        if level:
            self._changed(level)
        self.n_open += not level
        if level + size == self.capacity:
            self.n_open -= 1
            return [window]
        self.windows[level + size].append(window)
        self._changed(level + size)
        return self.drain() if self.n_open > self.most_open else []

    def drain(self) -> list[list]:
        """Ends all open windows: their pieces are laid end to end, fullest windows
        first, and cut at the capacity, so at most the last one has room left."""
        done, window, room = [], [], self.capacity
        for level in range(self.capacity - 1, 0, -1):
            for w in self.windows[level]:
                for doc, start, ids in w:
                    while len(ids):
                        window.append((doc, start, ids[:room]))
                        taken = len(window[-1][2])
                        start, ids, room = start + taken, ids[taken:], room - taken
                        if not room:
                            done.append(window)
                            window, room = [], self.capacity
            self.windows[level] = []
            self._changed(level)
        self.n_open = 0
        return [*done, window] if window else done


def _pack(path: str, capacity: int, end: int, most_open: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        names = [c.split()[0] for c in PIECES.split(", ")]
        encoder, packer = bpe.Encoder(path), Packer(capacity, most_open)
        number, rows = TaskContext.get().partitionId() << 40, []

        def put(windows: list[list]) -> None:
            nonlocal number
            for window in windows:
                at = 0
                for (doc_id, n), start, ids in window:
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), n, number, at))
                    at += len(ids)
                number += 1

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows)) or [()] * len(names)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encoder.encode(text.as_py() or ""), np.array([end], "<u4")).astype("<u4")
                doc, whole = (doc_id, len(ids)), len(ids) // capacity * capacity
                for at in range(0, whole, capacity):
                    put([[(doc, at, ids[at : at + capacity])]])
                if len(ids) > whole:
                    put(packer.place((doc, whole, ids[whole:].copy()), len(ids) - whole))
                if len(rows) > 20_000:
                    yield flush()
        put(packer.drain())
        if rows:
            yield flush()
        del encoder, packer
        give_back()

    return run


def pack(docs: DataFrame, path: str, capacity: int = 2048, end: int = 1, most_open: int = 4096) -> DataFrame:
    """Pieces of documents laid into sequences of ``capacity`` ids, one row per piece.

    A document is the ids of its text and the id ``end``. Full windows are cut off long
    documents; what is left is placed online by the sum-of-squares rule. Each task packs
    the documents of its input split as they are read, so nothing is shuffled, and a task
    that is run again gives the same sequences. At the end of a task, or when more than
    ``most_open`` windows are open (which bounds memory where no two documents fit
    together), the open windows are laid end to end and cut, so a task leaves at most
    one sequence that needs padding.

    A null or empty text is the one id ``end``; repeated rows and ids are packed as
    separate documents; an empty table gives no rows; columns besides doc_id and text
    are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_pack(path, capacity, end, most_open), PIECES)
