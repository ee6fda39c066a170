"""Pack token documents into fixed windows by the sum-of-squares rule.

Each task packs the documents of its own partition as they come. Full windows are cut off a document first; the rest
of ``s`` ids goes to the fill level that keeps the sum of squared level counts smallest: an array holds how many
partially filled windows stand at each level, and putting ``s`` ids on level ``h`` moves one window from ``h`` to
``h + s`` (a new one starts at level 0, a full one leaves the array). At the end of a task, the windows that are still
open fill each other, the emptiest cut up first, and the last one is cut into lengths that are powers of two, which
need no padding.

A sequence's pieces are written by one task, so a task that is run again after a lost executor rewrites its own
sequences and no others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from salesmart.llm import arrays
from salesmart.llm.tokens import tokenizer

WINDOW = 2048
PIECES = "{id} {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long"


class Packer:
    """Windows of one task; ``done`` holds the pieces of closed ones as (document, start, ids, tokens, sequence, offset, sequence length)."""

    def __init__(self, window: int, first: int):
        self.window, self.next = window, first
        self.levels = np.zeros(window + 1, np.int64)  # open windows at each fill level
        self.open: list[list[list]] = [[] for _ in range(window + 1)]
        self.done: list[tuple] = []

    def level_for(self, size: int) -> int:
        """The level whose use makes the sum of squares grow least; of equal ones the fullest."""
        room = self.window - size
        change = 2 * (self.levels[size : self.window + 1] - self.levels[: room + 1]) + 2
        change[0] = 2 * self.levels[size] + 1  # a new window; level 0 holds none
        change[room] = 1 - 2 * self.levels[room]  # closes the window
        change[1:][self.levels[1 : room + 1] == 0] = np.iinfo(np.int64).max
        return room - int(np.argmin(change[::-1]))

    def add(self, document, ids: np.ndarray) -> None:
        total, whole = len(ids), len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            self.close([(document, start, ids[start : start + self.window], total)])
        if total == whole:
            return
        rest = (document, whole, ids[whole:].copy(), total)
        level = self.level_for(total - whole)
        held = self.open[level].pop() if level else []
        if level:
            self.levels[level] -= 1
        self.put(held, rest, level + total - whole)

    def put(self, held: list, piece: tuple, level: int) -> None:
        held.append(piece)
        if level == self.window:
            self.close(held)
        else:
            self.open[level].append(held)
            self.levels[level] += 1

    def close(self, pieces: list[tuple]) -> None:
        length, offset = sum(len(p[2]) for p in pieces), 0
        for document, start, ids, total in pieces:
            self.done.append((document, start, ids, total, self.next, offset, length))
            offset += len(ids)
        self.next += 1

    def finish(self) -> None:
        """Close all open windows without padding."""
        rest = [[level, held] for level in range(1, self.window) for held in self.open[level]]
        self.levels[:] = 0
        self.open = [[] for _ in range(self.window + 1)]
        low, high = 0, len(rest) - 1
        while low < high:
            gap = self.window - rest[high][0]
            while gap and low < high:
                document, start, ids, total = rest[low][1].pop()
                took = min(gap, len(ids))
                if took < len(ids):
                    rest[low][1].append((document, start, ids[:-took], total))
                rest[high][1].append((document, start + len(ids) - took, ids[-took:], total))
                rest[low][0] -= took
                gap -= took
                low += rest[low][0] == 0
            if gap == 0:
                self.close(rest[high][1])
                high -= 1
            else:
                rest[high][0] = self.window - gap
        if low == high and rest[low][0]:
            self.split(rest[low][1])

    def split(self, pieces: list[tuple]) -> None:
        left = sum(len(p[2]) for p in pieces)
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            part = []
            while size:
                document, start, ids, total = pieces.pop(0)
                took = min(size, len(ids))
                part.append((document, start, ids[:took], total))
                if took < len(ids):
                    pieces.insert(0, (document, start + took, ids[took:], total))
                size -= took
            self.close(part)


def pack(docs: DataFrame, tokenizer_path: str, *, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per piece: the document's id, ``start`` and ``length`` in its ids, where it stands in which sequence.

    ``sequence_id`` is unique, not gapless; ``sequence_length`` is ``window`` or a power of two. A NULL or empty text
    is the end id alone. Rows that repeat are packed as often as they come; a NULL id is kept as it is. Other columns
    are not read. An empty table gives no rows.
    """
    kind = dict(docs.dtypes)[id_column]
    schema = PIECES.format(id=f"`{id_column}`", kind=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = tokenizer(tokenizer_path)
        packer = Packer(window, TaskContext.get().partitionId() << 36)
        column = None

        def closed() -> pa.RecordBatch:
            done, packer.done = packer.done, []
            longs = [[p[1] for p in done], [len(p[2]) for p in done], [zlib.crc32(p[2].astype("<u4").tobytes()) for p in done],
                     [p[3] for p in done], [p[4] for p in done], [p[5] for p in done], [p[6] for p in done]]
            names = [id_column, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length"]
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in done], column), *(pa.array(x, pa.int64()) for x in longs)], names)

        for rows, data, at in arrays.slices(batches, text_column, 1 << 19):
            column = rows.column(id_column).type
            ids, bounds = ids_of.encode(data, at)
            for document, a, b in zip(rows.column(id_column).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                packer.add(document, ids[a:b])
            yield closed()
        packer.finish()
        if packer.done:
            yield closed()

    return docs.select(id_column, text_column).mapInArrow(run, schema)
