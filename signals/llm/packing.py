"""Packing token streams into fixed windows with a bounded number of open windows.

Each partition keeps `open_windows` windows open. A document's whole windows leave at once; the
rest goes where it fits best. When it fits nowhere, the fullest window is emitted: its gap is
first filled with the head of the rest when the gap is worth a cut (`min_piece` ids), and a new
window opens in its place. Leftovers are merged twice: at the end of a partition the emptiest open
windows are poured into the gaps of the fullest until at most one is left with a gap, and those
last windows of `merge_parts` partitions are packed together by decreasing fill.

Null text counts as empty (its end id alone is packed). Repeated and null ids are packed like any
other row. An empty table gives no pieces. Only the id and text columns are read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signals.llm.common import staged
from signals.llm.tokens import vocabulary_path, worker_encoder

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, part int, open boolean, fill long"
)
#: Sequence numbers of one partition.
PER_PART = 1 << 32


class Packer:
    """Places runs of tokens; `placed` yields (window, offset, start, length, full fill or -1)."""

    def __init__(self, size: int, open_windows: int, min_piece: int):
        self.size, self.open_windows, self.min_piece = size, open_windows, min_piece
        self.gaps: list[tuple[int, int]] = []  # (gap, window), ascending
        self.made = 0

    def _open(self) -> int:
        self.made += 1
        return self.made - 1

    def place(self, length: int) -> list[tuple[int, int, int, int]]:
        """(window, offset, start, length) of each piece of a run of `length` ids."""
        out, start = [], 0
        while length - start >= self.size:
            out.append((self._open(), 0, start, self.size))
            start += self.size
        while (rest := length - start) > 0:
            at = bisect.bisect_left(self.gaps, (rest, -1))
            if at == len(self.gaps):
                if len(self.gaps) < self.open_windows:
                    self.gaps.append((self.size, self._open()))
                    continue
                gap, window = self.gaps.pop(0)
                if gap >= self.min_piece:
                    out.append((window, self.size - gap, start, gap))
                    start += gap
                bisect.insort(self.gaps, (self.size, self._open()))
                continue
            gap, window = self.gaps.pop(at)
            out.append((window, self.size - gap, start, rest))
            start += rest
            if gap > rest:
                bisect.insort(self.gaps, (gap - rest, window))
        return out


def _pour(windows: dict[int, list[list]], size: int) -> None:
    """Fills the gaps of the fullest windows from the ends of the emptiest, cutting at will.

    `windows`: pieces [doc_id, start, ids, doc_tokens, offset], gapless in each window.
    """
    fills = {w: sum(len(p[2]) // 4 for p in pieces) for w, pieces in windows.items()}
    order = sorted(fills, key=lambda w: (-fills[w], w))
    i, j = 0, len(order) - 1
    while i < j:
        into, source = order[i], order[j]
        if fills[into] == size:
            i += 1
        elif not fills[source]:
            del windows[source]
            j -= 1
        else:
            doc_id, start, ids, total, offset = windows[source].pop()
            move = min(len(ids) // 4, size - fills[into])
            stay = len(ids) // 4 - move
            if stay:
                windows[source].append([doc_id, start, ids[: 4 * stay], total, offset])
            windows[into].append([doc_id, start + stay, ids[4 * stay :], total, fills[into]])
            fills[into] += move
            fills[source] -= move
    for window in [w for w, fill in fills.items() if not fill and w in windows]:
        del windows[window]


def _pack_part(path: str, end_id: int, size: int, open_windows: int, min_piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = worker_encoder(path, end_id), Packer(size, open_windows, min_piece)
        part = TaskContext.get().partitionId()
        waiting: dict[int, list[list]] = {}  # pieces of open windows
        rows: list[tuple] = []

        def finish(window: int, pieces: list[list], last: bool) -> None:
            fill = sum(len(p[2]) // 4 for p in pieces)
            for doc_id, start, ids, total, offset in pieces:
                place = (part * PER_PART + window, offset, part, last and fill < size, fill)
                rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), total, *place))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [()] * 10
            kinds = [pa.int64()] * 7 + [pa.int32(), pa.bool_(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=[x.split()[0] for x in PIECES.split(", ")],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py())
                total = len(ids) // 4
                for window, offset, start, length in packer.place(total):
                    piece = [doc_id.as_py(), start, ids[4 * start : 4 * (start + length)], total, offset]
                    waiting.setdefault(window, []).append(piece)
                if len(waiting) > len(packer.gaps):
                    still = {w for _, w in packer.gaps}
                    for window in [w for w in waiting if w not in still]:
                        finish(window, waiting.pop(window), False)
            if len(rows) > 5000:
                yield batch_of(rows)
                rows.clear()
        _pour(waiting, size)
        for window, pieces in waiting.items():
            finish(window, pieces, True)
        yield batch_of(rows)

    return run


def _merge(size: int):
    def run(windows: pd.DataFrame) -> pd.DataFrame:
        """Best fit by decreasing fill; a merged window takes the number of its first member."""
        ordered = windows.sort_values(["fill", "sequence_id"], ascending=[False, True])
        gaps: list[tuple[int, int]] = []
        out = []
        for sequence, fill in zip(ordered["sequence_id"], ordered["fill"], strict=True):
            at = bisect.bisect_left(gaps, (fill, -1))
            gap, into = gaps.pop(at) if at < len(gaps) else (size, sequence)
            out.append((sequence, into, size - gap))
            if gap > fill:
                bisect.insort(gaps, (gap - fill, into))
        return pd.DataFrame(out, columns=["sequence_id", "into", "shift"])

    return run


def pack(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 1,
    size: int = 2048,
    open_windows: int = 64,
    min_piece: int = 64,
    merge_parts: int = 64,
) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    raw = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    pieces = staged(
        raw.mapInArrow(_pack_part(vocabulary, end_id, size, open_windows, min_piece), PIECES),
        "packed",
    )
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    left = pieces.where("open")
    moves = (
        left.groupBy("part", "sequence_id")
        .agg(F.max("fill").alias("fill"))
        .withColumn("batch", F.floor(F.col("part") / merge_parts))
        .groupBy("batch")
        .applyInPandas(_merge(size), "sequence_id long, into long, shift long")
    )
    moved = left.join(moves, "sequence_id").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.col("into").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset"),
    )
    return pieces.where("not open").select(columns).unionByName(moved)


def op6(spark, docs: DataFrame) -> DataFrame:
    return pack(docs, vocabulary_path())
