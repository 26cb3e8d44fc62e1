"""Packing token streams into windows of equal capacity by multiway differencing.

Every document's ids end with an end mark. Whole windows are cut off its front; what remains is cut
into pieces of ``piece`` tokens and a shorter last one, which give Karmarkar-Karp both coarse and fine
sizes to balance. Pieces of a scan task are packed in blocks of ``block`` pieces: each piece starts as a partition with one filled window, the two
partitions with the largest imbalance are merged again and again, the fullest windows of one with the
emptiest of the other, until one partition is left. If its fullest window exceeds the capacity the
block is packed anew with one more window.

The work is one narrow pass, without a shuffle: a block holds a bounded number of pieces, whatever the
document, so no document, source or group of copies makes a larger task. A block is packed from its own
rows alone, in scan order, hence a task that runs again gives the same windows.

Defined cases: NULL text is empty and packs its end mark only; repeated rows are packed each; equal
pieces are taken in scan order; an empty table gives no rows; other columns take no part. A NULL
``doc_id`` is carried along.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .encoding import SLICE_BYTES, encode, vocabulary_path
from .text import map_arrow, slices

SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
END = 0


def differencing(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp: the window of every size, and the windows' loads."""
    # A partition lists its filled windows, fullest first: loads, and a chain of members for each.
    following = np.full(len(sizes), -1, np.int64)
    heap = [(-int(s), i, np.array([s], np.int64), np.array([i]), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    stamp = len(heap)
    while len(heap) > 1:
        _, _, loads, heads, tails = heapq.heappop(heap)
        _, _, loads_b, heads_b, tails_b = heapq.heappop(heap)
        shared = len(loads) + len(loads_b) - windows
        if shared > 0:  # the emptiest windows of one take the emptiest of the other crosswise
            own, other = slice(len(loads) - shared, None), slice(-1, -shared - 1, -1)
            loads, tails = loads.copy(), tails.copy()
            loads[own] += loads_b[other]
            following[tails[own]] = heads_b[other]
            tails[own] = tails_b[other]
            kept = len(loads_b) - shared
            loads_b, heads_b, tails_b = loads_b[:kept], heads_b[:kept], tails_b[:kept]
        loads, heads, tails = (np.concatenate(x) for x in ((loads, loads_b), (heads, heads_b), (tails, tails_b)))
        order = np.argsort(-loads, kind="stable")
        loads, heads, tails = loads[order], heads[order], tails[order]
        least = int(loads[-1]) if len(loads) == windows else 0
        heapq.heappush(heap, (least - int(loads[0]), stamp, loads, heads, tails))
        stamp += 1
    window = np.full(len(sizes), -1, np.int64)
    if heap:
        _, _, loads, heads, _ = heap[0]
        at, number = heads.copy(), np.arange(len(heads))
        while len(at):
            window[at] = number
            at = following[at]
            at, number = at[at >= 0], number[at >= 0]
        return window, loads
    return window, np.zeros(0, np.int64)


def pack_block(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """A window for every piece, none over ``capacity``; the count rises until that holds."""
    windows = max(1, -(-int(sizes.sum()) // capacity)) if len(sizes) else 0
    while windows:
        window, loads = differencing(sizes, windows)
        if loads[0] <= capacity:
            return window, len(loads)
        windows += 1
    return np.zeros(0, np.int64), 0


def cuts(tokens: int, capacity: int, piece: int) -> list[int]:
    """Lengths of a document's pieces: whole windows, then pieces of ``piece`` and what is left."""
    full, rest = divmod(tokens, capacity)
    whole, left = divmod(rest, piece)
    return [capacity] * full + [piece] * whole + [left] * (left > 0)


def _pack(vocabulary: str | None, capacity: int, piece: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, path = TaskContext.get(), vocabulary or vocabulary_path()
        number = (context.partitionId() if context else 0) << 40  # windows of this task come after it
        waiting: list[tuple] = []

        def close(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal number
            window, count = pack_block(np.array([r[2] for r in rows], np.int64), capacity)
            order = np.argsort(window, kind="stable")
            fill = np.zeros(count, np.int64)
            out = []
            for i in order:
                doc, start, length, total, ids = rows[i]
                out.append((doc, start, length, total, number + int(window[i]), int(fill[window[i]]), ids))
                fill[window[i]] += length
            number += count
            return _rows(out)

        for batch in slices(batches, "text", SLICE_BYTES):
            whole = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"), path)):
                raw = np.append(ids, np.uint32(END)).astype("<u4").tobytes()
                total, start = len(raw) // 4, 0
                for length in cuts(total, capacity, piece):
                    part = raw[4 * start:4 * (start + length)]
                    if length == capacity:
                        whole.append((doc, start, length, total, number, 0, part))
                        number += 1
                    else:
                        waiting.append((doc, start, length, total, part))
                    start += length
            if whole:
                yield _rows(whole)
            while len(waiting) >= block:
                ready, waiting = waiting[:block], waiting[block:]
                yield close(ready)
        if waiting:
            yield close(waiting)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.binary()]
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = 1024, piece: int = 256,
         block: int = 2048) -> DataFrame:
    """One row per piece, with its ids as little-endian unsigned 32-bit values."""
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return map_arrow(plain, _pack(vocabulary, capacity, piece, block), SCHEMA, rows=2000)


def packing_digest(docs: DataFrame, **options) -> DataFrame:
    """The contract's columns; the ids stay in their checksum."""
    return pack(docs, **options).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                                        "doc_tokens", "sequence_id", "offset")
