"""Whole texts as flat numpy arrays, for operators that run inside ``mapInArrow``.

A record batch is cut into slices of at most ``SLICE_BYTES`` of text (one longer text makes a slice
of its own), so a task's memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 20
# Fixed constants of the hashes; changing one changes every stored hash.
_BASE = 0x9E3779B97F4A7C15
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def map_arrow(df: DataFrame, function, schema: str, rows: int = 1000) -> DataFrame:
    """``mapInArrow`` with batches of ``rows`` rows, since a text may be long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df.mapInArrow(function, schema)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(_lengths(batch.column(column)))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = int(np.searchsorted(ends, before + most, side="right"))
            last = max(last, first + 1)
            yield batch.slice(first, last - first)
            first = last


def _lengths(column: pa.Array) -> np.ndarray:
    return flat(column)[1][1:] - flat(column)[1][:-1]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the offsets of its values; NULL is empty."""
    values = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    data = values.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def _power(kind: str, size: int) -> np.ndarray:
    if len(_powers[kind]) < size:
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        steps = np.full(max(size, SLICE_BYTES + 1), np.uint64(base))
        steps[0] = 1
        if len(steps) > 1 << 23:  # one very long text; not worth keeping
            return np.multiply.accumulate(steps)
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind][:size]


def words(data: np.ndarray, offsets: np.ndarray, alphabet: np.ndarray):
    """Word hashes and the offsets of each text's words.

    ``alphabet`` maps a byte to the byte it counts as, and separators to 0. A word is a maximal run
    of other bytes; its hash depends on its bytes alone.
    """
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    letters = alphabet[data]
    inside = letters != 0
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(letters.astype(np.uint64) * _power("up", len(data)), out=sums[1:])
    hashes = mix((sums[last] - sums[first]) * _power("down", len(data))[first])
    return hashes, np.searchsorted(first, offsets)


def blank_separated() -> np.ndarray:
    """Separators are space and 9 to 13; A-Z count as a-z; every other byte is a letter."""
    table = np.arange(256, dtype=np.uint16) + 1
    table[65:91] += 32
    table[[9, 10, 11, 12, 13, 32]] = 0
    return table


def alphanumeric() -> np.ndarray:
    """Letters are ASCII letters in lower case, digits and all bytes of other scripts."""
    table = np.zeros(256, np.uint16)
    for low, high in ((48, 58), (97, 123), (128, 256)):
        table[low:high] = np.arange(low, high) + 1
    table[65:91] = table[97:123]
    return table
