"""Whole texts as flat arrays inside a task: bytes, words and rolling hashes, in bounded slices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NO_LETTER = np.array([not (b >= 128 or chr(b).isalnum()) for b in range(256)])


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=U64) * _BASE)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    if len(_powers["up"]) < n:
        inverse = U64(pow(int(_BASE), -1, 1 << 64))
        for name, factor in (("up", _BASE), ("down", inverse)):
            steps = np.full(n, factor, U64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=U64)
    return _powers["up"][:n], _powers["down"][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans ``values[start:end]``, equal for equal content wherever it stands."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    lengths = (ends - starts).astype(U64)
    return mixed((sums[ends] - sums[starts]) * down[starts] + lengths * _BASE)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values of a string or binary column, and the bounds of each; a null is empty."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if not len(column) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, at_most: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``at_most`` bytes in ``column``, or one row when that row is longer.

    Gives the slice, the bytes of the column and their bounds.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        data, bounds = flat(batch.column(batch.schema.get_field_index(column)))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + at_most, "right")) - 1)
            yield batch.slice(begin, end - begin), data[bounds[begin] : bounds[end]], bounds[begin : end + 1] - bounds[begin]
            begin = end


def words(data: np.ndarray, bounds: np.ndarray, between: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and the number of words before each text's end.

    ``between`` marks the bytes that part words.
    """
    inside = ~between[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    begin, last = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    begin[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every ``size`` consecutive values; one less per value beyond the first."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.zeros(n, U64)
    for k in range(size):
        total = total * _BASE + hashes[k : k + n]
    return mixed(total)


def owners(first: np.ndarray) -> np.ndarray:
    """For units counted by ``first`` (bounds per text), the text that each unit belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated ranges ``start .. start+length-1``."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def binary(chunks: list[bytes]) -> pa.Array:
    return pa.array(chunks, pa.binary())


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def taken(batch: pa.RecordBatch, name: str, rows: np.ndarray) -> pa.Array:
    return column(batch, name).take(pa.array(rows))
