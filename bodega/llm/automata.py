"""Counts of word sequences as weighted acyclic automata.

Sequences have ``DEPTH`` symbols: a group and up to four words, padded with the end symbol 0. The automaton has a layer
per symbol; an arc has a symbol and the state it leads to, arcs into the end have the sequence's count. The weight of a
prefix is the sum over all paths that go on from it. It is built from sorted sequences from the last layer to the
first, and states with one equal arc, which are nearly all, are one state.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

from bodega.llm.arrays import U64, ranges

WORDS = 4
DEPTH = 1 + WORDS
_KEY_BYTES = 64
_END, _PART = b"\0\1", b"\0\0"


@dataclass
class Sequences:
    """Distinct sequences in order with their counts; symbols number sorted ``groups`` and ``words``, words from 1."""

    groups: list[bytes]
    words: pa.Array
    rows: np.ndarray  # DEPTH columns
    counts: np.ndarray

    def slice(self, begin: int, end: int) -> Sequences:
        """A run of the sequences with only the words that it uses."""
        rows = self.rows[begin:end]
        used = np.zeros(len(self.words) + 1, bool)
        used[rows[:, 1:]] = True
        used[0] = True
        number = (np.cumsum(used) - 1).astype(np.int32)
        kept = self.words.take(pa.array(np.flatnonzero(used)[1:] - 1))
        return Sequences(self.groups, kept, np.column_stack([rows[:, 0], number[rows[:, 1:]]]), self.counts[begin:end])

    def key(self, at: int) -> bytes:
        """A sequence as bytes in the order of sequences, with long words cut: any key parts all sequences alike."""
        parts = [self.groups[self.rows[at, 0]]]
        parts += [self.words[int(symbol) - 1].as_py() for symbol in self.rows[at, 1:] if symbol]
        return _PART.join(part[:_KEY_BYTES].replace(b"\0", _END) for part in parts)

    def lower_bounds(self, keys: Sequence[bytes]) -> np.ndarray:
        """For each key the first sequence that is not before it."""
        names = self.words.to_pylist()
        found = np.zeros(len(keys), np.int64)
        for k, key in enumerate(keys):
            begin, end = 0, len(self.rows)
            for depth, part in enumerate(key.split(_PART)):
                part = part.replace(_END, b"\0")
                known = self.groups if depth == 0 else names
                at = bisect_left(known, part)
                symbol = at + (depth > 0)
                column = self.rows[begin:end, depth]
                begin, end = (begin + int(np.searchsorted(column, symbol, side)) for side in ("left", "right"))
                if at == len(known) or known[at] != part:
                    break
            found[k] = begin
        return found


def counted(groups: list[bytes], words: pa.Array, rows: np.ndarray, counts: np.ndarray | None = None) -> Sequences:
    """Sort sequences and add up the counts of equal ones; the words are sorted already."""
    bits = max(1, len(words).bit_length())
    keys = np.zeros(len(rows), U64)
    if 4 * bits + len(groups).bit_length() <= 64:
        for depth in range(DEPTH):
            keys = keys << U64(bits) | rows[:, depth].astype(U64)
        order = None if counts is None else np.argsort(keys, kind="stable")
        if order is None:
            keys, counts = np.unique(keys, return_counts=True)
        else:
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
            keys, counts = keys[first], np.add.reduceat(counts[order], first) if len(first) else counts
        rows = np.empty((len(keys), DEPTH), np.int32)
        for depth in range(DEPTH - 1, -1, -1):
            rows[:, depth] = keys & U64((1 << bits) - 1) if depth else keys
            keys = keys >> U64(bits)
    else:
        words_at = [rows[:, depth].astype(U64) for depth in range(1, DEPTH)]
        high = (rows[:, 0].astype(U64) << U64(bits) | words_at[0]) << U64(bits) | words_at[1]
        order = np.lexsort((words_at[2] << U64(bits) | words_at[3], high))
        rows = rows[order]
        first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])[: len(rows)])
        added = np.ones(len(order), np.int64) if counts is None else counts[order]
        rows, counts = rows[first], np.add.reduceat(added, first) if len(first) else added
    return Sequences(groups, words, rows, counts.astype(np.int64))


def renamed(words: Sequence[pa.Array]) -> tuple[pa.Array, list[np.ndarray]]:
    """The distinct words of several lists, sorted, and the place of each list's words among them."""
    joined = pa.concat_arrays(list(words)).dictionary_encode()
    names = joined.dictionary
    order = pc.sort_indices(names).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    places = rank[joined.indices.to_numpy()]
    cuts = np.cumsum([len(w) for w in words])[:-1]
    return names.take(pa.array(order)), np.split(places, cuts)


def united(parts: Sequence[Sequences]) -> Sequences:
    """The union of automata: equal sequences once, their counts added up."""
    groups = sorted({group for part in parts for group in part.groups})
    words, places = renamed([part.words for part in parts])
    rows = []
    for part, place in zip(parts, places, strict=True):
        symbols = np.concatenate([[0], place + 1]).astype(np.int32)
        group = np.array([groups.index(name) for name in part.groups], np.int32)
        rows.append(np.column_stack([group[part.rows[:, 0]], symbols[part.rows[:, 1:]]]))
    return counted(groups, words, np.concatenate(rows), np.concatenate([part.counts for part in parts]))


def _packed(values: np.ndarray) -> bytes:
    """Unsigned integers in as few bytes each as the largest needs, led by that number."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return bytes([width]) + len(values).to_bytes(8, "little") + values.astype(f"<u{width}").tobytes()


def _unpacked(blob: bytes, at: int) -> tuple[np.ndarray, int]:
    width, n = blob[at], int.from_bytes(blob[at + 1 : at + 9], "little")
    end = at + 9 + n * width
    return np.frombuffer(blob, f"<u{width}", n, at + 9), end


def written(sequences: Sequences) -> bytes:
    """The automaton of ``sequences`` as bytes: words, then the arcs of every layer from the last to the first."""
    lengths = pc.binary_length(sequences.words).to_numpy(zero_copy_only=False)
    groups = [np.array([len(g) for g in sequences.groups], np.int64), np.frombuffer(b"".join(sequences.groups), np.uint8)]
    text = np.frombuffer(b"".join(sequences.words.to_pylist()), np.uint8)
    out = [_packed(part) for part in (*groups, lengths, text)]
    rows, target = sequences.rows, sequences.counts
    # Whether a row's first symbols, as many as the place in the list says, differ from those of the row before.
    new = [np.zeros(len(rows), bool)]
    new[0][:1] = True
    for depth in range(DEPTH):
        new.append(new[-1].copy())
        new[-1][1:] |= rows[1:, depth] != rows[:-1, depth]
    at = np.arange(len(rows))
    for depth in range(DEPTH - 1, -1, -1):
        # One state per distinct prefix of ``depth`` symbols, one arc per distinct prefix of one more.
        symbols = rows[at, depth]
        first = np.flatnonzero(new[depth][at])
        arcs = np.diff(np.append(first, len(at)))
        single = arcs == 1
        alone = first[single]
        if len(target) and int(target.max()) < 1 << 32:
            order = np.argsort(symbols[alone].astype(U64) << U64(32) | target[alone].astype(U64))
        else:
            order = np.lexsort((target[alone], symbols[alone]))
        symbol, goal = symbols[alone][order], target[alone][order]
        differs = np.ones(len(order), bool)
        differs[1:] = (symbol[1:] != symbol[:-1]) | (goal[1:] != goal[:-1])
        singles = int(differs.sum())
        state = np.empty(len(first), np.int64)
        state[np.flatnonzero(single)[order]] = np.cumsum(differs) - 1
        state[~single] = singles + np.arange(len(first) - len(alone))
        branching = ranges(first[~single], arcs[~single])
        sizes = np.concatenate([np.ones(singles, np.int64), arcs[~single]])
        goals = np.concatenate([goal[differs], target[branching]])
        out += [_packed(sizes), _packed(np.concatenate([symbol[differs], symbols[branching]])), _packed(goals)]
        at, target = at[first], state
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def read(blob: bytes) -> Sequences:
    """All paths of a written automaton, in order."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    columns, at = [], 0
    while at < len(raw):
        found, at = _unpacked(raw, at)
        columns.append(found)
    sizes, names, lengths, text = columns[:4]
    ends = np.cumsum(sizes, dtype=np.int64)
    name = names.astype(np.uint8).tobytes()
    groups = [name[end - size : end] for size, end in zip(sizes.tolist(), ends.tolist(), strict=True)]
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(text.astype(np.uint8))]
    words = pa.Array.from_buffers(pa.large_binary(), len(lengths), buffers)
    layers = [columns[4 + 3 * k : 7 + 3 * k] for k in range(DEPTH)][::-1]
    state = np.zeros(1 if len(layers[0][0]) else 0, np.int64)
    path: list[np.ndarray] = []
    for sizes, symbols, goals in layers:
        each = sizes[state].astype(np.int64)
        arcs = ranges((np.cumsum(sizes, dtype=np.int64) - sizes)[state], each)
        path = [np.repeat(column, each) for column in path] + [symbols[arcs].astype(np.int32)]
        state = goals[arcs]
    return Sequences(groups, words, np.column_stack(path), state.astype(np.int64))
