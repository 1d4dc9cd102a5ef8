"""Suffix dedup: remove bytes that a repeated string of bytes covers, by column-wise construction.

A collection's Burrows-Wheeler order can be built without any suffix sort: one symbol of every text is put in per
round, from the last to the first, and the order of the suffixes and the lengths of their common prefixes follow from
those of the round before. Done on whole documents it takes as many rounds as the longest has bytes, each over all
that is there already. Here texts come as short strings in the buckets of their super-k-mers (``windows``), lined up
at the minimiser. Equal strings of ``size`` bytes stand in equal columns there, so a round only has to order the
suffixes that begin in its column: a stable sort by the new symbol, which is the Burrows-Wheeler step, and the smallest
common prefix between neighbours plus one. A suffix with a neighbour that shares ``size`` bytes occurs again. Columns
are read one after the other, front to back, and only the order and the prefixes of the last one are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from bodega.llm.arrays import column, slices
from bodega.llm.shared import expanded
from bodega.llm.windows import Bytes, covered, repeated_spans, spans

LENGTH = 400
GRAM = 32
_NONE = 255  # never a byte of UTF-8


def _bucket(size: int):
    def solve(texts, keys, places) -> Iterator[tuple[int, np.ndarray]]:
        """The strings of ``size`` bytes that two or more of ``texts`` have in one column, as spans of first bytes."""
        number = len(texts)
        before = places.max()
        width = int(max(len(t) - p for t, p in zip(texts, places, strict=True)) + before)
        shift = before - places
        columns = np.full((number, width), _NONE, np.uint8)
        for k, text in enumerate(texts):
            columns[k, shift[k] : shift[k] + len(text)] = np.frombuffer(text, np.uint8)
        columns = np.ascontiguousarray(columns.T)
        _, group = np.unique(keys, return_inverse=True)
        group = group.astype(np.uint16 if group[-1] < 1 << 16 else np.int64)
        order = np.argsort(group, kind="stable")
        shared = np.zeros(number + 1, np.int32)
        again = np.zeros((width, number), bool)
        for at in range(width - 1, -1, -1):
            symbol, of = columns[at][order], group[order]
            by_symbol = np.argsort(symbol, kind="stable")
            step = by_symbol[np.argsort(of[by_symbol], kind="stable")]
            least = np.minimum.reduceat(shared, step + 1)
            symbol, of, order = symbol[step], of[step], order[step]
            same = (symbol[1:] == symbol[:-1]) & (of[1:] == of[:-1]) & (symbol[1:] != _NONE)
            shared = np.zeros(number + 1, np.int32)
            shared[1:-1] = np.where(same, np.minimum(least[:-1] + 1, size), 0)
            long = shared >= size
            if long.any():
                again[at, order[long[:-1] | long[1:]]] = True
        again = np.ascontiguousarray(again.T)
        for k in np.flatnonzero(again.any(axis=1)):
            yield int(k), spans(again[k, shift[k] : shift[k] + len(texts[k])])

    return solve


def remove_repeats(docs: DataFrame, size: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Rows of ``docs`` as (others, n_bytes, n_removed, n_spans, kept): ``kept`` has the bytes that stay.

    A byte of the UTF-8 text goes if a string of ``size`` bytes over it starts anywhere else too, the same text
    included, judged on the input. A null or empty text has no bytes; rows that occur twice lose what
    their copies share. ``others`` has all columns but the text. ``kept`` is binary: a cut can fall inside a letter.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(expanded(batches, "text"), "text"):
            marks = column(rows, "marks")
            removed, runs, kept = [], [], []
            for k in range(rows.num_rows):
                text = data[bounds[k] : bounds[k + 1]]
                gone = covered(marks, k, size, len(text)) if marks[k].is_valid else np.zeros(len(text), bool)
                removed.append(int(gone.sum()))
                runs.append(len(spans(gone)) if removed[-1] else 0)
                kept.append(text[~gone].tobytes() if removed[-1] else text.tobytes())
            yield pa.record_batch(
                [column(rows, "others"), pa.array(np.diff(bounds)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                names=["others", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    marked = repeated_spans(Bytes(size, gram), docs, _bucket(size), "suffixes")
    longs = [T.StructField(name, T.LongType()) for name in ("n_bytes", "n_removed", "n_spans")]
    return marked.mapInArrow(cut, T.StructType([marked.schema["others"], *longs, T.StructField("kept", T.BinaryType())]))
