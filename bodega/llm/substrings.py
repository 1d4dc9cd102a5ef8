"""Substring dedup: remove words that a repeated window of words covers.

Windows meet in the buckets of their super-k-mers (``windows``), where sorting their hashes brings equal ones together
and their words decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from bodega.llm.arrays import BYTE_VALUES, column, slices, span_hashes, words
from bodega.llm.shared import expanded
from bodega.llm.windows import Words, covered, repeated_spans, spans

WINDOW = 35
GRAM = 8


def _bucket(size: int):
    def solve(texts, keys, places) -> Iterator[tuple[int, np.ndarray]]:
        """The windows of ``size`` words that two or more of ``texts`` have, as spans of window numbers."""
        blob = b" ".join(texts)
        data = np.frombuffer(blob, np.uint8)
        lengths = np.array([len(t) for t in texts]) + 1
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        bounds[-1] -= 1
        starts, ends, first = words(data, bounds)
        hashes = span_hashes(BYTE_VALUES[data], starts, ends)
        begin = np.arange(max(0, len(starts) - size + 1))
        text = np.searchsorted(first, begin, "right") - 1
        begin = begin[begin + size <= first[text + 1]]
        whole = span_hashes(hashes, begin, begin + size)
        order = np.argsort(whole, kind="stable")
        ordered = whole[order]
        twin = np.zeros(len(order), bool)
        twin[1:] = ordered[1:] == ordered[:-1]
        twin[:-1] |= twin[1:]
        alike: dict[bytes, list[int]] = {}
        for w in begin[order[twin]].tolist():
            alike.setdefault(blob[starts[w] : ends[w + size - 1]], []).append(w)
        again = np.zeros(len(starts) + 1, bool)
        for found in alike.values():
            if len(found) > 1:
                again[found] = True
        for k in np.unique(np.searchsorted(first, np.flatnonzero(again), "right") - 1):
            yield int(k), spans(again[first[k] : first[k + 1]])

    return solve


def remove_repeats(docs: DataFrame, size: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Rows of ``docs`` as (others, n_words, n_removed, kept): ``kept`` is the text without repeated windows.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a word goes if a window of ``size`` words over it occurs
    anywhere else, the same text included, judged on the input. A null or empty text has no words and an empty
    ``kept``; rows that occur twice lose what their copies share. ``others`` has all columns but the text.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(expanded(batches, "text"), "text"):
            starts, ends, first = words(data, bounds)
            marks, number = column(rows, "marks"), np.diff(first)
            removed, kept = [], []
            for k in range(rows.num_rows):
                gone = covered(marks, k, size, number[k]) if marks[k].is_valid else np.zeros(number[k], bool)
                removed.append(int(gone.sum()))
                parts = data[bounds[k] : bounds[k + 1]].tobytes().split()
                kept.append(b" ".join(np.array(parts, object)[~gone] if removed[-1] else parts))
            yield pa.record_batch(
                [column(rows, "others"), pa.array(number), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["others", "n_words", "n_removed", "kept"],
            )

    marked = repeated_spans(Words(size, gram), docs, _bucket(size), "substrings")
    fields = [marked.schema["others"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    return marked.mapInArrow(cut, T.StructType([*fields, T.StructField("kept", T.StringType())]))
