"""Windows that occur more than once, found by super-k-mers.

A text is a row of units: words or bytes. Every window of ``size`` units has a minimiser, the ``gram`` units in it
whose hash is smallest (the leftmost of equals); equal windows have equal minimisers at equal places. Consecutive windows
with the same minimiser form a run, and travel as one packed string to the bucket of that minimiser.

In a text of little variety, one letter two million times, every window has a minimiser of its own place, but the runs that
follow each other are equal strings at equal distances: they are one row with a number of times. Long texts are worked
on in parts of ``PART`` units; a run that a part cuts is two runs, which changes nothing.

Only minimisers that occur twice can have equal windows, so runs are counted first (a hash each), and only the
runs of repeated minimisers are cut out of the texts. A task sends equal strings once, so a group of copies,
however large, is one row for each task. A minimiser that more runs have than ``HOT`` is divided by a second
one under another hash: equal windows agree on both. Buckets see distinct strings and say which windows of
which string occur again; the runs look that up by the string's 128-bit digest.

A passage in many different surroundings still gives many distinct strings under the same two minimisers. No task gets
such a bucket: where its distinct strings have more than ``CHUNK_BYTES``, Spark counts their windows by hash,
and windows of equal hash are told apart by a 128-bit digest of their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.llm.arrays import BYTE_VALUES, U64, binary, column, gram_hashes, mixed, ranges, slices, span_hashes, words
from bodega.llm.shared import bytes_of, discard, expanded, squeezed, store, task_count

HOT = 256
BUCKET_BYTES = 16 << 20
CHUNK_BYTES = 2 << 20
PART = 1 << 20
_BLOCK = 1 << 18
_SEEN = 1 << 18
_PLACE_BITS = U64(24)
_SECOND = U64(0xA5A5B4C3D2E1F00F)
NO_ID = -(1 << 63)


class Units:
    """What a text is made of: units, their hashes, and how a stretch of units is packed."""

    def __init__(self, size: int, gram: int) -> None:
        self.size, self.gram = size, gram

    def bounds(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the units, and their number before each text."""
        raise NotImplementedError

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of every ``gram`` units in a row."""
        raise NotImplementedError

    def windows(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """Every window of packed strings: string, number in it, hash, and where its bytes begin and end."""
        starts, ends, first = self.bounds(data, bounds)
        count = np.maximum(np.diff(first) - self.size + 1, 0)
        window = ranges(first[:-1], count)
        string = np.repeat(np.arange(len(count)), count)
        hashes = span_hashes(span_hashes(BYTE_VALUES[data], starts, ends), window, window + self.size)
        return string, window - first[string], hashes, starts[window], ends[window + self.size - 1]

    def packed(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: int, number: int) -> bytes:
        raise NotImplementedError

    def strings(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of stretches of units."""
        return span_hashes(span_hashes(BYTE_VALUES[data], starts, ends), first, last)

    def parts(self, data: np.ndarray, bounds: np.ndarray, step: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Texts in parts that hold all windows of up to ``step`` units each: first unit, bytes, bounds."""
        raise NotImplementedError


class Words(Units):
    def bounds(self, data, bounds):
        return words(data, bounds)

    def hashes(self, data, starts, ends):
        return gram_hashes(span_hashes(BYTE_VALUES[data], starts, ends), self.gram)

    def packed(self, data, starts, ends, first, number):
        return b" ".join(data[starts[first] : ends[first + number - 1]].tobytes().split())

    def parts(self, data, bounds, step):
        if len(bounds) > 2 or len(data) <= step:  # a word has a byte at least
            yield 0, data, bounds
            return
        starts, ends, _ = words(data, bounds)
        for begin in range(0, max(1, len(starts) - self.size + 1), step):
            part = data[starts[begin] : ends[min(begin + step + self.size - 1, len(starts)) - 1]] if len(starts) else data[:0]
            yield begin, part, np.array([0, len(part)])


class Bytes(Units):
    def bounds(self, data, bounds):
        at = np.arange(len(data))
        return at, at + 1, bounds

    def hashes(self, data, starts, ends):
        at = np.arange(max(0, len(data) - self.gram + 1))
        return span_hashes(BYTE_VALUES[data], at, at + self.gram)

    def packed(self, data, starts, ends, first, number):
        return data[first : first + number].tobytes()

    def strings(self, data, starts, ends, first, last):
        return span_hashes(BYTE_VALUES[data], first, last)

    def parts(self, data, bounds, step):
        if len(bounds) > 2 or len(data) <= step:
            yield 0, data, bounds
            return
        for begin in range(0, max(1, len(data) - self.size + 1), step):
            part = data[begin : begin + step + self.size - 1]
            yield begin, part, np.array([0, len(part)])


def smallest(hashes: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` hashes, the place of the smallest, leftmost of equals (by their leading 40 bits)."""
    n = len(hashes) - width + 1
    places = np.zeros(max(0, n), np.int64)
    low = (U64(1) << _PLACE_BITS) - U64(1)
    for begin in range(0, n, _BLOCK):
        part = hashes[begin : begin + _BLOCK + width - 1]
        best = (part & ~low) | np.arange(len(part), dtype=U64)
        span = 1
        while 2 * span <= width:
            best = np.minimum(best[:-span], best[span:])
            span *= 2
        if span < width:
            best = np.minimum(best[: len(best) - (width - span)], best[width - span :])
        places[begin : begin + len(best)] = (best & low).astype(np.int64) + begin
    return places


def runs(units: Units, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one minimiser: text, first unit in the text, windows, minimiser's hash and place, times.

    Equal strings that follow each other, each beginning where the windows of the one before end, are one run.
    """
    none = np.zeros(0, np.int64)
    starts, ends, first = units.bounds(data, bounds)
    hashes = units.hashes(data, starts, ends)
    width = units.size - units.gram + 1
    count = np.maximum(np.diff(first) - units.size + 1, 0)
    window = ranges(first[:-1], count)
    if not len(window):
        return none, none, none, none.astype(U64), none, none
    text = np.repeat(np.arange(len(count)), count)
    place = smallest(hashes, width)[window]
    new = np.ones(len(window), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    lengths = np.diff(np.append(at, len(window)))
    text, begin, place = text[at], window[at], place[at]
    strings = units.strings(data, starts, ends, begin, begin + lengths + units.size - 1)
    alike = np.zeros(len(at), bool)
    alike[1:] = (
        (text[1:] == text[:-1])
        & (lengths[1:] == lengths[:-1])
        & (strings[1:] == strings[:-1])
        & (place[1:] - begin[1:] == place[:-1] - begin[:-1])
    )
    kept = np.flatnonzero(~alike)
    times = np.diff(np.append(kept, len(at)))
    text, begin, lengths, place = text[kept], begin[kept], lengths[kept], place[kept]
    return text, begin - first[text], lengths, hashes[place], place - first[text], times


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts with a key of two longs per (id, text); equal rows have equal keys and equal results."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    others = F.struct(*[F.col(f"`{name}`") for name in docs.columns if name.lower() != "text"])
    return docs.select(others.alias("others"), key.alias("k1"), F.xxhash64(text).alias("k2"), text.alias("text"))


_RUN = "k1 long, k2 long, minimiser long, first int, windows int, place int, times int"


def _run_rows(units: Units, keyed: DataFrame) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, whole, edges in slices(batches, "text"):
            for begin, data, bounds in units.parts(whole, edges, PART):
                text, first, windows, minimiser, place, times = runs(units, data, bounds)
                yield pa.record_batch(
                    {
                        "k1": column(rows, "k1").take(pa.array(text)),
                        "k2": column(rows, "k2").take(pa.array(text)),
                        "minimiser": pa.array(minimiser.view(np.int64)),
                        "first": pa.array(first + begin, pa.int32()),
                        "windows": pa.array(windows, pa.int32()),
                        "place": pa.array(place + begin, pa.int32()),
                        "times": pa.array(times, pa.int32()),
                    }
                )

    return keyed.select("k1", "k2", "text").mapInArrow(found, _RUN)


def _cut(units: Units, keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The packed strings of the wanted runs, hot ones divided by their second minimiser."""
    parts = ("minimiser", "first", "windows", "place", "hot", "times")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for rows, whole, edges in slices(expanded(batches, "text"), "text"):
            lists = column(rows, "runs")
            all_of = np.repeat(np.arange(rows.num_rows), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            wanted = [flat.field(name).to_numpy(zero_copy_only=False) for name in parts]
            for begin, data, bounds in units.parts(whole, edges, PART):
                starts, ends, first_unit = units.bounds(data, bounds)
                # Runs keep to the parts that they were found in.
                here = (wanted[1] >= begin) & (wanted[1] < begin + PART) if len(edges) == 2 else slice(None)
                of = all_of[here]
                minimiser, first, windows, place, hot, times = (values[here] for values in wanted)
                key = minimiser.astype(np.int64).view(U64)
                first, windows, place, times = (x.astype(np.int64) for x in (first - begin, windows, place - begin, times))
                if hot.any():
                    divided = _divide(units, data, starts, ends, first_unit, of, key, first, windows, place, times, hot.astype(bool))
                    of, key, first, windows, place, step, times = divided
                else:
                    step = windows
                strings = [
                    units.packed(data, starts, ends, int(f), int(n))
                    for f, n in zip(first + first_unit[of], windows + units.size - 1, strict=True)
                ]
                digests = [hashlib.blake2b(s, digest_size=16).digest() for s in strings]
                if len(seen) > _SEEN:
                    seen.clear()
                for k, digest in enumerate(digests):  # a task sends a string once, and its digest every time
                    if digest in seen:
                        strings[k] = None
                    seen.add(digest)
                yield pa.record_batch(
                    {
                        "k1": column(rows, "k1").take(pa.array(of)),
                        "k2": column(rows, "k2").take(pa.array(of)),
                        "first": pa.array(first + begin, pa.int32()),
                        "size": pa.array(windows + units.size - 1, pa.int32()),
                        "step": pa.array(step, pa.int32()),
                        "times": pa.array(times, pa.int32()),
                        "minimiser": pa.array(key.view(np.int64)),
                        "place": pa.array(place - first, pa.int32()),
                        "digest": binary(digests),
                        "string": binary(strings),
                    }
                )

    listed = wanted.groupBy("k1", "k2").agg(F.collect_set(F.struct(*parts)).alias("runs"))
    texts = squeezed(keyed.select("k1", "k2", "text"), "text").join(listed, ["k1", "k2"])
    schema = "k1 long, k2 long, first int, size int, step int, times int, minimiser long, place int, digest binary, string binary"
    return texts.mapInArrow(cut, schema)


def _divide(units, data, starts, ends, first_unit, of, key, first, windows, place, times, hot):
    """Divide the hot runs where their second minimiser changes; its hash joins the key."""
    width = units.size - units.gram + 1
    second = mixed(units.hashes(data, starts, ends) ^ _SECOND)
    which = np.flatnonzero(hot)
    run = np.repeat(which, windows[which])
    offset = ranges(np.zeros(len(which), np.int64), windows[which].astype(np.int64))
    window = first_unit[of[run]] + first[run] + offset
    at = smallest(second, width)[window]
    new = np.ones(len(run), bool)
    new[1:] = (at[1:] != at[:-1]) | (run[1:] != run[:-1])
    begin = np.flatnonzero(new)
    parent = run[begin]
    lengths = np.diff(np.append(begin, len(run)))
    cold = np.flatnonzero(~hot)
    return (
        np.concatenate([of[cold], of[parent]]),
        np.concatenate([key[cold], mixed(key[parent] ^ second[at[begin]])]),
        np.concatenate([first[cold], first[parent] + offset[begin]]).astype(np.int64),
        np.concatenate([windows[cold], lengths]).astype(np.int64),
        np.concatenate([place[cold], place[parent]]).astype(np.int64),
        np.concatenate([windows[cold], windows[parent]]).astype(np.int64),
        np.concatenate([times[cold], times[parent]]).astype(np.int64),
    )


Bucket = Callable[[list[bytes], np.ndarray, np.ndarray], Iterator[tuple[int, np.ndarray]]]


def _in_buckets(strings: DataFrame, bucket: Bucket) -> DataFrame:
    """Apply ``bucket`` to whole minimisers, as many at once as ``CHUNK_BYTES`` hold."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for whole in batches:
            for rows, _, bounds in slices([whole], "string", CHUNK_BYTES):
                key = column(rows, "minimiser").to_numpy()
                if held and size >= CHUNK_BYTES:
                    same = int(np.count_nonzero(key == last))  # sorted: they stand first
                    held.append(rows.slice(0, same))
                    rows = rows.slice(same)
                    if rows.num_rows:
                        yield solve(held)
                        held, size = [], 0
                if rows.num_rows:
                    held.append(rows)
                    size += int(bounds[-1])
                    last = key[-1]
        if held:
            yield solve(held)

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches([h for h in held if h.num_rows]).combine_chunks()
        keys, places = (table.column(n).to_numpy() for n in ("minimiser", "place"))
        digests, texts = table.column("digest").to_pylist(), table.column("string").to_pylist()
        _, key_number, sizes = np.unique(keys, return_inverse=True, return_counts=True)
        found = []
        alone = sizes[key_number] == 1
        order = np.argsort(key_number, kind="stable")
        several = order[~alone[order]]
        if len(several):
            for k, repeated in bucket([texts[i] for i in several], key_number[several], places[several]):
                found.append((digests[several[k]], repeated.astype("<i4").tobytes()))
        return pa.record_batch([binary([d for d, _ in found]), binary([r for _, r in found])], names=["digest", "repeated"])

    return strings.mapInArrow(chunks, "digest binary, repeated binary")


def _large(strings: DataFrame) -> DataFrame:
    """The minimisers whose distinct strings have more than ``CHUNK_BYTES``."""
    size = F.octet_length("string").cast("long").alias("bytes")
    total = F.sum("bytes").alias("bytes")
    sizes = strings.select("minimiser", "digest", size)
    most = sizes.groupBy("minimiser").agg(total).filter(F.col("bytes") > CHUNK_BYTES).select("minimiser")
    distinct = sizes.join(most, "minimiser").distinct()
    counted = distinct.groupBy("minimiser").agg(total, F.count("*").alias("n"))
    return counted.filter((F.col("bytes") > CHUNK_BYTES) & (F.col("n") > 1)).select("minimiser")


def _in_windows(units: Units, strings: DataFrame, label: str) -> DataFrame:
    """What ``_in_buckets`` gives, for strings of buckets of any size: no task holds more than a slice of them."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, bounds in slices(batches, "string"):
            found, counts = np.unique(units.windows(data, bounds)[2], return_counts=True)
            yield pa.record_batch([pa.array(found.view(np.int64)), pa.array(counts, pa.int64())], names=["h", "n"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, "string"):
            string, number, hashes, _, _ = units.windows(data, bounds)
            yield pa.record_batch(
                {
                    "h": pa.array(hashes.view(np.int64)),
                    "digest": column(rows, "digest").take(pa.array(string)),
                    "w": pa.array(number, pa.int32()),
                }
            )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, "string"):
            lists = column(rows, "ws")
            of = np.repeat(np.arange(rows.num_rows), np.diff(lists.offsets.to_numpy()))
            wanted = lists.flatten().to_numpy()
            string, _, _, begin, end = units.windows(data, bounds)
            at = np.searchsorted(string, np.arange(rows.num_rows))[of] + wanted
            texts = (data[b:e].tobytes() for b, e in zip(begin[at].tolist(), end[at].tolist(), strict=True))
            yield pa.record_batch(
                {
                    "digest": column(rows, "digest").take(pa.array(of)),
                    "w": pa.array(wanted, pa.int32()),
                    "text": binary([hashlib.blake2b(t, digest_size=16).digest() for t in texts]),
                }
            )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in column(batch, "ws"):
                own = np.array(row.as_py())
                again = np.zeros(own.max() + 1, bool)
                again[own] = True
                found.append(spans(again).astype("<i4").tobytes())
            yield pa.record_batch([column(batch, "digest"), binary(found)], names=["digest", "repeated"])

    counted = strings.select("string").mapInArrow(hashed, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    likely = store(counted.filter("n > 1").select("h"), f"{label}_hashes")
    # The repeated hashes are stored, so that Spark can send them all round or cut up a hash that many strings have.
    listed = strings.select("digest", "string").mapInArrow(placed, "h long, digest binary, w int").join(likely, "h")
    listed = listed.groupBy("digest").agg(F.collect_list("w").alias("ws"))  # a run's windows: at most size - gram + 1
    texts = strings.select("digest", "string").join(listed, "digest")
    texts = store(texts.mapInArrow(read, "digest binary, w int, text binary"), f"{label}_windows")
    same = store(texts.groupBy("text").agg(F.count("*").alias("n")).filter("n > 1").select("text"), f"{label}_same")
    again = texts.join(same, "text").groupBy("digest").agg(F.collect_list("w").alias("ws"))
    return again.mapInArrow(packed, "digest binary, repeated binary")


def spans(bool_rows: np.ndarray) -> np.ndarray:
    """The runs of true values as rows of (begin, end)."""
    edges = np.diff(np.concatenate([[0], bool_rows.astype(np.int8), [0]]))
    return np.stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)], 1)


def repeated_spans(units: Units, docs: DataFrame, bucket: Bucket, label: str) -> DataFrame:
    """Each row of ``docs`` as (others: its columns but the text, the squeezed text, marks: where windows occur again).

    A mark has the first unit and size of a string, how often it follows itself by how many units, and the spans of its
    windows that occur again (null: all).
    """
    spark = docs.sparkSession
    keyed = _keyed(docs)
    found = store(_run_rows(units, keyed), f"{label}_runs")
    counted = found.groupBy("minimiser").agg(F.sum("times").alias("n")).filter("n > 1")
    # Stored, so that Spark can cut up the runs of a minimiser that a large share of them has.
    repeated = store(counted.select("minimiser", (F.col("n") > HOT).alias("hot")), f"{label}_minimisers")
    wanted = found.join(repeated, "minimiser")
    cut = store(_cut(units, keyed, wanted), f"{label}_strings")
    discard(found)
    volume = bytes_of(cut, "string")
    strings = cut.filter("string IS NOT NULL").select("minimiser", "digest", "place", "string")
    large = store(_large(strings), f"{label}_large")
    small = strings.join(large, "minimiser", "left_anti").dropDuplicates(["minimiser", "digest", "place", "string"])
    dealt = small.repartition(task_count(spark, volume, BUCKET_BYTES), "minimiser").sortWithinPartitions("minimiser")
    flags = _in_buckets(dealt, bucket)
    if not large.isEmpty():
        crowded = strings.join(large, "minimiser", "left_semi").select("digest", "string").dropDuplicates(["digest", "string"])
        flags = flags.union(_in_windows(units, store(crowded, f"{label}_crowded"), label))
    flags = store(flags, f"{label}_flags")
    copied = cut.groupBy("digest").agg(F.sum("times").alias("n")).filter("n > 1").select("digest", F.lit(True).alias("whole"))
    marks = flags.join(copied, "digest", "full").select(
        "digest", F.when(F.col("whole").isNull(), F.col("repeated")).alias("repeated")
    )
    placed = ("first", "size", "step", "times")
    located = cut.select("k1", "k2", *placed, "digest").join(marks, "digest")
    listed = located.groupBy("k1", "k2").agg(F.collect_set(F.struct(*placed, "repeated")).alias("marks"))
    return squeezed(keyed, "text").join(listed, ["k1", "k2"], "left").select("others", "text", "marks")


def covered(marks: pa.ListArray, row: int, size: int, n: int) -> np.ndarray:
    """Which of the ``n`` units of a text the repeated windows of ``size`` units cover."""
    steps = np.zeros(n + 1, np.int32)
    for mark in marks[row].as_py() or []:
        if mark["repeated"] is None:
            begin, end = np.array([mark["first"]]), np.array([mark["first"] + mark["size"]])
        else:
            pairs = mark["first"] + np.frombuffer(mark["repeated"], "<i4").reshape(-1, 2)
            begin, end = pairs[:, 0], pairs[:, 1] + size - 1
        if mark["times"] > 1:
            again = (np.arange(mark["times"]) * mark["step"])[:, None]
            begin, end = (begin + again).ravel(), (end + again).ravel()
        np.add.at(steps, begin, 1)
        np.add.at(steps, end, -1)
    return np.cumsum(steps[:-1]) > 0
