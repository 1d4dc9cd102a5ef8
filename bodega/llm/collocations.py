"""Phrases whose words keep company: counts of word sequences from weighted automata, and the score of each phrase.

Every word occurrence starts one sequence: itself and up to three words that follow it in its piece. A phrase's count is
the weight of the prefix that it is, the sum over all sequences that go on from there, so sequences of four words hold the
counts of all lengths. A task builds the automaton of each shard of its texts from the sorted sequences. Shards are
cut at common boundaries into prefix ranges of about ``RANGE`` sequences, taken from all shards, and the automata of a
range are united, which adds up counts. Only prefixes at the edge of a range can go on in the next; their counts are
added up by phrase. So no key gathers in a task, however common its first word. A shard is cut into ``FAN`` pieces at most:
with more ranges than that, shards are first dealt to groups of ranges and united there, so that pieces stay large.

Candidates are then composed with the counts: each cut of a candidate asks for the weights of its two parts.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bodega.llm import automata
from bodega.llm.arrays import LOWER, column, slices, words
from bodega.llm.ranks import placed
from bodega.llm.shared import store, task_number

LEAST = 30
SCALE = 2_000_000
INSIDE_PERCENT = 80
TOP = 2000
UNKNOWN = "und"
SHARD = 1_000_000
RANGE = 1_000_000
FAN = 256
_GUIDES = 32
_SALTS = 64
_BREAK = np.zeros(256, bool)
_BREAK[[ord(sign) for sign in ".,;:!?\n\x0b\x0c\r"]] = True
_BETWEEN = _BREAK.copy()
_BETWEEN[[ord(" "), ord("\t")]] = True


def sequences(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of texts, each occurrence's number among them, the words left in its piece, and words per text."""
    data = LOWER[data]
    starts, ends, first = words(data, bounds, _BETWEEN)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    held = [None, pa.py_buffer(offsets), pa.py_buffer(data[~_BETWEEN[data]])]
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), held).dictionary_encode()
    piece = np.cumsum(_BREAK[data])[starts] if len(starts) else starts
    last = np.ones(len(starts), bool)
    last[:-1] = piece[1:] != piece[:-1]
    closed = first[1:][first[1:] > 0] - 1
    last[closed] = True
    at = np.flatnonzero(last)
    left = at[np.searchsorted(at, np.arange(len(starts)))] - np.arange(len(starts)) if len(at) else starts
    return found.dictionary, found.indices.to_numpy().astype(np.int64), left, np.diff(first)


class Shard:
    """Gathers the words of texts and gives their automaton."""

    def __init__(self) -> None:
        self._parts: list = []
        self.words = 0

    def add(self, groups: pa.Array, data: np.ndarray, bounds: np.ndarray) -> None:
        names, numbers, left, each = sequences(data, bounds)
        group = groups.dictionary_encode()
        owner = np.repeat(group.indices.to_numpy(), each)
        self._parts.append((names, numbers, left, group.dictionary.to_pylist(), owner))
        self.words += len(numbers)

    def built(self) -> automata.Sequences:
        names, places = automata.renamed([part[0] for part in self._parts])
        groups = sorted({name.encode() for part in self._parts for name in part[3]})
        rows = np.zeros((self.words, automata.DEPTH), np.int32)
        begin = 0
        for (_, numbers, left, own, owner), place in zip(self._parts, places, strict=True):
            part = rows[begin : begin + len(numbers)]
            begin += len(numbers)
            part[:, 0] = np.array([groups.index(name.encode()) for name in own], np.int32)[owner]
            symbols = place[numbers] + 1
            for k in range(automata.WORDS):
                part[: len(symbols) - k, k + 1] = np.where(left[: len(symbols) - k] >= k, symbols[k:], 0)
        return automata.counted(groups, names, rows)


def _shards(docs: DataFrame, size: int, step: int) -> DataFrame:
    """The automata of all shards, each with keys of every so many-th sequence of it."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pick = np.random.default_rng(task_number())
        shard = Shard()

        def row() -> pa.RecordBatch:
            found = shard.built()
            guides = [found.key(at) for at in range(int(pick.integers(step)), len(found.rows), step)]
            blobs = pa.array([automata.written(found)], pa.binary())
            return pa.record_batch([pa.array([guides], pa.list_(pa.binary())), blobs], names=["guides", "automaton"])

        for rows, data, bounds in slices(batches, "text"):
            shard.add(column(rows, "lang"), data, bounds)
            if shard.words >= size:
                yield row()
                shard = Shard()
        if shard.words:
            yield row()

    return docs.mapInArrow(build, "guides array<binary>, automaton binary")


def _phrases(found: automata.Sequences) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """Prefixes of 0 to 4 words: first rows, number of words, weights, and whether one may go on in another range."""
    rows = found.rows
    for k in range(automata.DEPTH):
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, : k + 1] != rows[:-1, : k + 1]).any(axis=1)
        first = np.flatnonzero(new)
        weights = np.add.reduceat(found.counts, first)
        edge = np.zeros(len(first), bool)
        edge[[0, -1]] = True
        if k:
            whole = rows[first, k] > 0
            first, weights, edge = first[whole], weights[whole], edge[whole]
        yield first, k, weights, edge


def _by_range(batches: Iterator[pa.RecordBatch], at_most: int) -> Iterator[tuple[int, list[automata.Sequences], bool]]:
    """Automata of one range at a time, in lots of about ``at_most`` sequences, and whether a lot ends its range."""
    held: list[automata.Sequences] = []
    current, size = None, 0
    for batch in batches:
        for number, blob in zip(column(batch, "range").to_pylist(), column(batch, "automaton"), strict=True):
            if held and (number != current or size > at_most):
                yield current, held, number != current
                held, size = [], 0
            current = number
            held.append(automata.read(blob.as_py()))
            size += len(held[-1].rows)
    if held:
        yield current, held, True


def _frequent(batches: Iterator[pa.RecordBatch], least: int, at_most: int) -> Iterator[pa.RecordBatch]:
    """Phrases of each range, rows being sorted by range."""
    before: list[automata.Sequences] = []
    for _, held, last in _by_range(batches, at_most):
        before = [automata.united([*before, *held])]
        if not last:
            continue
        found, before = before[0], []
        for first, k, weights, edge in _phrases(found):
            kept = edge | (weights >= least)
            at = first[kept]
            rows = found.rows[at]
            parts = [found.words.take(pa.array(rows[:, j + 1] - 1)) for j in range(k)]
            text = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if k else pa.array([b""] * len(at))
            group = pa.array(found.groups, pa.binary()).take(pa.array(rows[:, 0]))
            yield pa.record_batch(
                [
                    group.cast(pa.string()),
                    pa.array(np.full(len(at), k), pa.int32()),
                    text.cast(pa.binary()).cast(pa.string()),
                    pa.array(weights[kept]),
                    pa.array(edge[kept] | (k == 0)),
                ],
                names=["lang", "words", "phrase", "f", "open"],
            )


def _pieces(shards: DataFrame, edges, stride: int) -> DataFrame:
    """Automata cut at every ``stride``-th of the broadcast ``edges``: (range, automaton)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = edges.value[stride - 1 :: stride]
        for batch in batches:
            for blob in column(batch, "automaton"):
                found = automata.read(blob.as_py())
                # Keys have long words cut, so both ends of the search are taken one wider.
                begin = max(0, bisect_left(keys, found.key(0)) - 1)
                own = keys[begin : bisect_left(keys, found.key(len(found.rows) - 1)) + 1]
                at = np.concatenate([[0], found.lower_bounds(own), [len(found.rows)]])
                for number in np.flatnonzero(np.diff(at)):
                    part = automata.written(found.slice(int(at[number]), int(at[number + 1])))
                    rank = pa.array([begin + number], pa.int32())
                    yield pa.record_batch([rank, pa.array([part], pa.binary())], names=["range", "automaton"])

    return shards.select("automaton").mapInArrow(cut, "range int, automaton binary")


def _regrouped(pieces: DataFrame, tasks: int, groups: int, at_most: int) -> DataFrame:
    """Pieces of the same range united into automata of about ``at_most`` sequences."""

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, _ in _by_range(batches, at_most):
            yield pa.record_batch([pa.array([automata.written(automata.united(held))], pa.binary())], names=["automaton"])

    salted = pieces.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(groups)))
    dealt = salted.repartition(tasks, "range", "salt").sortWithinPartitions("range")
    return dealt.select("range", "automaton").mapInArrow(unite, "automaton binary")


def counts(docs: DataFrame, least: int = LEAST, size: int = SHARD, span: int = RANGE, fan: int = FAN) -> DataFrame:
    """(lang, words, phrase, f): all phrases of one to four words with ``f`` of at least ``least``, and per lang the
    number of word occurrences as the phrase of no words.

    A shard has about ``size`` words, a range about ``span`` sequences; a shard is cut into ``fan`` pieces or so at a time.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string"))
    shards = store(_shards(chosen, size, max(1, span // _GUIDES)), "shards")
    guides = shards.select(F.lit(0).alias("all"), F.explode("guides").alias("key"))
    chosen = placed(guides, "all", ["key"], "guides").filter((F.col("place") + 1) % _GUIDES == 0)
    # As many as there are ranges, at most 330 bytes each.
    edges = sorted(bytes(row.key) for row in chosen.select("key").collect())
    shared = spark.sparkContext.broadcast(edges)
    strides = [1]
    while strides[-1] * fan <= len(edges):
        strides.append(strides[-1] * fan)
    for stride in reversed(strides[1:]):
        number = shards.count()
        groups = -(-number * stride // (len(edges) + 1))
        shards = store(_regrouped(_pieces(shards, shared, stride), number, groups, span), "shards")
    dealt = _pieces(shards, shared, 1).repartitionById(len(edges) + 1, "range").sortWithinPartitions("range")
    schema = "lang string, words int, phrase string, f long, open boolean"
    found = store(dealt.mapInArrow(lambda batches: _frequent(batches, least, 2 * span), schema), "phrases")
    joined = found.filter("open").groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
    joined = joined.filter((F.col("f") >= least) | (F.col("words") == 0))
    return found.filter("NOT open").drop("open").unionByName(joined)


def _parts(phrase: str, begin: str, length: str) -> str:
    return f"array_join(slice(split({phrase}, ' '), {begin}, {length}), ' ')"


def scored(phrases: DataFrame, percent: int = INSIDE_PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates among ``phrases`` that no longer candidate accounts for."""
    candidates = phrases.filter("words > 1").withColumnRenamed("f", "a")
    cuts = candidates.select("*", F.explode(F.expr("sequence(1, words - 1)")).alias("cut"))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "cut",
        F.expr(_parts("phrase", "1", "cut")).alias("head"),
        F.expr(_parts("phrase", "cut + 1", "words")).alias("rest"),
    )
    # Composition of the candidates' cuts with the counts; a part that many candidates share is a skewed key, which
    # the adaptive plan cuts up.
    known = phrases.filter("words > 0").select("lang", "phrase", "f")
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"])
    score = f"CAST(CAST({SCALE} AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(20, 0)) DIV (CAST(l AS DECIMAL(20, 0)) + r) AS BIGINT)"
    best = F.min(F.struct(F.expr(score).alias("score"), "cut", "l", "r")).alias("best")
    lowest = cuts.groupBy("lang", "phrase", "a").agg(best)

    inner = """flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1),
        begin -> array_join(slice(split(phrase, ' '), begin, n), ' '))))"""
    inside = candidates.filter("words > 2").select("lang", F.explode(F.expr(inner)).alias("phrase"), "a")
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = lowest.join(inside, ["lang", "phrase"], "left")
    covers = f"CAST(longer AS DECIMAL(20, 0)) * 100 >= CAST(a AS DECIMAL(20, 0)) * {percent}"
    kept = kept.filter(F.expr(f"longer IS NULL OR NOT ({covers})"))
    return kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, percent: int = INSIDE_PERCENT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each lang by score, count and text.

    Null texts have no words and a null lang is ``und``; a lang without candidates, and an empty table, give no rows.
    Rows with null or repeated ids, and equal rows, count each. Columns other than ``lang`` and ``text`` play no part.
    """
    phrases = store(counts(docs, least), "counts")
    rows = scored(phrases, percent)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    first = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    rows = salted.withColumn("first", first).filter(F.col("first") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    rows = rows.withColumn("rank", rank).filter(F.col("rank") <= top)
    totals = phrases.filter("words = 0").select("lang", F.col("f").alias("n"))
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


