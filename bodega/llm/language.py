"""Language identification by interpolated Kneser-Ney models of characters.

Letters in lower case are ``SYMBOLS`` classes (a to z their own, other letters by hash), everything between words is
one more. Counts of ``ORDER`` consecutive symbols are gathered from all learning texts of each language; the lower
orders follow from them as continuation counts. The probabilities stand in one array sorted by the hash of the symbols, with a
column per language; what no language has seen backs off. A text goes to the language with the lowest cross-entropy per symbol.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.llm.arrays import column, slices

ORDER = 4
BITS = 6
SYMBOLS = 1 << BITS
DISCOUNT = 0.75
REJECT_SPREAD = 1.0
REJECT_NOISE = 6.0
SHARPNESS = 20
_MERGE = 1 << 21


@lru_cache(1)
def _symbols() -> np.ndarray:
    """The symbol of every code point: 0 between words, letters from 1 on."""
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalpha():
            lower = ord(letter.lower()[0])
            table[code] = lower - 96 if 97 <= lower <= 122 else 27 + lower * 2654435761 % (1 << 32) % (SYMBOLS - 27)
    return table


def grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes of ``ORDER`` symbols at every symbol of the texts, and the bounds of each text's codes.

    A text begins after a gap; several gaps in a row are one, and a text without letters has no codes.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=before[1:])
    edges = before[bounds]
    symbols = _symbols()[codes]
    keep = symbols > 0
    follows = np.zeros(len(symbols), bool)
    follows[1:] = keep[:-1]
    inner = edges[(edges > 0) & (edges < len(symbols))]
    follows[inner] = False
    keep |= follows
    kept = np.concatenate([[0], np.cumsum(keep)])[edges]
    symbols = symbols[keep].astype(np.int64)
    total = symbols.copy()
    place = np.arange(len(symbols)) - np.repeat(kept[:-1], np.diff(kept))
    for k in range(1, ORDER):
        earlier = np.zeros(len(symbols), np.int64)
        earlier[k:] = symbols[:-k] if k else symbols
        earlier[place < k] = 0
        total |= earlier << (BITS * k)
    return total, kept


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def counted(docs: DataFrame) -> DataFrame:
    """(lang, code, n) over all of ``docs``: one row per language and code, added up in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting = 0

        def merged(parts):
            codes, sums = (np.concatenate(x) for x in zip(*parts, strict=True))
            distinct, which = np.unique(codes, return_inverse=True)
            return distinct, np.bincount(which, sums, len(distinct)).astype(np.int64)

        def out():
            for lang, parts in held.items():
                codes, sums = merged(parts)
                yield pa.record_batch(
                    [pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(sums)],
                    names=["lang", "code", "n"],
                )

        for rows, data, bounds in slices(batches, "text"):
            codes, first = grams(data, bounds)
            langs = np.array(column(rows, "lang").to_pylist(), object)
            of = np.repeat(np.arange(len(langs)), np.diff(first))
            for lang in set(langs.tolist()):
                own = np.unique(codes[(langs == lang)[of]], return_counts=True)
                held.setdefault(lang, []).append(own)
                waiting += len(own[0])
            if waiting > _MERGE:
                held = {lang: [merged(parts)] for lang, parts in held.items()}
                waiting = 0
        yield from out()

    learned = docs.select("text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    return learned.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def _lower(codes: np.ndarray, counts: np.ndarray, order: int, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The interpolated probabilities of one order for the given codes, and the weight left to ``below`` by context."""
    contexts = 1 << (BITS * (order - 1))
    context = codes >> BITS
    totals = np.bincount(context, counts, contexts)
    kinds = np.bincount(context, minlength=contexts)
    seen = totals > 0
    weight = np.ones(contexts)
    weight[seen] = DISCOUNT * kinds[seen] / totals[seen]
    share = np.maximum(counts - DISCOUNT, 0) / totals[context]
    return share + weight[context] * below[codes & (contexts - 1)], weight


class Model:
    """Kneser-Ney models of several languages, by one sorted array of codes."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        self.languages = sorted(counts)
        self.codes = np.unique(np.concatenate([*(c for c, _ in counts.values()), np.zeros(0, np.int64)]))
        wide = 1 << (BITS * (ORDER - 1))
        self.table = np.zeros((len(self.codes), len(counts)), np.float32)
        self.unseen = np.zeros((wide, len(counts)), np.float32)  # the weight of the shorter context, by context
        self.shorter = np.zeros((wide, len(counts)), np.float32)  # its probability, by the last symbols
        self.mean, self.spread = np.zeros(len(counts)), np.zeros(len(counts))
        for k, lang in enumerate(self.languages):
            codes, n = counts[lang]
            levels = [(codes, n.astype(float))]
            for order in range(ORDER - 1, 0, -1):
                levels.append(np.unique(levels[-1][0] & ((1 << (BITS * order)) - 1), return_counts=True))
            below = np.full(1, 1 / SYMBOLS)
            for order, (own, sums) in zip(range(1, ORDER), reversed(levels[1:]), strict=True):
                found, weight = _lower(own, sums, order, below)
                every = np.arange(1 << (BITS * order))
                dense = weight[every >> BITS] * below[every & ((1 << (BITS * (order - 1))) - 1)]
                dense[own] = found
                below = dense
            found, weight = _lower(*levels[0], ORDER, below)
            self.unseen[:, k], self.shorter[:, k] = np.log(weight), np.log(below)
            self.table[:, k] = self.unseen[self.codes >> BITS, k] + self.shorter[self.codes & (wide - 1), k]
            self.table[np.searchsorted(self.codes, codes), k] = np.log(found)
            share = n / n.sum()
            self.mean[k] = -(share * np.log(found)).sum()
            self.spread[k] = math.sqrt((share * (np.log(found) + self.mean[k]) ** 2).sum())

    def entropies(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Cross-entropy per symbol of every text under every language; 0 for a text without symbols."""
        at = np.searchsorted(self.codes, codes)
        at[at == len(self.codes)] = 0
        logs = self.table[at] if len(self.codes) else np.zeros((len(codes), 0), np.float32)
        new = np.flatnonzero(self.codes[at] != codes) if len(self.codes) else np.zeros(0, np.int64)
        logs[new] = self.unseen[codes[new] >> BITS] + self.shorter[codes[new] & (len(self.shorter) - 1)]
        sums = np.zeros((len(first) - 1, len(self.languages)))
        full = np.flatnonzero(np.diff(first))
        if len(full):
            sums[full] = -np.add.reduceat(logs.astype(np.float64), first[:-1][full], axis=0)
        return sums / np.maximum(np.diff(first), 1)[:, None]

    def decide(self, data: np.ndarray, bounds: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether the text is rejected, for every text.

        The score is the language's share when every symbol counts, ``SHARPNESS`` at most. A text is rejected if
        it has no letter, or if its cross-entropy is above what the language's own learning text has by
        ``REJECT_SPREAD`` deviations of a symbol and ``REJECT_NOISE`` of the mean of as many symbols as it has.
        """
        codes, first = grams(data, bounds)
        n = np.diff(first)
        if not self.languages:
            return ["und"] * len(n), np.zeros(len(n)), np.ones(len(n), bool)
        entropy = self.entropies(codes, first)
        best = entropy.argmin(axis=1)
        lowest = entropy[np.arange(len(n)), best]
        sharp = np.minimum(n, SHARPNESS)[:, None]
        score = 1 / np.exp(-(entropy - lowest[:, None]) * sharp).sum(axis=1)
        noise = REJECT_NOISE / np.sqrt(np.maximum(n, 1))
        rejected = (n == 0) | (lowest > self.mean[best] + self.spread[best] * (REJECT_SPREAD + noise))
        return [self.languages[b] if k else "und" for b, k in zip(best, n, strict=True)], np.where(n > 0, score, 0), rejected


def fit(docs: DataFrame) -> Model:
    """Models of all languages in ``docs`` (text, lang), from the rows that are not held out.

    What comes to the driver is at most ``SYMBOLS ** ORDER`` counts per language, whatever the size of the corpus.
    """
    rows = counted(docs.filter(~held_out(F.col("doc_id")))).toArrow()
    langs = np.array(rows.column("lang").to_pylist(), object)
    codes, n = rows.column("code").to_numpy(), rows.column("n").to_numpy()
    order = np.argsort(codes, kind="stable")
    return Model({lang: (codes[order][langs[order] == lang], n[order][langs[order] == lang]) for lang in set(langs.tolist())})


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs`` as (others: all columns, lang_pred, score, rejected).

    ``lang_pred`` is ``und`` with score 0 for a text that is null or has no letter. Only the text is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column(batch, "others").field("text").cast(pa.string())
            work = pa.RecordBatch.from_arrays([column(batch, "others"), texts], names=["others", "_text"])
            for rows, data, bounds in slices([work], "_text"):
                lang, score, rejected = shared.value.decide(data, bounds)
                yield pa.record_batch(
                    [column(rows, "others"), pa.array(lang), pa.array(score), pa.array(rejected)],
                    names=["others", "lang_pred", "score", "rejected"],
                )

    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("others"))
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return rows.mapInArrow(decide, T.StructType([rows.schema["others"], *fields, T.StructField("rejected", T.BooleanType())]))
