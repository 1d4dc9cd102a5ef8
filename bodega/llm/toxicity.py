"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses, and the words of a clause into the classes insult, threat, target, negation, report and
quote. Five small transducers read the classes side by side: an insult or threat emits its weight, and its neighbours change
it; a target near by makes it count more, a negation before it or reported speech around it less. Their product scores the
matched parts of a clause, and a clause without insult or threat scores nothing. The words of the grammar's open
classes, whole or by their stems, and the weights of the features are learned from labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.llm.arrays import BYTE_VALUES, LOWER, NO_LETTER, column, slices, span_hashes, words
from bodega.llm.language import held_out

TRAIN_ROWS = 20_000
MOST_TERMS = 4096
LEAST_TEXTS = 5
LEAST_ODDS = 3.0
STEMS = (4, 5, 6)
THRESHOLD = 0.7

# The closed classes of the grammar, in the languages of the corpus.
CLASSES = {
    "threat": "kill hurt destroy burn shoot stab beat punch töte töten umbringen schlagen tuer frapper brûler "
    "matar golpear quemar disparar",
    "target": "you your yours he she they him her them his their these those is are am du dein ihr euch er sie ist sind "
    "tu vous toi il elle ils elles est sont es êtes tú usted ustedes él ella ellos ellas son eres",
    "negation": "not no never nobody none neither nor nicht kein keine nie niemand ne pas jamais aucun personne nunca "
    "ningún ninguna nadie tampoco",
    "report": "said says say told called claims claimed wrote quoted sagte sagt schrieb nannte dit disait écrit dijo dice "
    "escribió llamó according laut selon según",
}
INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "insult", "threat", "target", "negation", "report", "other"

# Arcs as class -> (next state, factor); a class without an arc goes back to the start state.
MATCHERS = {INSULT: {"start": {INSULT: ("start", 1.0)}}, THREAT: {"start": {THREAT: ("start", 1.0)}}}
CONTEXTS = (
    {  # a target up to three words before
        "start": {TARGET: ("near", 1.0), OTHER: ("start", 1.0)},
        "near": {TARGET: ("near", 1.0), OTHER: ("far", 1.0), INSULT: ("start", 1.25), THREAT: ("start", 1.25)},
        "far": {TARGET: ("near", 1.0), OTHER: ("last", 1.0), INSULT: ("start", 1.15), THREAT: ("start", 1.15)},
        "last": {TARGET: ("near", 1.0), OTHER: ("start", 1.0), INSULT: ("start", 1.1), THREAT: ("start", 1.1)},
    },
    {  # a negation up to two words before
        "start": {NEGATION: ("near", 1.0), OTHER: ("start", 1.0)},
        "near": {NEGATION: ("start", 1.0), OTHER: ("far", 1.0), TARGET: ("near", 1.0), INSULT: ("start", 0.6), THREAT: ("start", 0.4)},
        "far": {NEGATION: ("near", 1.0), OTHER: ("start", 1.0), TARGET: ("far", 1.0), INSULT: ("start", 0.75), THREAT: ("start", 0.6)},
    },
    {  # reported speech from its verb on
        "start": {REPORT: ("said", 1.0), OTHER: ("start", 1.0)},
        "said": {
            REPORT: ("said", 1.0), OTHER: ("said", 1.0), TARGET: ("said", 1.0), NEGATION: ("said", 1.0),
            INSULT: ("said", 0.8), THREAT: ("said", 0.6),
        },
    },
)
_NAMES = (OTHER, THREAT, TARGET, NEGATION, REPORT)
_BREAKS = np.zeros(256, bool)
_BREAKS[list(b".!?;:\n|")] = True


def clause_score(classes: list[str], weights: list[float]) -> float:
    """The summed weight of the insults and threats of a clause under the composed transducers."""
    states = ["start"] * len(CONTEXTS)
    total = 0.0
    for kind, weight in zip(classes, weights, strict=True):
        factor = 1.0
        for k, machine in enumerate(CONTEXTS):
            states[k], step = machine[states[k]].get(kind, ("start", 1.0))
            factor *= step
        if kind in MATCHERS:
            total += weight * factor * MATCHERS[kind]["start"][kind][1]
    return total


def _hash(term: str) -> int:
    data = np.frombuffer(term.encode(), np.uint8)
    return int(span_hashes(BYTE_VALUES[data], np.array([0]), np.array([len(data)]))[0])


def _tokens(data: np.ndarray, bounds: np.ndarray):
    data = LOWER[data]
    starts, ends, first = words(data, bounds, NO_LETTER)
    values = BYTE_VALUES[data]
    whole = span_hashes(values, starts, ends)
    stems = [span_hashes(values, starts, np.minimum(starts + k, ends)) for k in STEMS]
    return starts, ends, first, whole, stems


class Grammar:
    """The learned terms and weights beside the closed classes."""

    def __init__(self, terms: list[tuple[str, bool, float]]) -> None:
        self.closed = {np.uint64(_hash(w)): k for k, name in enumerate(_NAMES) if k for w in CLASSES[name].split()}
        self.whole = {_hash(term): odds for term, stem, odds in terms if not stem}
        self.stems = [{_hash(t): odds for t, stem, odds in terms if stem and len(t.encode()) == k} for k in STEMS]
        self.weights = np.array([-4.0, 1.0, 0.0, 0.0])

    @staticmethod
    def _lookup(table: dict, hashes: np.ndarray) -> np.ndarray:
        keys = np.array(sorted(table), np.uint64)
        if not len(keys):
            return np.zeros(len(hashes))
        values = np.array([table[int(k)] if int(k) in table else table[k] for k in keys], float)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return np.where(keys[at] == hashes, values[at], 0.0)

    def features(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Per text: 1, the best clause, the logarithm of all clauses' scores, and the scores per hundred words."""
        starts, ends, first, whole, stems = _tokens(data, bounds)
        odds = self._lookup(self.whole, whole)
        for table, hashes, k in zip(self.stems, stems, STEMS, strict=True):
            odds = np.maximum(odds, np.where(ends - starts > k, self._lookup(table, hashes), 0.0))
        kinds = self._lookup(self.closed, whole).astype(int)
        hit = np.flatnonzero((odds > 0) | (kinds == 1))
        result = np.zeros((len(bounds) - 1, 4))
        result[:, 0] = 1
        if len(hit):
            ended = np.concatenate([[0], np.cumsum(_BREAKS[data])])
            clause = ended[starts] + np.arange(len(bounds) - 1).repeat(np.diff(first))  # one more at a new text
            begin = np.searchsorted(clause, clause[hit])
            end = np.searchsorted(clause, clause[hit], "right")
            text = np.searchsorted(first, hit, "right") - 1
            done = set()
            for b, e, t in zip(begin.tolist(), end.tolist(), text.tolist(), strict=True):
                if b in done:
                    continue
                done.add(b)
                names = [INSULT if odds[k] > 0 else _NAMES[kinds[k]] for k in range(b, e)]
                score = clause_score(names, [odds[k] if odds[k] > 0 else LEAST_ODDS for k in range(b, e)])
                result[t, 1] = max(result[t, 1], score)
                result[t, 2] += score
            number = np.maximum(np.diff(first), 1)
            result[:, 3] = 100 * result[:, 2] / number
            result[:, 1:] = np.log1p(result[:, 1:])
        return result

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -30, 30)))


def _terms(labelled: DataFrame) -> list[tuple[str, bool, float]]:
    """Words and stems that toxic texts have and others don't, with their log odds; the strongest ``MOST_TERMS``."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, "text"):
            starts, ends, first, *_ = _tokens(data, bounds)
            low = LOWER[data].tobytes()
            toxic = column(rows, "toxic").to_numpy()
            terms, stem, label = [], [], []
            for k in range(rows.num_rows):
                spans = zip(starts[first[k] : first[k + 1]].tolist(), ends[first[k] : first[k + 1]].tolist(), strict=True)
                own = {low[b:e] for b, e in spans}
                prefixes = {w[:n] for w in own for n in STEMS if len(w) > n}
                terms += [*own, *prefixes]
                stem += [False] * len(own) + [True] * len(prefixes)
                label += [int(toxic[k])] * (len(own) + len(prefixes))
            yield pa.record_batch(
                [binary_terms(terms), pa.array(stem, pa.bool_()), pa.array(label, pa.int32())], names=["term", "stem", "toxic"]
            )

    def binary_terms(terms: list[bytes]) -> pa.Array:
        return pa.array(terms, pa.binary())

    totals = labelled.agg(F.sum("toxic"), F.count("*")).first()
    bad, all_of = (x or 0 for x in totals)
    seen = labelled.mapInArrow(listed, "term binary, stem boolean, toxic int").groupBy("term", "stem")
    counts = seen.agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    a, b = F.col("bad") + 0.5, F.col("n") - F.col("bad") + 0.5
    odds = F.log(a / (bad + 1 - a)) - F.log(b / (all_of - bad + 1 - b))
    strong = counts.withColumn("odds", odds).filter((F.col("bad") >= LEAST_TEXTS) & (F.col("odds") >= LEAST_ODDS))
    rows = strong.orderBy(F.desc("odds"), "term", "stem").limit(MOST_TERMS).collect()
    return [(bytes(r["term"]).decode(errors="replace"), r["stem"], r["odds"]) for r in rows]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, slightly held to zero."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - 0.01 * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, at_most: int = TRAIN_ROWS) -> Grammar:
    """Learn the grammar from labelled rows that are not held out, ``at_most`` of them, chosen by a hash of their id."""
    chosen = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    chosen = chosen.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most)
    texts = docs.select(F.col("doc_id").cast("long"), F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    labelled = texts.join(F.broadcast(chosen), "doc_id")  # at most at_most rows of two numbers
    grammar = Grammar(_terms(labelled))
    if not (grammar.whole or any(grammar.stems)):
        return grammar
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, "text"):
            found = shared.value.features(data, bounds)
            names = ["toxic", "a", "b", "c", "d"]
            yield pa.record_batch([column(rows, "toxic"), *(pa.array(found[:, k]) for k in range(4))], names=names)

    rows = labelled.mapInArrow(featured, "toxic int, a double, b double, c double, d double").toArrow()
    x = np.stack([rows.column(n).to_numpy() for n in "abcd"], 1)
    grammar.weights = _logistic(x, rows.column("toxic").to_numpy().astype(float))
    return grammar


def scored(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; a null or empty text scores as one without a match."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)
    kept = held_out(F.col("doc_id")).alias("held_out")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, "text"):
            found = shared.value.scores(shared.value.features(data, bounds))
            yield pa.record_batch(
                [column(rows, "doc_id"), column(rows, "held_out"), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    fields = [docs.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())]
    rows = docs.select("doc_id", kept, F.lower(F.col("text").cast("string")).alias("text"))
    return rows.mapInArrow(score, T.StructType([*fields, T.StructField("predicted", T.IntegerType())]))
