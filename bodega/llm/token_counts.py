"""Token counts of whole texts from a table of frequent pre-token lengths, without a pre-token shuffle.

The vocabulary cuts a normalised text into pre-tokens and merges inside each, so a text's count is the sum of its
pre-tokens' lengths in tokens. Array operations find the pre-tokens of a slice of texts and hash them. The first tier is
a compact hash table of frequent pre-tokens that every task gets by broadcast; what misses it is looked up in the worker's
cache, and the library encodes each remaining distinct pre-token once.

Which pre-tokens are frequent is counted over all texts: a task keeps a bounded summary of heavy hitters
(Misra and Gries), and summaries, not pre-tokens, are merged in rounds until one is left. The table decides about time
only; counts are those of the library whatever it holds.

A pre-token is told from others by a 64-bit hash, which also covers its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from bodega.llm.arrays import U64, WHITE, column, mixed, slices, span_hashes
from bodega.llm.shared import store

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
FREQUENT = 1 << 14
MERGED_AT_ONCE = 32
_SLOT_BITS = 16
_CACHED = 1 << 20
_PART_BYTES = 1 << 20
_JOINED = 1 << 18
_ASKED = 0x110000
#: Below this code point no character composes with the one before it.
_PLAIN = 0x300
_UNKNOWN, _LETTER, _DIGIT, _SPACE, _SIGN = range(5)
_QUOTE = ord("'")

Summary = tuple[np.ndarray, np.ndarray, np.ndarray]


class Table:
    """Hash to length by open addressing in two flat arrays."""

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray) -> None:
        self.keys = np.zeros(1 << _SLOT_BITS, U64)
        self.lengths = np.zeros(1 << _SLOT_BITS, np.int32)
        self.probes = 0
        mask = (1 << _SLOT_BITS) - 1
        for key, length in zip(hashes.tolist(), lengths.tolist(), strict=True):
            slot, probes = key >> (64 - _SLOT_BITS), 1
            while self.keys[slot]:
                slot, probes = (slot + 1) & mask, probes + 1
            self.keys[slot], self.lengths[slot] = key, length
            self.probes = max(self.probes, probes)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The length of each, -1 where the table does not have it."""
        found = np.full(len(hashes), -1, np.int64)
        slot = (hashes >> U64(64 - _SLOT_BITS)).astype(np.int64)
        left = np.arange(len(hashes))
        for _ in range(self.probes):
            key = self.keys[slot[left]]
            hit = key == hashes[left]
            found[left[hit]] = self.lengths[slot[left[hit]]]
            left = left[~hit & (key != 0)]
            if not len(left):
                break
            slot[left] = (slot[left] + 1) & ((1 << _SLOT_BITS) - 1)
        return found


class Counter:
    """Finds pre-tokens and their lengths as the library does; one per worker and vocabulary."""

    def __init__(self, vocabulary: str) -> None:
        self._library = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        names = [re.escape(token.content.encode()) for token in self._library.get_added_tokens_decoder().values()]
        self._named = re.compile(b"|".join(names)) if names else None
        self._kinds = np.zeros(_ASKED, np.uint8)
        normal = [self._library.normalizer.normalize_str(chr(code)) for code in range(_PLAIN)]
        self._lower = np.array([ord(text) if len(text) == 1 else 0 for text in normal], np.uint32)
        self._plain = np.array([len(text) == 1 for text in normal])
        self._cache: dict[int, int] = {}

    def whole(self, text: str) -> int:
        return len(self._library.encode(text, add_special_tokens=False).ids)

    def _kind(self, codes: np.ndarray) -> np.ndarray:
        """What the vocabulary's pattern takes each code point for, asked of the library once per code point."""
        kinds = self._kinds[codes]
        if not kinds.all():
            new = np.unique(codes[kinds == _UNKNOWN])
            # After a letter, twice: a letter makes one piece of three, a space one of one, digits three, signs two.
            probe = "\n".join(f"a{chr(code)}{chr(code)}" for code in new.tolist())
            pieces = np.zeros(len(new), np.int64)
            reach = np.zeros(len(new), np.int64)
            for _, (begin, end) in self._library.pre_tokenizer.pre_tokenize_str(probe):
                pieces[begin // 4] += 1
                reach[begin // 4] = max(reach[begin // 4], end - begin // 4 * 4)
            one = np.where(reach == 1, _SPACE, _LETTER)
            self._kinds[new] = np.select([pieces == 1, pieces == 2], [one, _SIGN], _DIGIT)
            kinds = self._kinds[codes]
        return kinds

    def _normal(self, text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points of normalised texts, and the bounds of each; ``ends`` are in code points of ``text``."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        high = codes >= _PLAIN
        low = np.where(high, 0, codes)
        special = high | ~self._plain[low]
        if not special.any():
            return self._lower[low], ends
        count = np.concatenate([[0], np.cumsum(special)])[ends]
        parts = []
        for k in range(len(ends) - 1):
            piece = slice(ends[k], ends[k + 1])
            if count[k + 1] > count[k]:
                normal = self._library.normalizer.normalize_str(text[piece])
                parts.append(np.frombuffer(normal.encode("utf-32-le"), np.uint32))
            else:
                parts.append(self._lower[codes[piece]])
        bounds = np.concatenate([[0], np.cumsum([len(part) for part in parts])])
        return np.concatenate(parts), bounds

    def split(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code points of the normalised texts, starts and ends of their pre-tokens, and each text's first of them."""
        before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        codes, bounds = self._normal(data.tobytes().decode(), before[bounds])
        n = len(codes)
        if not n:
            return codes, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
        kind = self._kind(codes)
        edge = np.zeros(n + 1, bool)
        edge[bounds] = True
        begin = edge[:-1] | (kind == _DIGIT)
        begin[1:] |= kind[1:] != kind[:-1]
        # A quote that begins a piece and stands before s, t, m, d, re, ve or ll takes those letters.
        quotes = np.flatnonzero((codes == _QUOTE) & begin)
        if len(quotes):
            padded = np.concatenate([codes, np.zeros(2, codes.dtype)])
            room = bounds[np.searchsorted(bounds, quotes, "right")] - quotes
            one, two = padded[quotes + 1], padded[quotes + 2]
            short = np.isin(one, np.frombuffer(b"stmd", np.uint8)) & (room > 1)
            pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            for size, which in ((1, quotes[short]), (2, quotes[pair & ~short & (room > 2)])):
                begin[which + 1] = False
                after = which + size + 1
                begin[after[after < n]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], n)
        kept = kind[starts] != _SPACE
        first = np.concatenate([[0], np.cumsum(kept)])[np.searchsorted(starts, bounds)]
        return codes, starts[kept], ends[kept], first

    def lengths(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        counts = np.zeros(len(pieces), np.int64)
        begin = 0
        while begin < len(pieces):
            end, size = begin, 0
            while end < len(pieces) and size < _JOINED:
                size += len(pieces[end])
                end += 1
            # Between spaces a piece stays a piece, and the library says which one a token is of.
            words = self._library.encode(" ".join(pieces[begin:end]), add_special_tokens=False).word_ids
            counts[begin:end] = np.bincount(np.array(words, np.int64), minlength=end - begin)
            begin = end
        return counts

    def hashed(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        codes, starts, ends, first = self.split(data, bounds)
        hashes = span_hashes(mixed(codes.astype(U64) + U64(1)), starts, ends)
        hashes[hashes == 0] = 1  # an empty slot of the table is 0
        return codes, starts, ends, first, hashes

    def pieces(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
        text = codes.astype("<u4").tobytes().decode("utf-32-le")
        return [text[b:e] for b, e in zip(starts.tolist(), ends.tolist(), strict=True)]

    def counts(self, data: np.ndarray, bounds: np.ndarray, table: Table) -> np.ndarray:
        """Tokens of each text."""
        codes, starts, ends, first, hashes = self.hashed(data, bounds)
        found = table.find(hashes)
        missed = np.flatnonzero(found < 0)
        if len(missed):
            distinct, where, which = np.unique(hashes[missed], return_index=True, return_inverse=True)
            keys = distinct.tolist()
            known = [self._cache.get(key, -1) for key in keys]
            new = [k for k, length in enumerate(known) if length < 0]
            if new:
                at = missed[where[new]]
                if len(self._cache) + len(new) > _CACHED:
                    self._cache.clear()
                for k, length in zip(new, self.lengths(self.pieces(codes, starts[at], ends[at])).tolist(), strict=True):
                    known[k] = self._cache[keys[k]] = length
            found[missed] = np.array(known, np.int64)[which]
        total = np.concatenate([[0], np.cumsum(found)])
        result = np.diff(total[first])
        if self._named:
            raw = data.tobytes()
            hits = np.array([match.start() for match in self._named.finditer(raw)], np.int64)
            # Names of added tokens are found before anything else, so these texts are the library's as a whole.
            for k in np.unique(np.searchsorted(bounds, hits, "right") - 1):
                result[k] = self.whole(raw[bounds[k] : bounds[k + 1]].decode())
        return result


@lru_cache(4)
def counter(vocabulary: str) -> Counter:
    return Counter(vocabulary)


def parts(data: np.ndarray, bounds: np.ndarray, at_most: int = _PART_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts as they are, but one that is longer than ``at_most`` in parts that begin with white space.

    No pre-token and no name of an added token holds white space, and no character composes with it.
    """
    if len(bounds) != 2 or bounds[-1] <= at_most:
        yield data, bounds
        return
    begin, n = 0, len(data)
    while begin < n:
        end = begin + at_most
        while end < n:
            near = np.flatnonzero(WHITE[data[end : end + at_most]])
            if len(near):
                end += int(near[0])
                break
            end += at_most
        end = min(end, n)
        yield data[begin:end], np.array([0, end - begin])
        begin = end


def merged(summaries: Sequence[Summary], room: int) -> Summary:
    """One summary of heavy hitters: a count falls short of the true one by at most the total over ``room``."""
    hashes, at, which = np.unique(np.concatenate([s[0] for s in summaries]), return_index=True, return_inverse=True)
    counts = np.bincount(which, np.concatenate([s[1] for s in summaries]), len(hashes)).astype(np.int64)
    lengths = np.concatenate([s[2] for s in summaries])[at]
    if len(hashes) > room:
        counts -= np.partition(counts, len(counts) - room - 1)[len(counts) - room - 1]
        kept = counts > 0
        hashes, counts, lengths = hashes[kept], counts[kept], lengths[kept]
    return hashes, counts, lengths


def _row(summary: Summary) -> pa.RecordBatch:
    kinds = (np.uint64, np.int64, np.int64)
    blobs = [pa.array([part.astype(kind).tobytes()], pa.binary()) for part, kind in zip(summary, kinds, strict=True)]
    return pa.record_batch(blobs, names=["hashes", "counts", "lengths"])


def _summaries(batch: pa.RecordBatch) -> list[Summary]:
    return [
        (np.frombuffer(r["hashes"], U64), np.frombuffer(r["counts"], np.int64), np.frombuffer(r["lengths"], np.int64))
        for r in batch.to_pylist()
    ]


_EMPTY: Summary = (np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64))
_SUMMARY = "hashes binary, counts binary, lengths binary"


def frequent(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, room: int = FREQUENT) -> Table:
    """The table of pre-tokens that make up more than one in ``room`` of all, and of others as far as it has room."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = counter(vocabulary)
        held, known = _EMPTY, {}
        for _, data, bounds in slices(batches, "text", _PART_BYTES):
            for part, edges in parts(data, bounds):
                codes, starts, ends, _, hashes = library.hashed(part, edges)
                distinct, at, counts = np.unique(hashes, return_index=True, return_counts=True)
                new = [k for k, key in enumerate(distinct.tolist()) if key not in known]
                known.update(zip(distinct[new].tolist(), library.pieces(codes, starts[at[new]], ends[at[new]]), strict=True))
                held = merged([held, (distinct, counts, np.zeros(len(distinct), np.int64))], room)
                if len(known) > 4 * room:
                    known = {key: known[key] for key in held[0].tolist()}
        yield _row((held[0], held[1], library.lengths([known[key] for key in held[0].tolist()])))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _EMPTY
        for batch in batches:
            held = merged([held, *_summaries(batch)], room)
        yield _row(held)

    rows = store(docs.select(F.col(text).cast("string").alias("text")).mapInArrow(summary, _SUMMARY), "frequent")
    left = rows.count()
    while left > 1:
        left = -(-left // MERGED_AT_ONCE)
        rows = store(rows.repartition(left).mapInArrow(merge, _SUMMARY), "frequent")
    found = merged([_EMPTY, *_summaries(rows.toArrow())], room)  # one row
    return Table(found[0], found[2])


def counted(
    docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), vocabulary: str = VOCABULARY, table: Table | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``others`` (the columns ``keep``), n_bytes and n_tokens of the whole ``text``.

    A null text is empty: 0 bytes, 0 tokens. Names of added tokens in a text are one token each, the library's
    default. Rows with a null or repeated id are counted each on their own; an empty table gives no rows; columns that are
    not in ``keep`` play no part, whatever their names. A long text is counted in parts between white space.
    """
    table = table or frequent(docs, text, vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    others = F.struct(*[F.col(f"`{name}`") for name in keep]).alias("others")
    chosen = docs.select(others, F.col(text).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = counter(vocabulary)
        for rows, data, bounds in slices(batches, "text", _PART_BYTES):
            found = [library.counts(part, edges, shared.value) for part, edges in parts(data, bounds)]
            tokens = found[0] if len(bounds) > 2 or len(found) == 1 else np.array([sum(int(n[0]) for n in found)])
            yield pa.record_batch(
                [column(rows, "others"), pa.array(np.diff(bounds), pa.int64()), pa.array(tokens, pa.int64())],
                names=["others", "n_bytes", "n_tokens"],
            )

    fields = [chosen.schema["others"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    return chosen.mapInArrow(count, T.StructType(fields))
