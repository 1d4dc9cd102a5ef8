"""Byte-level BPE ids of whole texts, computed once per distinct piece.

Pieces are what the vocabulary's pattern cuts a text into: contractions, letters, digits and other signs with one
leading space, and white space. They are found for a whole slice of texts at once with array operations; every piece
that a task has not met before is encoded by the library and kept. Names of added tokens part a text before anything else
and have their own id. Ids equal those of the ``tokenizers`` file of the same vocabulary (``add_special_tokens=False``).
"""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
import tiktoken

from bodega.llm.arrays import U64, mixed, ranges, span_hashes

VOCABULARY = "byte_bpe_50k"
END = 0
_KEEP_PIECES = 1 << 20
_LETTER, _DIGIT, _SPACE, _SIGN = 1, 2, 3, 4
_BLANK, _QUOTE = 32, 39


@lru_cache(1)
def _kinds() -> np.ndarray:
    """The kind of every code point."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    kinds = np.full(0x110000, _SIGN, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_DIGIT, r"\p{N}+"), (_SPACE, r"\s+")):
        for match in regex.finditer(pattern, every):
            begin, end = ord(match[0][0]), ord(match[0][-1])
            kinds[begin : end + 1] = kind
    return kinds


def piece_starts(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces of the texts in ``codes`` (code points, texts cut at ``bounds``) begin."""
    n = len(codes)
    kind = _kinds()[codes]
    begin = np.ones(n, bool)
    begin[1:] = kind[1:] != kind[:-1]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    begin |= edge[:-1]
    space = kind == _SPACE
    # The last of a run of spaces before something else stands apart; if it is a blank, it goes with what follows.
    apart = np.zeros(n, bool)
    apart[:-1] = space[:-1] & ~space[1:] & ~edge[1:-1]
    begin |= apart
    joined = apart & (codes == _BLANK)
    begin[1:] &= ~joined[:-1]
    # A quote that begins a piece and stands before s, t, m, d, re, ve or ll takes those letters.
    quotes = np.flatnonzero((codes == _QUOTE) & begin)
    if len(quotes):
        padded = np.concatenate([codes, np.zeros(2, codes.dtype)])
        text_end = bounds[np.searchsorted(bounds, quotes, "right")]
        one, two = padded[quotes + 1], padded[quotes + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8)) & (quotes + 1 < text_end)
        pairs = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        long = pairs & (quotes + 2 < text_end) & ~short
        for length, which in ((1, quotes[short]), (2, quotes[long])):
            for step in range(1, length + 1):
                begin[which + step] = False
            after = which + length + 1
            begin[after[after < n]] = True
    return np.flatnonzero(begin)


class Encoder:
    """Encodes slices of texts and remembers the pieces it has met, ``_KEEP_PIECES`` of them at most."""

    def __init__(self) -> None:
        with open(public_tokenizers.path(f"{VOCABULARY}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._library = tiktoken.Encoding(
            VOCABULARY, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._width = np.zeros(len(ranks) + 1, np.int64)
        for token, rank in ranks.items():
            self._width[rank] = len(token)
        with open(public_tokenizers.path(f"{VOCABULARY}.json"), "rb") as file:
            added = json.load(file)["added_tokens"]
        self._added = {token["content"]: token["id"] for token in added}
        self._name = re.compile(b"|".join(re.escape(name.encode()) for name in self._added)) if added else None
        self._forget()

    def _forget(self) -> None:
        self._known = np.zeros(0, U64)
        self._at = np.zeros(0, np.int64)
        self._count = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint16)

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, end to end, and the number of each."""
        # Pieces with a leading blank fall apart again at the same places when put end to end.
        chained = np.array([len(p) > 1 and p[0] == " " and not p[1].isspace() for p in pieces], bool)
        counts = np.zeros(len(pieces), np.int64)
        found: list = [None] * len(pieces)
        chain = [p for p, c in zip(pieces, chained, strict=True) if c]
        ids = np.array(self._library.encode_ordinary("".join(chain)), np.uint16)
        ends = np.cumsum([len(p.encode()) for p in chain])
        cuts = np.searchsorted(np.cumsum(self._width[ids]), ends) + 1
        counts[chained] = np.diff(np.concatenate([[0], cuts])) if len(chain) else 0
        for k in np.flatnonzero(~chained):
            own = self._added.get(pieces[k])
            found[k] = self._library.encode_ordinary(pieces[k]) if own is None else [own]
            counts[k] = len(found[k])
        all_ids = np.zeros(int(counts.sum()), np.uint16)
        at = np.cumsum(counts) - counts
        all_ids[ranges(at[chained], counts[chained])] = ids
        for k in np.flatnonzero(~chained):
            all_ids[at[k] : at[k] + counts[k]] = found[k]
        return all_ids, counts

    def _names(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Begin and end of every name of an added token."""
        found = [match.span() for match in self._name.finditer(data.tobytes())] if self._name else []
        spans = np.array(found, np.int64).reshape(-1, 2)
        text = np.searchsorted(bounds, spans, "right")
        return spans[text[:, 0] == np.searchsorted(bounds, spans[:, 1], "left")]

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end to end and without end marks, and the bounds of each text."""
        if not len(data):
            return np.zeros(0, np.uint16), np.zeros(len(bounds), np.int64)
        text = data.tobytes().decode()
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        before = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=before[1:])
        names = self._names(data, bounds)
        parted = before[np.unique(np.concatenate([bounds, names.ravel()]))]
        bounds = before[bounds]
        starts = piece_starts(codes, parted)
        if len(names):
            begin, end = before[names.T]
            inside = np.searchsorted(begin, starts, "left") > np.searchsorted(end, starts, "right")
            starts = starts[~inside]
        ends = np.append(starts[1:], len(codes))
        hashes = span_hashes(mixed(codes.astype(U64) + U64(1)), starts, ends)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        slot = np.searchsorted(self._known, distinct)
        known = slot < len(self._known)
        known[known] = self._known[slot[known]] == distinct[known]
        new = np.flatnonzero(~known)
        if len(new):
            if len(self._known) + len(new) > _KEEP_PIECES:
                self._forget()
                new = np.arange(len(distinct))
            pieces = [text[b:e] for b, e in zip(starts[first[new]], ends[first[new]], strict=True)]
            ids, counts = self._encode(pieces)
            at = len(self._ids) + np.cumsum(counts) - counts
            keys = np.concatenate([self._known, distinct[new]])
            order = np.argsort(keys, kind="stable")
            self._known = keys[order]
            self._at = np.concatenate([self._at, at])[order]
            self._count = np.concatenate([self._count, counts])[order]
            self._ids = np.concatenate([self._ids, ids])
        slot = np.searchsorted(self._known, distinct)
        counts = self._count[slot][which]
        token_bounds = np.concatenate([[0], np.cumsum(counts)])
        ids = self._ids[ranges(self._at[slot][which], counts)]
        return ids, token_bounds[np.searchsorted(starts, bounds)]


@lru_cache(1)
def encoder() -> Encoder:
    """One encoder per worker process."""
    return Encoder()


def with_ends(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with an end mark after each text."""
    n = len(bounds) - 1
    marked = np.full(len(ids) + n, END, ids.dtype)
    new_bounds = bounds + np.arange(n + 1)
    marked[ranges(new_bounds[:-1], np.diff(bounds))] = ids
    return marked, new_bounds
