"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its word shingles. In one order of all shingles, rare ones first, two sets that are similar
enough share at least ``l`` of their first ``n - needed + l`` shingles, for every ``l``. A longer prefix costs more
postings and asks for more matches before a pair is verified; each document takes the ``l`` with the smallest estimated
cost, and a pair is held to the smaller of its two.

The order comes from a count sketch of fixed size, so that it weighs the same whatever the corpus has; it only
decides how much work there is, never what links. Shingles of one prefix only go in their buckets. Of the rest,
every document is first compared with a hub among its postings, which joins large groups of near copies with one pair
per document; then all pairs that still lie in different components and match often enough are verified.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bodega.llm.arrays import (
    BYTE_VALUES,
    LOWER,
    U64,
    binary,
    column,
    gram_hashes,
    mixed,
    slices,
    span_hashes,
    words,
)
from bodega.llm.components import components
from bodega.llm.shared import bytes_of, discard, store, task_count

SHINGLE = 5
PERCENT = 75
MOST_MATCHES = 8
SKETCH = 1 << 22
HOT = 1 << 16
HUB_ROUNDS = 2
POSTINGS = 1 << 20
HELD = 1 << 18
NO_ID = -(1 << 63)
_BLOCKS = 64
_VERIFY_COST = 16
_SEEN = 1 << 18
_POSTING = np.dtype([("t", "<u8"), ("f", "<i8"), ("n", "<u4"), ("r", "<u4"), ("l", "u1"), ("hot", "u1"), ("p", "u1")])


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in lower case; fewer words than ``size`` are one shingle."""
    data = LOWER[data]
    starts, ends, first = words(data, bounds)
    hashes = span_hashes(BYTE_VALUES[data], starts, ends)
    grams = gram_hashes(hashes, size)
    found = []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if end - begin >= size:
            found.append(np.unique(grams[begin : end - size + 1]))
        else:
            found.append(gram_hashes(hashes[begin:end], end - begin) if end > begin else np.zeros(0, U64))
    return found


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _short(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _packed(shingles: np.ndarray) -> bytes:
    """The leading 48 bits of every hash: within one pair of sets that tells shingles apart."""
    return shingles.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _opened(packed: bytes) -> np.ndarray:
    rows = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return np.pad(rows, ((0, 0), (2, 0))).reshape(-1).view(">u8")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, x, n_shingles, f, digest) for every row; ``f`` is the start of the digest."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, "text"):
            sets = shingle_sets(data, bounds, size)
            digests = [_digest(s) for s in sets]
            yield pa.record_batch(
                {
                    "doc_id": column(rows, "doc_id"),
                    "x": column(rows, "x"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "f": pa.array([_short(d) for d in digests], pa.int64()),
                    "digest": binary(digests),
                }
            )

    return docs.mapInArrow(found, "doc_id long, x long, n_shingles long, f long, digest binary")


def _sketch(docs: DataFrame, size: int) -> np.ndarray:
    """How many documents have a shingle of each hash class: ``SKETCH`` counters, added up block by block."""
    step = SKETCH // _BLOCKS

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.uint32)
        for _, data, bounds in slices(batches, "text"):
            for shingles in shingle_sets(data, bounds, size):
                total[(shingles & U64(SKETCH - 1)).astype(np.int64)] += 1
        parts = [total[k * step : (k + 1) * step] for k in range(_BLOCKS)]
        press = pa.Codec("zstd")
        yield pa.record_batch(
            [pa.array(range(_BLOCKS), pa.int32()), binary([press.compress(p.tobytes(), asbytes=True) for p in parts])],
            names=["block", "counts"],
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = pa.Codec("zstd")
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True):
                part = np.frombuffer(press.decompress(counts, 4 * step, asbytes=True), np.uint32)
                old = totals.get(block, np.zeros(step, np.uint32))
                totals[block] = np.where(old + part < old, np.uint32(0xFFFFFFFF), old + part)
        if totals:
            yield pa.record_batch(
                [pa.array(list(totals), pa.int32()), binary([t.tobytes() for t in totals.values()])],
                names=["block", "counts"],
            )

    schema = "block int, counts binary"
    sums = docs.mapInArrow(counted, schema).repartition(_BLOCKS, "block").mapInArrow(added, schema)
    whole = np.zeros(SKETCH, np.uint32)
    for row in sums.collect():  # _BLOCKS rows, SKETCH counters in all
        whole[row["block"] * step : (row["block"] + 1) * step] = np.frombuffer(row["counts"], np.uint32)
    return whole


def prefix(shingles: np.ndarray, sketch: np.ndarray, percent: int) -> tuple[np.ndarray, int, np.ndarray]:
    """The adaptive prefix: its shingles in order, the matches asked for, and estimated counts."""
    n = len(shingles)
    needed = -(-percent * n // 100)
    counts = sketch[(shingles & U64(SKETCH - 1)).astype(np.int64)]
    order = np.argsort(counts, kind="stable")  # the shingles themselves are in order and break ties
    most = min(MOST_MATCHES, needed)
    length = n - needed + np.arange(1, most + 1)
    scanned = np.cumsum(counts[order].astype(np.float64))[length - 1]
    matches = int(np.argmin(scanned + _VERIFY_COST * scanned / np.arange(1, most + 1))) + 1
    kept = order[: n - needed + matches]
    return shingles[kept], matches, counts[kept]


def _postings(docs: DataFrame, size: int, percent: int, sketch: np.ndarray, buckets: int) -> DataFrame:
    """(t, f, n, r, l, p) of the prefix shingles that two or more sets have.

    ``r`` is the rank of the shingle in its set, ``l`` the matches asked for; ``p`` grows with how common a prefix is.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size_held, seen = [], 0, set()
        for _, data, bounds in slices(batches, "text"):
            for shingles in shingle_sets(data, bounds, size):
                digest = _digest(shingles)
                if not len(shingles) or digest in seen:
                    continue
                if len(seen) > _SEEN:
                    seen.clear()
                seen.add(digest)
                tokens, matches, counts = prefix(shingles, shared.value, percent)
                rows = np.empty(len(tokens), _POSTING)
                rows["t"], rows["f"], rows["n"] = tokens, _short(digest), len(shingles)
                rows["r"], rows["l"], rows["hot"] = np.arange(1, len(tokens) + 1), matches, counts >= HOT
                rows["p"] = min(255, int(12 * np.log2(1 + counts.mean())))
                held.append(rows)
                size_held += len(rows)
            if size_held >= HELD:
                yield dealt(np.concatenate(held))
                held, size_held = [], 0
        if held:
            yield dealt(np.concatenate(held))

    def dealt(rows: np.ndarray) -> pa.RecordBatch:
        # A shingle that very many sets have is spread by the set; its postings all stay.
        spread = np.where(rows["hot"] == 1, mixed(rows["f"].astype(U64)), U64(0))
        bucket = (mixed(rows["t"] + spread) % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        numbers, begin = np.unique(bucket[order], return_index=True)
        ends = np.append(begin[1:], len(rows))
        blobs = [rows[order[b:e]].tobytes() for b, e in zip(begin, ends, strict=True)]
        return pa.record_batch([pa.array(numbers, pa.int32()), binary(blobs)], names=["bucket", "rows"])

    def shared_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for bucket, blob in zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True):
                if bucket != last and held:
                    yield several(held)
                    held = []
                last = bucket
                held.append(np.frombuffer(blob, _POSTING))
        if held:
            yield several(held)

    def several(held: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(held)
        rows = rows[np.lexsort((rows["f"], rows["t"]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows["t"][1:] != rows["t"][:-1]) | (rows["f"][1:] != rows["f"][:-1])
        rows = rows[new]
        begin = np.flatnonzero(np.concatenate([[True], rows["t"][1:] != rows["t"][:-1]]))
        sizes = np.diff(np.append(begin, len(rows)))
        rows = rows[(np.repeat(sizes, sizes) > 1) | (rows["hot"] == 1)]
        return pa.record_batch(
            {
                "t": pa.array(rows["t"].copy().view("<i8")),
                "f": pa.array(rows["f"].copy()),
                "n": pa.array(rows["n"].astype(np.int64)),
                "r": pa.array(rows["r"].astype(np.int64)),
                "l": pa.array(rows["l"].astype(np.int32)),
                "p": pa.array(rows["p"].astype(np.int32)),
            }
        )

    dealt_rows = docs.mapInArrow(listed, "bucket int, rows binary").repartition(buckets, "bucket")
    return dealt_rows.sortWithinPartitions("bucket").mapInArrow(shared_ones, "t long, f long, n long, r long, l int, p int")


def _involved(docs: DataFrame, seats: DataFrame, size: int) -> DataFrame:
    """(f, node, shingles) of the sets in ``seats``, packed; a row is read again for the set whose seat it is."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for rows, data, bounds in slices(batches, "text"):
            sets = shingle_sets(data, bounds, size)
            own, nodes = [], column(rows, "node").to_pylist()
            for k, (node, digest) in enumerate(zip(nodes, column(rows, "digest").to_pylist(), strict=True)):
                if node not in seen and _digest(sets[k]) == digest:  # a task sends a set once
                    own.append(k)
                    seen.add(node)
            yield pa.record_batch(
                {
                    "f": column(rows, "f").take(pa.array(own, pa.int64())),
                    "node": column(rows, "node").take(pa.array(own, pa.int64())),
                    "shingles": binary([_packed(sets[k]) for k in own]),
                }
            )
            if len(seen) > _SEEN:
                seen.clear()

    return docs.join(seats, ["doc_id", "x"]).mapInArrow(packed, "f long, node long, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the nodes of those pairs (f, g) of sets whose similarity is high enough."""

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            one, two = column(batch, "one"), column(batch, "two")
            for k in range(batch.num_rows):
                s, t = _opened(one[k].as_buffer()), _opened(two[k].as_buffer())
                common = len(s) + len(t) - len(np.union1d(s, t))
                keep.append(100 * common >= percent * (len(s) + len(t) - common))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.record_batch([column(kept, "a"), column(kept, "b")], names=["a", "b"])

    ones = sets.select("f", F.col("node").alias("a"), F.col("shingles").alias("one"))
    twos = sets.select(F.col("f").alias("g"), F.col("node").alias("b"), F.col("shingles").alias("two"))
    both = pairs.join(ones, "f").join(twos, "g").select("a", "b", "one", "two")
    return both.mapInArrow(alike, "a long, b long")


def keyed(docs: DataFrame) -> list:
    """The columns (doc_id, x, text) that tell documents apart: the id, ``NO_ID`` for none, a hash of the text, the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return [key.alias("doc_id"), F.xxhash64(text).alias("x"), text.alias("text")]


def classes(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id reachable by links; two documents link when 100 * intersection >=
    ``percent`` * union of their sets. A null or empty text has no shingles and links with nothing. Rows never link by
    their id, whether it is null or repeated: a null id comes out null unless its own text links to a document with an
    id. Other columns are not looked at.
    """
    found, sets, _ = _grouped(docs, size, percent)
    result = found.join(sets, ["f", "digest"], "left")
    shown = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    own = F.when(F.col("n_shingles") == 0, shown)
    return result.select(shown.alias("doc_id"), "n_shingles", F.coalesce("least", own).alias("component_id"))


def representatives(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, x, wordless), as ``keyed`` has them: one document of each component, and every one without words."""
    found, _, named = _grouped(docs, size, percent)
    without = found.filter("n_shingles = 0").select("doc_id", "x", F.lit(True).alias("wordless")).distinct()
    return named.select("seat.doc_id", "seat.x", F.lit(False).alias("wordless")).union(without)


def _grouped(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with their sets, (f, digest, least) of each distinct set, and (component, least, seat) of each component.

    The nodes of the graph are the distinct sets. The seat of a set or component is its document with the smallest id.
    """
    rows = docs.select(*keyed(docs))
    found = store(_sets(rows, size), "sets")
    filled = found.filter("n_shingles > 0")
    known = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    seat = F.min(F.struct(known.isNull().alias("no_id"), "doc_id", "x")).alias("seat")
    distinct = filled.groupBy("f", "digest").agg(F.min(known).alias("least"), seat)
    distinct = store(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct_sets")
    buckets = task_count(docs.sparkSession, bytes_of(rows, "text") // 16, POSTINGS)
    postings = store(_postings(rows, size, percent, _sketch(rows, size), buckets), "postings")
    nodes = distinct.select("f", "digest", "node", "seat.doc_id", "seat.x")

    # Near copies of one document meet at a hub, the set with the most common prefix: it has what its copies share.
    # A set is compared with the one hub that shares most postings, in a few rounds over what is still apart.
    starred, placed = None, nodes.select("f", F.col("node").alias("c"))
    for turn in range(HUB_ROUNDS):
        listed = store(postings.select(*"tfnrlp").join(placed, "f"), "placed_postings")
        met = store(listed.join(_hubs(listed), "t"), "hub_postings")
        discard(postings, listed)
        postings = met  # a shingle whose sets are all in one component is through
        near = met.filter((F.col("f") != F.col("g")) & (F.col("c") != F.col("d")) & _fit(percent))
        votes = near.groupBy("f", "g").agg(F.count("*").alias("votes"), F.least(F.min("l"), F.min("k")).alias("asked"))
        best = votes.filter("votes >= asked").groupBy("f").agg(F.max(F.struct("votes", "g")).alias("best"))
        best = store(best.select("f", F.col("best.g").alias("g")), "hub_pairs")
        linked = _linked(rows, nodes, best, size, percent)
        starred = linked if starred is None else starred.union(linked)
        parts = store(components(starred), "hub_components")
        placed = nodes.join(parts, "node", "left").select("f", F.coalesce("component", "node").alias("c"))

    # What is left are pairs of different components.
    listed = store(postings.select(*"tfnrlp").join(placed, "f"), "placed_postings")
    ones = store(_open(listed, percent), "open_postings")
    others = ones.select("t", *[F.col(k).alias(o) for k, o in zip("fnrlcq", "gmskdu", strict=True)])
    apart = (F.col("f") < F.col("g")) & (F.col("c") != F.col("d"))
    matched = ones.join(others, "t").filter(apart & _fit(percent, F.least("q", "u")))
    matched = matched.groupBy("f", "g").agg(F.count("*").alias("matches"), F.least(F.min("l"), F.min("k")).alias("asked"))
    pairs = store(matched.filter("matches >= asked").select("f", "g"), "pairs")
    discard(postings, listed, ones)
    rest = _linked(rows, nodes, pairs, size, percent)

    whole = components(starred.union(rest))
    placed = distinct.join(whole, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = placed.groupBy("component").agg(F.min("least").alias("least"), F.min("seat").alias("seat"))
    named = store(named, "components")
    sets = placed.select("f", "digest", "component").join(named.select("component", "least"), "component")
    return found, store(sets.select("f", "digest", "least"), "named_sets"), named


def _hubs(listed: DataFrame) -> DataFrame:
    """The hub of each shingle that sets of different components have."""
    hub = F.max(F.struct("p", F.xxhash64("f").alias("h"), *"fnrlc")).alias("hub")
    hubs = listed.groupBy("t").agg(hub, F.min("c").alias("low"), F.max("c").alias("high")).filter("low != high")
    return hubs.select("t", *[F.col(f"hub.{k}").alias(o) for k, o in zip("fnrlc", "gmskd", strict=True)])


def _open(listed: DataFrame, percent: int) -> DataFrame:
    """The postings whose shingle stands in sets of different components.

    ``q`` tells how many of a set's open shingles come up to this one. What two sets share up to a shingle that both have
    listed, both have listed, so that is at most the smaller ``q``. ``l`` is chosen anew, never larger, from the true
    lengths of the lists that are still open: sets met ``l`` times are at most the ``l``-th part of all postings, and where
    near copies are left, whose lists hold much the same sets, about as many as the longest list has.
    """
    spans = F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("sets")
    wide = listed.groupBy("t").agg(*spans).filter("low != high").select("t", "sets")
    own = Window.partitionBy("f")
    spare = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100))
    costs = []
    for matches in range(1, MOST_MATCHES + 1):
        within = F.when(F.col("r") <= spare + matches, F.col("sets")).otherwise(0)
        scanned, longest = F.sum(within).over(own), F.max(within).over(own)
        cost = scanned + _VERIFY_COST * F.least(scanned / matches, longest)
        cost = F.struct(cost.alias("cost"), F.lit(matches).alias("matches"))
        costs.append(F.when(F.col("l") >= matches, cost))
    return listed.join(wide, "t").select(
        *"tfnrc", F.row_number().over(own.orderBy("r")).alias("q"), F.array_min(F.array(*costs))["matches"].alias("l")
    )


def _fit(percent: int, before=None):
    """Whether a shared shingle leaves two sets similar enough by size and rank, and is one of the first they share.

    Similar sets share at least ``overlap``. The first shared shingles, as many as asked for, so stand within the first
    ``n - overlap + asked`` and ``m - overlap + asked``; the prefixes are at least that long. ``before`` bounds what they
    share up to this shingle, itself included, by default the smaller rank; after it there is what the shorter rest has.
    """
    n, m, r, s = (F.col(name) for name in "nmrs")
    before = F.least("r", "s") if before is None else before
    overlap = F.ceil((n + m) * percent / F.lit(100 + percent))
    place = F.least("l", "k", before)
    sizes = (100 * F.least(n, m)) >= (percent * F.greatest(n, m))
    first = (r <= n - overlap + place) & (s <= m - overlap + place)
    return sizes & first & (before + F.least(n - r, m - s) >= overlap)


def _linked(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The verified ones of ``pairs`` as links of nodes; only texts in a pair are read again."""
    seats = nodes.join(pairs.select("f").union(pairs.select("g")).distinct(), "f")
    sets = store(_involved(docs, seats, size), "involved_sets")
    links = store(_verified(pairs, sets, percent), "verified")
    discard(sets, pairs)
    return links
