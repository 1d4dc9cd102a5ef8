"""Embedding near-dedup by collision counting on one-dimensional projections.

Vectors are projected on many random lines. A window around a query on one line holds its near neighbours with a known
probability, so near pairs collide on almost every line and far ones on few: a pair is verified when it collides on
as many lines as nearly all pairs at the threshold do. Pairs meet where some lines agree at once: each line of a table is
sorted into windows, vectors in the same windows of all lines of a table share a cell, and there are enough tables that a
pair at the threshold shares a cell of one with probability ``RECALL``. A pair counts in the first table only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.llm.arrays import U64, binary, column, mixed, ranges
from bodega.llm.components import components
from bodega.llm.shared import store, task_count

COSINE = 0.95
RECALL = 0.995
LINES = 64
WINDOW = 2.0
BLOCK = 1024
_MISS = 1e-4
_FAR = math.sqrt(2)
_PAIRS = 1 << 16
_CELL_ROWS = 1 << 16
_NORMAL = NormalDist()


def _same_window(distance: float) -> float:
    """The probability that points at this distance fall in one window of a line with a random offset."""
    x = WINDOW / distance
    return 1 - 2 * _NORMAL.cdf(-x) - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


class Projections:
    """Lines, windows and thresholds for vectors of one width, from a fixed seed."""

    def __init__(self, width: int, rows: int, cosine: float) -> None:
        near = math.sqrt(2 - 2 * cosine)
        self.per_table = max(2, math.ceil(math.log(max(rows, 8) / 8) / -math.log(_same_window(_FAR))))
        shared = _same_window(near) ** self.per_table
        self.tables = math.ceil(math.log(1 - RECALL) / math.log(1 - shared))
        random = np.random.default_rng(width)
        self.cells = random.standard_normal((width, self.tables * self.per_table))
        self.offsets = random.uniform(0, WINDOW, self.tables * self.per_table)
        self.lines = random.standard_normal((width, LINES)).astype(np.float32)
        collide = 0.95
        self.reach = _NORMAL.inv_cdf((1 + collide) / 2) * near
        below, self.needed = 0.0, 0
        while self.needed <= LINES:
            below += math.comb(LINES, self.needed) * collide**self.needed * (1 - collide) ** (LINES - self.needed)
            if below > _MISS:
                break
            self.needed += 1
        self.cosine = cosine

    def cell_numbers(self, unit: np.ndarray) -> np.ndarray:
        """The cell of every vector in every table."""
        windows = np.floor((unit @ self.cells + self.offsets) / WINDOW).astype(np.int64).view(U64)
        windows = windows.reshape(len(unit), self.tables, self.per_table)
        total = np.arange(1, self.tables + 1, dtype=U64)[None, :].repeat(len(unit), 0)
        for k in range(self.per_table):
            total = mixed(total) + windows[:, :, k]
        return mixed(total)

    def near(self, unit: np.ndarray, projected: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs collide on enough lines and are near enough in double precision."""
        hits = (np.abs(projected[a] - projected[b]) <= self.reach).sum(axis=1) >= self.needed
        hits[hits] = np.einsum("ij,ij->i", unit[a[hits]], unit[b[hits]]) >= self.cosine
        return hits


def _units(raw: np.ndarray) -> np.ndarray:
    wide = raw.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)  # no overflow in the squares
    return wide / np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]


def _vectors(table: DataFrame, kind: str) -> DataFrame:
    """(vec_id, width, digest, raw) of every row; digest and raw are null where a vector can't link."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = column(batch, "embedding")
            flat = lists.flatten()
            values = flat.to_numpy(zero_copy_only=False).astype(kind) + np.array(0, kind)  # no negative zero
            sizes = np.nan_to_num(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)).astype(np.int64)
            ends = np.cumsum(sizes)
            good = np.isfinite(values) & pc.is_valid(flat).to_numpy(zero_copy_only=False)
            raws = []
            for end, size in zip(ends, sizes, strict=True):
                own = values[end - size : end]
                usable = size and good[end - size : end].all() and own.any()
                raws.append(own.tobytes() if usable else None)
            digests = [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raws]
            yield pa.record_batch(
                [column(batch, "vec_id"), pa.array(sizes, pa.int32()), binary(digests), binary(raws)],
                names=["vec_id", "width", "digest", "raw"],
            )

    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.mapInArrow(parsed, "vec_id long, width int, digest binary, raw binary")


def _links(distinct: DataFrame, width: int, rows: int, cosine: float, kind: str) -> DataFrame:
    """(node, links, root): for nodes with links found in a task, their number and a node they are connected to."""
    plan = Projections(width, rows, cosine)
    spark = distinct.sparkSession
    shared = spark.sparkContext.broadcast(plan)

    def in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                raw = np.frombuffer(b"".join(column(part, "raw").to_pylist()), kind).reshape(-1, width)
                cells = shared.value.cell_numbers(_units(raw))
                rows_of = pa.array(np.repeat(np.arange(len(raw)), plan.tables))
                yield pa.record_batch(
                    {
                        "cell": pa.array(cells.reshape(-1).view(np.int64)),
                        "t": pa.array(np.tile(np.arange(plan.tables), len(raw)), pa.int32()),
                        "node": column(part, "node").take(rows_of),
                        "n": column(part, "n").take(rows_of),
                        "raw": column(part, "raw").take(rows_of),
                    }
                )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            begin = 0
            while begin < batch.num_rows:
                part = batch.slice(begin, _CELL_ROWS - size if size < _CELL_ROWS else batch.num_rows)
                marks = list(zip(*(column(part, n).to_pylist() for n in ("cell", "i", "j")), strict=True))
                if size >= _CELL_ROWS:
                    same = next((k for k, m in enumerate(marks) if m != last), len(marks))
                    held.append(part.slice(0, same))
                    size += same
                    begin += same
                    if same < len(marks):
                        yield from solved(held)
                        held, size = [], 0
                    continue
                held.append(part)
                size += part.num_rows
                begin += part.num_rows
                last = marks[-1]
        if held:
            yield from solved(held)

    def solved(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        cell, i, j, block, t, node, n = (
            table.column(name).to_numpy() for name in ("cell", "i", "j", "block", "t", "node", "n")
        )
        new = np.ones(len(cell), bool)
        new[1:] = (cell[1:] != cell[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        first = np.flatnonzero(new)
        group_end = np.repeat(np.append(first[1:], len(cell)), np.diff(np.append(first, len(cell))))
        # Inside one block every later row is a partner; between two, the rows of the second block are.
        change = np.zeros(len(cell), np.int64)
        second = block != i
        np.add.at(change, np.searchsorted(first, np.flatnonzero(~second), "right") - 1, 1)
        second_begin = first[np.searchsorted(first, np.arange(len(cell)), "right") - 1]
        second_begin = second_begin + change[np.searchsorted(first, np.arange(len(cell)), "right") - 1]
        begin = np.where(i == j, np.arange(len(cell)) + 1, np.where(second, group_end, second_begin))
        partners = group_end - begin
        rows_in = np.flatnonzero(partners > 0)
        if not len(rows_in):
            return
        raw = np.frombuffer(b"".join(table.column("raw").to_pylist()), kind).reshape(-1, width)
        distinct_node, where, which = np.unique(node, return_index=True, return_inverse=True)
        unit = _units(raw[where])
        projected = unit.astype(np.float32) @ plan.lines
        cells = plan.cell_numbers(unit)
        links = np.zeros(len(distinct_node), np.int64)
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        cuts = np.cumsum(partners[rows_in])
        at = 0
        while at < len(rows_in):
            upto = max(at + 1, int(np.searchsorted(cuts, (cuts[at - 1] if at else 0) + _PAIRS, "right")))
            some = rows_in[at:upto]
            at = upto
            a = np.repeat(some, partners[some])
            b = ranges(begin[some], partners[some])
            na, nb, table_of = which[a], which[b], t[a]
            good = plan.near(unit, projected, na, nb)
            na, nb, table_of, a, b = na[good], nb[good], table_of[good], a[good], b[good]
            earlier = (cells[na] == cells[nb]) & (np.arange(plan.tables)[None, :] < table_of[:, None])
            fresh = ~earlier.any(axis=1)
            np.add.at(links, na[fresh], n[b[fresh]])
            np.add.at(links, nb[fresh], n[a[fresh]])
            pairs.append((na[fresh], nb[fresh]))
        a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
        if not len(a):
            return
        root = np.arange(len(distinct_node))
        while True:
            low = root.copy()
            np.minimum.at(low, a, root[b])
            np.minimum.at(low, b, root[a])
            low = np.minimum(low, low[low])
            if (low == root).all():
                break
            root = low
        linked = np.unique(np.concatenate([a, b]))
        yield pa.record_batch(
            [pa.array(distinct_node[linked]), pa.array(links[linked]), pa.array(distinct_node[root[linked]])],
            names=["node", "links", "root"],
        )

    celled = distinct.mapInArrow(in_cells, "cell long, t int, node long, n long, raw binary")
    sizes = celled.groupBy("cell").agg(F.count("*").alias("size")).filter("size > 1")
    sizes = sizes.select("cell", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    placed = celled.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # A cell with many vectors is dealt out as pairs of blocks: each task has two blocks, no task has the cell.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = placed.withColumn("other", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    tasks = task_count(spark, rows * plan.tables, _CELL_ROWS)
    dealt = dealt.drop("other", "blocks").repartition(tasks, "cell", "i", "j").sortWithinPartitions("cell", "i", "j", "block")
    return dealt.mapInArrow(found, "node long, links long, root long")


def near_duplicates(table: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``table`` (vec_id, embedding).

    Vectors link at a cosine of ``cosine`` or more in double precision. Equal vectors are one class, compared once; its
    members link with each other. A vector that is null, empty, zero or has null or non-finite components links with
    nothing, and neither do vectors of different lengths. Rows never link by their id, whether it is null or repeated.
    ``component_id`` is the smallest id of a component, null where no row has one. One row of each component is
    kept, one with that id.
    """
    kind = "<f8" if "double" in table.schema["embedding"].dataType.simpleString() else "<f4"
    rows = store(_vectors(table, kind).withColumn("row", F.monotonically_increasing_id()), "vectors")
    usable = rows.filter("digest IS NOT NULL")
    first = F.min(F.struct(F.col("vec_id").isNull().alias("no_id"), "vec_id", "row")).alias("first")
    distinct = usable.groupBy("digest", "width", "raw").agg(first, F.count("*").alias("n"))
    distinct = store(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct_vectors")
    found = None
    for width, number in distinct.groupBy("width").agg(F.count("*")).collect():
        own = _links(distinct.filter(F.col("width") == width), width, number, cosine, kind)
        found = own if found is None else found.union(own)
    if found is None:
        found = table.sparkSession.createDataFrame([], "node long, links long, root long")
    found = store(found, "vector_links")
    degrees = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    classes = distinct.join(degrees, "node", "left").join(parts, "node", "left").select(
        "digest", "first", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component"),
    )
    named = store(classes.groupBy("component").agg(F.min("first").alias("kept")), "vector_components")
    classes = store(classes.drop("first").join(named, "component").drop("component"), "vector_classes")
    joined = rows.select("vec_id", "digest", "row").join(classes, "digest", "left")
    alone = F.col("digest").isNull()
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("kept.vec_id")).alias("component_id"),
        (alone | F.coalesce(F.col("row") == F.col("kept.row"), F.lit(False))).alias("kept"),
    )
