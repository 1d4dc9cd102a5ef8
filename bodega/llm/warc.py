"""WARC archives of pages with a two-level capture index.

Records are gzip members, one per page; equal payloads of at least ``REVISIT_BYTES`` are stored once and revisited
after that. The index sorts captures by reversed-host URL key into compressed blocks; each index part has a
sparse directory of its blocks' first keys, and the parts' own first keys are the level above. A lookup searches the
parts, then one directory, and reads one block and the records it names.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.llm.arrays import column
from bodega.llm.shared import bytes_of, open_input, published, store, task_count, task_number

REVISIT_BYTES = 100
BLOCK_LINES = 1000
PART_BYTES = 256 << 20
_STAMP = "2024-01-01T00:00:00Z"
_CAPTURE = "key string, page_id {t}, url string, file string, at long, size long"
_RECORD = (
    "page_id {t}, url string, payload_bytes long, payload_digest string, record_type string, refers_to {t}, "
    "html string"
)


def url_key(url: Column) -> Column:
    """Reversed host, then path and query, lower case: ``http://www.A.org/B?c`` gives ``org,a)/b?c``; null as empty."""
    plain = F.lower(F.coalesce(url, F.lit("")))
    plain = F.regexp_replace(F.regexp_replace(plain, "#.*$", ""), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_extract(plain, r"^[^/?]*", 0), r"^.*@|^www\d*\.|:\d+$", "")
    rest = F.regexp_replace(plain, r"^[^/?]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def _record(kind: str, page: str, url: str, digest: str, size: int, refers: str | None, payload: bytes) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    body = payload if kind == "revisit" else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Target-URI: {url}",
        f"WARC-Date: {_STAMP}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {size}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if refers is not None:
        head.insert(4, f"WARC-Refers-To: <urn:page:{refers}>")
        head.insert(4, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    text = "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    return squeeze.compress(text) + squeeze.flush()


def parsed(raw: bytes) -> dict:
    """A record read back; the payload of a response is checked against its digest."""
    text = zlib.decompress(raw, 31)
    head, _, rest = text.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    payload = None
    if kind == "response":
        payload = body.partition(b"\r\n\r\n")[2]
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def page(name: str) -> int | None:
        found = re.search(r"page:(-?\d+)>", fields.get(name, ""))
        return int(found[1]) if found else None

    return {
        "page_id": page("WARC-Record-ID"),
        "url": json.loads(fields["WARC-Target-URI"]),
        "payload_bytes": int(fields["X-Payload-Length"]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page("WARC-Refers-To"),
        "html": None if payload is None else payload.decode(),
    }


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) under ``folder``; gives the index parts.

    Of rows with equal payloads of at least ``REVISIT_BYTES``, those with the smallest id are responses and the rest
    revisits. A null payload is empty; a null id is a revisit where an equal payload has a row with an id, and else a
    response; repeated rows are written each. Other columns are not looked at; an empty table gives no parts.
    """
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
        url_key(F.col("url").cast("string")).alias("key"),
    ).withColumns({"digest": F.sha2("html", 256), "size": F.octet_length("html").cast("long")})
    firsts = rows.filter(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"))
    volume = bytes_of(pages, "html")
    tasks = task_count(pages.sparkSession, volume, PART_BYTES)
    # The payload goes to the join only where it has to be written; the salt spreads a payload that many pages have.
    small = rows.join(firsts, "digest", "left")
    revisits = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    typed = small.select(
        "page_id", "url", "key", "digest", "size",
        F.when(revisits, F.col("first")).alias("refers"),
        F.when(~revisits, F.col("html")).alias("payload"),
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, at = f"{folder}/pages-{task_number():06d}.warc.gz", 0
        with published(name) as out:
            for batch in batches:
                lines = []
                for row in batch.to_pylist():
                    kind = "response" if row["refers"] is None else "revisit"
                    page = "none" if row["page_id"] is None else row["page_id"]
                    refers = None if row["refers"] is None else str(row["refers"])
                    payload = (row["payload"] or "").encode()
                    raw = _record(kind, str(page), json.dumps(row["url"]), row["digest"], row["size"], refers, payload)
                    out.write(raw)
                    lines.append((row["key"], row["page_id"], row["url"], name, at, len(raw)))
                    at += len(raw)
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*lines, strict=True), kinds, strict=True)], names=names)

    names = ["key", "page_id", "url", "file", "at", "size"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    captures = store(typed.mapInArrow(records, _CAPTURE.format(t="long")), "captures")
    return _index(captures, folder, tasks)


def _index(captures: DataFrame, folder: str, parts: int) -> DataFrame:
    """Sort the captures by key into parts of compressed blocks, each part with its sparse directory."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, at, held, directory = f"{folder}/index-{task_number():06d}", 0, [], []
        last = ""
        with published(f"{name}.cdx.z") as out:

            def flush() -> None:
                nonlocal at
                raw = zlib.compress("\n".join(json.dumps(line) for line in held).encode())
                out.write(raw)
                directory.append((held[0][0], at, len(raw)))
                at += len(raw)
                held.clear()

            for batch in batches:
                for row in batch.to_pylist():
                    held.append([row["key"], row["file"], row["at"], row["size"]])
                    last = row["key"]
                    if len(held) == BLOCK_LINES:
                        flush()
            if held:
                flush()
        with published(f"{name}.directory.z") as out:
            out.write(zlib.compress(json.dumps(directory).encode()))
        if directory:
            yield pa.record_batch({"part": [name], "first_key": [directory[0][0]], "last_key": [last], "blocks": [len(directory)]}, schema=kind)

    kind = pa.schema([("part", pa.string()), ("first_key", pa.string()), ("last_key", pa.string()), ("blocks", pa.int32())])
    ordered = captures.repartitionByRange(parts, "key", "page_id", "file", "at").sortWithinPartitions("key", "page_id", "file", "at")
    return store(ordered.mapInArrow(blocks, "part string, first_key string, last_key string, blocks int"), "index_parts")


@lru_cache(16)
def _directory(part: str) -> list[list]:
    with open_input(f"{part}.directory.z") as file:
        return json.loads(zlib.decompress(file.read()))


def _block(part: str, at: int, size: int) -> list[list]:
    with open_input(f"{part}.cdx.z") as file:
        file.seek(at)
        return [json.loads(line) for line in zlib.decompress(file.read(size)).split(b"\n")]


class _Files:
    """Archive files kept open while a task reads ranges of them."""

    def __init__(self, at_most: int = 64) -> None:
        self._open = lru_cache(at_most)(open_input)

    def read(self, name: str, at: int, size: int) -> bytes:
        file = self._open(name)
        file.seek(at)
        return file.read(size)


def _rows(found: list[dict]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]
    return pa.record_batch([pa.array([r[n] for r in found], t) for n, t in zip(names, kinds, strict=True)], names=names)


def read(parts: DataFrame) -> DataFrame:
    """Every record, read back through the index: directory, block, then the range of each record."""

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files()
        for batch in batches:
            for part, number in zip(column(batch, "part").to_pylist(), column(batch, "number").to_pylist(), strict=True):
                _, at, size = _directory(part)[number]
                lines = _block(part, at, size)
                for begin in range(0, len(lines), 200):
                    yield _rows([parsed(files.read(*line[1:])) for line in lines[begin : begin + 200]])

    each = parts.select("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("number"))
    tasks = max(1, parts.sparkSession.sparkContext.defaultParallelism)
    return each.repartition(tasks, "part", "number").mapInArrow(back, _RECORD.format(t="long"))


def lookup(parts: DataFrame, urls: DataFrame) -> DataFrame:
    """The records of the given URLs (column ``url``): search the parts, then a directory, read one block at a time.

    The level above the directories has one line per index part, as many as the index was written with tasks.
    """
    level = sorted(tuple(row) for row in parts.select("first_key", "last_key", "part").collect())
    firsts = [first for first, _, _ in level]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files()
        for batch in batches:
            for key in column(batch, "key").to_pylist():
                number = max(0, bisect.bisect_left(firsts, key) - 1)
                while number < len(level) and level[number][0] <= key:
                    if level[number][1] >= key:
                        yield from _in_part(level[number][2], key, files)
                    number += 1

    keys = urls.select(url_key(F.col("url").cast("string")).alias("key")).distinct()
    return keys.mapInArrow(found, _RECORD.format(t="long"))


def _in_part(part: str, key: str, files: _Files) -> Iterator[pa.RecordBatch]:
    directory = _directory(part)
    number = max(0, bisect.bisect_left(directory, key, key=lambda entry: entry[0]) - 1)
    while number < len(directory) and directory[number][0] <= key:
        lines = _block(part, *directory[number][1:])
        begin = bisect.bisect_left(lines, key, key=lambda line: line[0])
        hits = [line for line in lines[begin:] if line[0] == key]
        if hits:
            yield _rows([parsed(files.read(*line[1:])) for line in hits])
        number += 1
