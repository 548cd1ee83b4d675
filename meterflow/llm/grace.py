"""Exact deduplication by Grace hashing: texts equal after lower-casing A-Z, compared in full.

Two passes of the same open-addressing table (linear probing on the first eight bytes of the content's
SHA-256; a slot's content is compared byte by byte).

1. Next to the texts. Every partition meets its own copies first. A table that would pass `budget`
   bytes of content is closed and a new one begun, so memory is bounded; a partition may then have
   several classes of one content. Every row becomes a member of a class, and of a class one copy of
   the content goes on with its number of rows and the row that stays. So a content that a third of
   all rows share crosses the network once per table, not once per row.
2. Classes are dealt out by digest and met by Grace hashing. A task fills a table; when it passes
   `budget`, what it holds and what is still to come is partitioned by the digest's next four bits
   into 16 spill files, each of which is handled in the same way, with the next four bits, until it
   fits. Copies are merged before they are spilled. A content larger than the budget ends up alone in
   a file and is handled on its own. Spill files belong to the task: they are in its temporary folder,
   are read by nobody else, and go when the bucket is done or the task ends in whatever way.

Members then find their class's result by (partition, class), pairs of which no partition has more
than its rows. What pass 1 found is written once, so a lost executor repeats single tasks.

Defined cases: null texts count as empty, and are copies of empty ones. Null ids are smaller than all
others. Of rows with one content and one id one row stays, each row counting in the group's size. A
table without rows gives none. Texts of any length are compared in full. Other columns are not read,
so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain
from pathlib import Path

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from meterflow.llm.text import buffers
from meterflow.plans.stage import staged

#: Bytes of distinct contents that a table holds, and what a content counts besides its bytes.
BUDGET, ENTRY = 64 << 20, 200
FILES = 16


class Class:
    """Rows of one content: how many, which stays (a key that orders rows), and where they were met."""

    __slots__ = ("digest", "content", "n", "top", "parts", "numbers")

    def __init__(self, digest: bytes, content: bytes, n: int, top: tuple, parts: array, numbers: array):
        self.digest, self.content, self.n, self.top, self.parts, self.numbers = digest, content, n, top, parts, numbers

    def take(self, other: Class) -> None:
        self.n += other.n
        self.top = max(self.top, other.top)
        self.parts.extend(other.parts)
        self.numbers.extend(other.numbers)


class ContentTable:
    """An open-addressing hash table of distinct contents."""

    def __init__(self):
        self.slots, self.mask = array("q", [-1]) * 64, 63
        self.entries: list[Class] = []
        self.bytes = 0

    def _slot(self, digest: bytes, content: bytes) -> int:
        at = int.from_bytes(digest[:8], "little") & self.mask
        while (e := self.slots[at]) >= 0:
            found = self.entries[e]
            if found.digest == digest and found.content == content:
                break
            at = (at + 1) & self.mask
        return at

    def find(self, digest: bytes, content: bytes) -> int:
        """The entry with this content, or -1."""
        return self.slots[self._slot(digest, content)]

    def add(self, new: Class) -> Class:
        """`new`, or the class of its content that it has been added to."""
        at = self._slot(new.digest, new.content)
        if self.slots[at] >= 0:
            old = self.entries[self.slots[at]]
            old.take(new)
            return old
        self.slots[at] = len(self.entries)
        self.entries.append(new)
        self.bytes += len(new.content) + ENTRY
        if 2 * len(self.entries) > self.mask:
            self._grow()
        return new

    def _grow(self) -> None:
        self.mask = 2 * self.mask + 1
        self.slots = array("q", [-1]) * (self.mask + 1)
        for i, e in enumerate(self.entries):
            at = int.from_bytes(e.digest[:8], "little") & self.mask
            while self.slots[at] >= 0:
                at = (at + 1) & self.mask
            self.slots[at] = i


def spill(classes: Iterable[Class], level: int, folder: Path) -> list[Path]:
    """Files of `classes` by the digest's four bits at `level`; only those that have any."""
    paths = [folder / f"{level}-{k:x}" for k in range(FILES)]
    open_files = [None] * FILES
    try:
        for c in classes:
            k = c.digest[level // 2] >> (4 * (1 - level % 2)) & 15
            if open_files[k] is None:
                open_files[k] = paths[k].open("wb")
            pickle.dump((c.digest, c.content, c.n, c.top, c.parts, c.numbers), open_files[k], 5)
    finally:
        for f in open_files:
            if f is not None:
                f.close()
    return [p for p, f in zip(paths, open_files, strict=True) if f is not None]


def spilled(path: Path) -> Iterator[Class]:
    with path.open("rb") as f:
        while True:
            try:
                yield Class(*pickle.load(f))
            except EOFError:
                return


def drained(entries: list[Class]) -> Iterator[Class]:
    while entries:
        yield entries.pop()


def merged(classes: Iterable[Class], budget: int, folder: Path, level: int = 0) -> Iterator[Class]:
    """One class per content; where they do not fit, by way of spill files in `folder`."""
    classes, table = iter(classes), ContentTable()
    for c in classes:
        table.add(c)
        if table.bytes > budget and len(table.entries) > 1 and level < 64:
            entries, table = table.entries, None
            below = folder / f"at-{level}"
            below.mkdir(exist_ok=True)
            for path in spill(chain(drained(entries), classes), level, below):
                bucket = below / f"{path.name}-in"
                bucket.mkdir()
                yield from merged(spilled(path), budget, bucket, level + 1)
                path.unlink()
            return
    yield from table.entries


def _rank(value) -> tuple:
    return (value is not None, value)


def collected(batches: Iterable[pa.RecordBatch], part: int, budget: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Pass 1: member rows (no content), and one row per class with its content."""
    table, first, at = ContentTable(), 0, 0

    def closed() -> Iterator[pa.RecordBatch]:
        entries = table.entries
        for lo in range(0, len(entries), 256):
            some = entries[lo : lo + 256]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([e.top[0][1] for e in some], schema.field("id").type),
                    pa.array([part] * len(some), pa.int64()),
                    pa.array([e.top[1] for e in some], pa.int64()),
                    pa.array([first + lo + i for i in range(len(some))], pa.int64()),
                    pa.array([e.n for e in some], pa.int64()),
                    pa.array([e.digest.hex() for e in some], pa.string()),
                    pa.array([e.content for e in some], pa.binary()),
                ],
                schema=schema,
            )

    for batch in batches:
        ids, (offs, data) = batch.column(0).to_pylist(), buffers(batch.column(1))
        numbers, digests = array("q"), []
        for i, id_ in enumerate(ids):
            content = data[offs[i] : offs[i + 1]].tobytes().lower()
            digest = hashlib.sha256(content).digest()
            e = table.find(digest, content)
            if e < 0:
                if table.bytes + len(content) > budget and table.entries:
                    yield from closed()
                    first += len(table.entries)
                    table = ContentTable()
                e = len(table.entries)
                table.add(Class(digest, content, 1, (_rank(id_), at + i), array("q"), array("q")))
            else:
                c = table.entries[e]
                c.n += 1
                c.top = max(c.top, (_rank(id_), at + i))
            numbers.append(first + e)
            digests.append(digest.hex())
        n = len(ids)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(schema.field("id").type), pa.array([part] * n, pa.int64()), pa.array(range(at, at + n), pa.int64()), pa.array(numbers, pa.int64()),
                pa.nulls(n, pa.int64()), pa.array(digests, pa.string()), pa.nulls(n, pa.binary()),
            ],
            schema=schema,
        )
        at += n
    yield from closed()


def resolved(batches: Iterable[pa.RecordBatch], budget: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Pass 2: for every class of pass 1 the row that stays and the size of its group."""

    def classes() -> Iterator[Class]:
        for b in batches:
            cols = [b.column(k).to_pylist() for k in range(6)]
            for i in range(b.num_rows):
                id_, part, at, number, n, digest = (c[i] for c in cols)
                yield Class(bytes.fromhex(digest), b.column(6)[i].as_py(), n, (_rank(id_), part, at), array("q", [part]), array("q", [number]))

    def rows(found: list[Class]) -> pa.RecordBatch:
        sizes = [len(c.parts) for c in found]
        spread = lambda values: [v for v, k in zip(values, sizes, strict=True) for _ in range(k)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(chain.from_iterable(c.parts for c in found)), pa.int64()),
                pa.array(list(chain.from_iterable(c.numbers for c in found)), pa.int64()),
                pa.array(spread([c.top[0][1] for c in found]), schema.field("keep_id").type),
                pa.array(spread([c.top[1] for c in found]), pa.int64()),
                pa.array(spread([c.top[2] for c in found]), pa.int64()),
                pa.array(spread([c.n for c in found]), pa.int64()),
            ],
            schema=schema,
        )

    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        found: list[Class] = []
        held = 0
        for c in merged(classes(), budget, Path(folder)):
            c.content = b""
            found.append(c)
            held += len(c.parts)
            if held >= 4096:
                yield rows(found)
                found, held = [], 0
        if found:
            yield rows(found)


def duplicate_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", budget: int = BUDGET) -> DataFrame:
    """Per row of `docs`: doc_id, keep_id (the group's largest id), group_size, kept (one row of each
    group) and text_sha256 of the text in lower case (A-Z only)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    id_type = docs.schema[id_column].dataType
    fields = [("part", LongType()), ("at", LongType()), ("number", LongType()), ("n", LongType()), ("digest", StringType()), ("content", BinaryType())]
    schema = StructType([StructField("id", id_type)] + [StructField(n, t) for n, t in fields])
    out = StructType([StructField(n, t) for n, t in (("part", LongType()), ("number", LongType()), ("keep_id", id_type), ("keep_part", LongType()), ("keep_at", LongType()), ("group_size", LongType()))])
    wire, wire_out = to_arrow_schema(schema), to_arrow_schema(out)
    quoted = lambda name: F.col("`" + name.replace("`", "``") + "`")

    rows = docs.select(quoted(id_column).alias("id"), quoted(text_column).cast("string").alias("text"))
    rows = staged(rows.mapInArrow(lambda batches: collected(batches, TaskContext.get().partitionId(), budget, wire), schema), "members", compression="zstd")
    classes = rows.where("n is not null").repartition("digest").mapInArrow(lambda batches: resolved(batches, budget, wire_out), out)
    members = rows.where("n is null").select("id", "part", "at", "number", "digest")
    kept = (F.col("keep_part") == F.col("part")) & (F.col("keep_at") == F.col("at"))
    return members.join(classes, ["part", "number"]).select(F.col("id").alias("doc_id"), "keep_id", "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256"))
