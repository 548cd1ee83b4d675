"""Fill-in-the-middle transformation over texts stored as seekable compressed frames.

`store` keeps every text as independent zstandard frames of `FRAME` bytes (ending between code points)
with running sums of units, code points and bytes. A unit is a run of A-Z and a-z or any other single
code point; a run that goes on over a frame's end is counted where it begins, so the sums are whatever
the frames' sizes are. To cut a text after k units, the sums name the frame in which unit k begins,
and only that frame is decompressed to find the place. Everything else streams: the three parts are
read frame by frame, in the order of the form, into new frames and into digests, so that of a long
text one frame is held in the clear at a time.

`fill_in_middle` chooses two cuts and a form per document from digests of its id, writes the text with
its markers, and `restored` takes such an output and its form back to the text: it looks for the
markers over frame borders, and reads the parts between them in the text's order. A text that holds a
marker already stays plain, so the first ones found are always the form's own.

Defined cases: null and empty texts are plain, of no units. A null id is digested as an empty one. Equal
rows give equal rows. Cuts may coincide or lie at an end; parts are then empty. An empty table gives
no rows. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.text import buffers

#: Fixed by the transformation's form: markers, the digests' prefix, and percentages.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, PLAIN_FROM, SPM_BELOW = "1:", 90, 20
#: Bytes of text in a frame, before compression; and bytes of frames that make a batch of output.
FRAME, BATCH = 1 << 16, 8 << 20

LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = True


@dataclass
class Frames:
    """A text in frames. The sums have one more entry than there are frames, and begin with 0."""

    frames: list[bytes] = field(default_factory=list)
    units: list[int] = field(default_factory=lambda: [0])
    chars: list[int] = field(default_factory=lambda: [0])
    bytes: list[int] = field(default_factory=lambda: [0])
    #: Does the last byte so far belong to a run of letters?
    in_run: bool = False

    def add(self, data: bytes, packer: zstandard.ZstdCompressor) -> None:
        starts, chars = unit_starts(data, self.in_run)
        self.frames.append(packer.compress(data))
        self.units.append(self.units[-1] + int(starts.sum()))
        self.chars.append(self.chars[-1] + chars)
        self.bytes.append(self.bytes[-1] + len(data))
        self.in_run = bool(LETTER[data[-1]])

    def begins_in_run(self, k: int, unpacker: zstandard.ZstdDecompressor) -> bool:
        return k > 0 and bool(LETTER[unpacker.decompress(self.frames[k - 1])[-1]])

    def place(self, k: int, unpacker: zstandard.ZstdDecompressor) -> tuple[int, int]:
        """(bytes, code points) before unit k begins; the whole text where there is none."""
        if k >= self.units[-1]:
            return self.bytes[-1], self.chars[-1]
        f = int(np.searchsorted(self.units, k, "right")) - 1
        data = unpacker.decompress(self.frames[f])
        # a frame's first letter begins a unit unless the frame before ends in letters
        joined = bool(LETTER[data[0]]) and self.begins_in_run(f, unpacker)
        at = int(np.flatnonzero(unit_starts(data, joined)[0])[k - self.units[f]])
        return self.bytes[f] + at, self.chars[f] + code_points(np.frombuffer(data, np.uint8)[:at])

    def read(self, start: int, end: int, unpacker: zstandard.ZstdDecompressor) -> Iterator[bytes]:
        """Bytes [start, end) of the text, frame by frame."""
        f = int(np.searchsorted(self.bytes, start, "right")) - 1
        while start < end:
            data = unpacker.decompress(self.frames[f])[start - self.bytes[f] : end - self.bytes[f]]
            yield data
            start += len(data)
            f += 1


def code_points(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def unit_starts(data: bytes, in_run: bool) -> tuple[np.ndarray, int]:
    """(which bytes begin a unit, number of code points)."""
    b = np.frombuffer(data, np.uint8)
    letter = LETTER[b]
    head = (b & 0xC0) != 0x80
    starts = head.copy()
    starts[1:] &= ~(letter[1:] & letter[:-1])
    if in_run and len(b) and letter[0]:
        starts[0] = False
    return starts, int(np.count_nonzero(head))


def pieces(data, size: int) -> Iterator[bytes]:
    """`data` in pieces of about `size` bytes that end between code points."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        yield bytes(data[at:end])
        at = end


def framed(parts: Iterable[bytes], size: int, packer: zstandard.ZstdCompressor) -> Frames:
    """Frames of a text that comes in parts."""
    out, rest = Frames(), b""
    for part in parts:
        rest += part
        if len(rest) >= 2 * size:
            *full, rest = pieces(rest, size)
            for piece in full:
                out.add(piece, packer)
    for piece in pieces(rest, size):
        out.add(piece, packer)
    return out


def find_markers(text: Iterable[bytes], markers: tuple[bytes, ...]) -> list[int]:
    """Where each of `markers` begins first in a text that comes in parts, -1 for nowhere. A marker is
    looked for over the parts' borders."""
    found, base, tail = [-1] * len(markers), 0, b""
    keep = max(map(len, markers)) - 1
    for part in text:
        window = tail + part
        for i, m in enumerate(markers):
            if found[i] < 0 and (at := window.find(m)) >= 0:
                found[i] = base + at
        tail = window[-keep:]
        base += len(window) - len(tail)
    return found


def choices(doc_id) -> list[int]:
    h = hashlib.sha256(f"{SEED}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]


def arranged(text: Frames, doc_id, unpacker) -> tuple[str, list[bytes | tuple[int, int]], int | None, int | None]:
    """(form, what its output is made of: markers and stretches of the text, prefix_chars, middle_chars)."""
    n, size = text.units[-1], text.bytes[-1]
    h1, h2, h3, h4 = choices(doc_id)
    if not n or h3 % 100 >= PLAIN_FROM or max(find_markers(text.read(0, size, unpacker), (PREFIX, SUFFIX, MIDDLE))) >= 0:
        return "plain", [(0, size)], None, None
    (a, chars_a), (b, chars_b) = (text.place(k, unpacker) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    if h4 % 100 < SPM_BELOW:
        return "spm", [SUFFIX, (b, size), PREFIX, (0, a), MIDDLE, (a, b)], chars_a, chars_b - chars_a
    return "psm", [PREFIX, (0, a), SUFFIX, (b, size), MIDDLE, (a, b)], chars_a, chars_b - chars_a


def written(text: Frames, parts: list[bytes | tuple[int, int]], unpacker) -> Iterator[bytes]:
    for part in parts:
        if isinstance(part, bytes):
            yield part
        else:
            yield from text.read(*part, unpacker)


def restored(output: Frames, form: str, unpacker) -> Iterator[bytes]:
    """The text that an output of this form was made from."""
    size = output.bytes[-1]
    if form == "plain":
        yield from output.read(0, size, unpacker)
        return
    p, s, m = find_markers(output.read(0, size, unpacker), (PREFIX, SUFFIX, MIDDLE))
    # every part goes from its marker to the next one, or to the end
    ends = {p: s, s: m, m: size} if form == "psm" else {s: p, p: m, m: size}
    for at in (p, m, s):
        yield from output.read(at + len(PREFIX), ends[at], unpacker)


def sha256(parts: Iterable[bytes]) -> str:
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part)
    return digest.hexdigest()


_FRAMES = "frames array<binary>, units array<bigint>, chars array<bigint>, bytes array<bigint>"
_ARROW = [("frames", pa.list_(pa.binary())), *((c, pa.list_(pa.int64())) for c in ("units", "chars", "bytes"))]


def _batches(rows: Iterator[tuple[tuple, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of (row, bytes) rows, of about `BATCH` bytes."""

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)

    some, held = [], 0
    for row, size in rows:
        some.append(row)
        held += size
        if held >= BATCH or len(some) >= 4096:
            yield batch()
            some, held = [], 0
    if some:
        yield batch()


def store(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", frame: int = FRAME) -> DataFrame:
    """(doc_id, frames, units, chars, bytes): every text in frames, and the running sums over them."""
    id_field = docs.select(F.col(id_column).alias("doc_id")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)

        def rows():
            for b in batches:
                offs, data = buffers(b.column(1))
                for i, doc_id in enumerate(b.column(0).to_pylist()):
                    t = framed(pieces(memoryview(data[offs[i] : offs[i + 1]]), frame), frame, packer)
                    yield (doc_id, t.frames, t.units, t.chars, t.bytes), sum(map(len, t.frames))

        yield from _batches(rows(), schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = pa.schema([to_arrow_schema(id_field).field(0), *_ARROW])
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_field[0].dataType.simpleString()}, {_FRAMES}")


def fill_in_middle(stored: DataFrame, frame: int = FRAME, outputs: bool = True) -> DataFrame:
    """Per row of `store`: doc_id, n (units), form, prefix_chars, middle_chars (null if plain),
    output_sha256, restored_sha256, and the output itself as text, unless `outputs` is false."""
    from pyspark.sql.pandas.types import to_arrow_schema

    id_field = stored.select("doc_id").schema
    columns = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string())]
    schema = pa.schema([to_arrow_schema(id_field).field(0), *columns, *([("output", pa.string())] if outputs else [])])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, unpacker = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()

        def rows():
            for b in batches:
                for i in range(b.num_rows):
                    doc_id, *kept = (b.column(k)[i].as_py() for k in range(5))
                    text = Frames(*kept)
                    form, parts, prefix, middle = arranged(text, doc_id, unpacker)
                    out = framed(written(text, parts, unpacker), frame, packer)
                    row = doc_id, text.units[-1], form, prefix, middle, sha256(out.read(0, out.bytes[-1], unpacker)), sha256(restored(out, form, unpacker))
                    if outputs:
                        row += (b"".join(out.read(0, out.bytes[-1], unpacker)).decode(),)
                    yield row, out.bytes[-1] if outputs else 200

        yield from _batches(rows(), schema)

    kinds = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string" + ", output string" * outputs
    return stored.select("doc_id", "frames", "units", "chars", "bytes").mapInArrow(run, f"doc_id {id_field[0].dataType.simpleString()}, {kinds}")
