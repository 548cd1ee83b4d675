"""WARC archives: a writer that marks repeated payloads, and a reader that salvages damaged files.

Writing uses Spark's text writer: a record is one row, and the blank lines that end a WARC record
are its line separator. Response records hold an HTTP response; a record whose payload equals that
of an earlier one becomes a revisit that refers to it and repeats only the HTTP header. Pages are
shuffled as digests and ids: the digests that repeat are written first, and every page meets them by
a broadcast join; where they pass `BROADCAST` bytes, the revisits' ids are found by a shuffle of ids
and digests, and pages meet those by id, so that a payload many pages share makes no hot key. Pages
of `LONG_PAGE` bytes or more get a file each, others at most `MAX_RECORDS` to a file: no file of the
writer passes the 2 GiB that Spark's binaryFile source can read.

Reading takes whole archive files, plain or with gzip members, one per row of the binaryFile source
(``spark.sql.sources.binaryFile.maxLength`` bounds them; larger ones make the read fail, none is
skipped). At every position the reader checks a gzip member (its CRC and length) or
a record (version line, header, Content-Length, closing blank lines, block digest). Where a check
fails it searches for the next gzip magic or version line at which all checks hold, goes on from
there, and reports the bytes between as one gap with the first failure as its reason.

Members are inflated in pieces, as far as they can be read, and the same search runs over what they
inflate to, so a bad record or a damaged or cut member costs no other record. Records and gaps inside
a member have the place of the member; a gap's reason has its inflated bytes. Of a member that breaks
off with an error or fails its CRC only records count whose own digest holds.

Null html is an empty payload, a null URL, or one of more than 4 MiB, is left out of the record, control characters and spaces
in URLs are percent-encoded. Rows of equal payload and equal, smallest page_id are all responses; so
are rows without a page_id, unless another page has their payload. Every row has a record, repeated
and very long ones too. An empty table makes archives without records, an empty archive has neither
records nor gaps. Other columns of the table are not read, whatever their names. No damage makes the
reader fail: what cannot be read is a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.plans.stage import staged

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
#: Payloads below this many bytes are always stored.
MIN_REVISIT = 100
#: Most records of a file that the writer makes of pages below `LONG_PAGE` bytes; longer ones stand alone.
MAX_RECORDS, LONG_PAGE = 1_000, 1 << 18
#: Largest size of the table of repeated digests that is broadcast.
BROADCAST = 16 << 20
#: Bytes of a member read at once, and of what they inflate to.
PIECE = 1 << 16
#: Most bytes of a record's header; bytes of a record in a member above which it is checked before it
#: is kept; and of a URL above which it is left out.
HEADER, AHEAD, LONG_URL = 8 << 20, 1 << 20, 4 << 20


def _record(kind: str, identity: Column, url: Column, digest: Column, extra: list[Column], http: Column, payload: Column) -> Column:
    """The text of one record, without the blank lines that end it."""
    block = F.concat(http, payload)
    target = F.when(url.isNotNull(), F.concat(F.lit("WARC-Target-URI: "), url, F.lit(CRLF))).otherwise("")
    head = F.concat(
        F.lit(f"{VERSION}{CRLF}WARC-Type: {kind}{CRLF}WARC-Record-ID: <urn:page:"), identity, F.lit(f">{CRLF}WARC-Date: {DATE}{CRLF}"), target,
        F.lit("WARC-Payload-Digest: sha256:"), digest, F.lit(CRLF), F.lit("WARC-Block-Digest: sha256:"), F.sha2(block, 256), F.lit(CRLF), *extra,
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF),
    )
    return F.concat(head, block)


def _origins(p: DataFrame) -> tuple[DataFrame, bool, bool]:
    """`p` (id, url, html, digest) with the `origin` of every revisit, null for responses; whether it
    has pages below `LONG_PAGE` bytes, and longer ones."""
    size = F.octet_length("html")
    least, most = p.agg(F.min(size), F.max(size)).first()
    ids = p.select("id", F.unhex("digest").alias("sha"), size.alias("size"))
    # only payloads that repeat: a few rows per group before the shuffle, one after
    groups = ids.where(F.col("size") >= MIN_REVISIT).groupBy("sha").agg(F.min("id").alias("origin"), F.count("*").alias("n"))
    repeated = staged(groups.where("n > 1 and origin is not null").drop("n"), "repeated")
    bytes_ = repeated.agg(F.sum(F.octet_length(F.col("origin").cast("string")) + 64)).first()[0] or 0
    again = ~F.col("id").eqNullSafe(F.col("origin"))
    sha = F.unhex("digest")
    if bytes_ <= BROADCAST:
        placed = p.withColumn("sha", sha).join(F.broadcast(repeated), "sha", "left")
        placed = placed.withColumn("origin", F.when(again & (size >= MIN_REVISIT), F.col("origin")))
    else:
        found = ids.where(F.col("size") >= MIN_REVISIT).join(repeated, "sha").where(again)
        found = staged(found.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("of"), "sha", "origin").distinct(), "revisits")
        placed = p.withColumns({"of": F.coalesce(F.col("id").cast("string"), F.lit("")), "sha": sha}).join(found, ["of", "sha"], "left")
    return placed, least < LONG_PAGE, most >= LONG_PAGE


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """One record per page, in WARC files in folders under `path`."""
    p = pages.select(F.col(id_col).alias("id"), F.when(F.octet_length(F.col(url_col).cast("string")) <= LONG_URL, F.col(url_col).cast("string")).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    if p.isEmpty():
        p.select(F.col("html").alias("value")).write.text(path)
        return
    placed, usual, long = _origins(p.withColumn("digest", F.sha2("html", 256)))
    revisit = F.col("origin").isNotNull()
    url = F.regexp_replace(F.regexp_replace("url", " ", "%20"), "[\\x00-\\x1F\\x7F]", "%0A")
    identity = F.coalesce(F.col("id").cast("string"), F.lit(""))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length("html").cast("string"), F.lit(CRLF + CRLF)
    )
    refers = [F.lit(f"WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: <urn:page:"), F.col("origin").cast("string"), F.lit(f">{CRLF}")]
    record = F.when(revisit, _record("revisit", identity, url, F.col("digest"), refers, http, F.lit(""))).otherwise(
        _record("response", identity, url, F.col("digest"), [], http, F.col("html"))
    )
    is_long = F.octet_length("html") >= LONG_PAGE
    for wanted, which, most, folder in ((usual, ~is_long, MAX_RECORDS, "usual"), (long, is_long, 1, "long")):
        if wanted:
            rows = placed.where(which).select(record.alias("value"))
            rows.write.option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", most).text(f"{path}/{folder}")


_HEADER = re.compile(rb"^WARC/1\.[01]\r?\n")
_NEXT = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r?\n")


_LINE = re.compile(rb"WARC/1\.[01]\r?\n")
_LENGTH = re.compile(r"[0-9]{1,18}")


class Broken(ValueError):
    """A member or record that fails a check."""


class Short(Broken):
    """A record that goes on behind the data at hand: `need` bytes are wanted."""

    def __init__(self, why: str, need: int):
        super().__init__(why)
        self.need = need


def digest_holds(head: dict[str, str], block: bytes) -> bool | None:
    """Whether the block has the header's digest; None without one that can be checked."""
    algorithm, _, digest = head.get("warc-block-digest", "").partition(":")
    if algorithm.lower() == "sha256":
        return hashlib.sha256(block).hexdigest() == digest.lower()
    if algorithm.lower() == "sha1" and len(digest) in (32, 40):
        h = hashlib.sha1(block)
        return digest.upper() in (h.hexdigest().upper(), base64.b32encode(h.digest()).decode())
    return None


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """(header, block, end) of the record at `at`, or Broken."""
    if not (m := _HEADER.match(data[at : at + 16])):
        raise Broken("no version line")
    head: dict[str, str] = {}
    pos, most = at + m.end(), at + HEADER
    # line by line: a header that another version line stands in ends there, so no byte is read for many headers
    while (stop := data.find(b"\n", pos, most)) >= 0:
        line, pos = data[pos:stop], stop + 1
        if not line.endswith(b"\r"):
            raise Broken("header line without line end")
        if line == b"\r":
            break
        name, colon, value = line[:-1].partition(b":")
        if not colon:
            raise Broken("header line without colon")
        head[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    else:
        raise Short("header without end", min(2 * (len(data) - at), HEADER)) if len(data) < most else Broken("header without end")
    size = head.get("content-length", "")
    if not _LENGTH.fullmatch(size):
        raise Broken("no content length")
    start, end = pos, pos + int(size)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Short("record without end", end + 4 - at) if len(data) < end + 4 else Broken("record without end")
    block = data[start:end]
    if digest_holds(head, block) is False:
        raise Broken("block digest differs")
    return head, block, end + 4


class Inflater:
    """Reads a gzip member piece by piece; a copy reads on from the same place."""

    def __init__(self, data: bytes, at: int):
        self.z, self.view, self.pos, self.rest = zlib.decompressobj(31), memoryview(data), at, b""
        self.why, self.cut, self.ended, self.queue = "", False, False, []

    def copy(self) -> Inflater:
        other = Inflater.__new__(Inflater)
        other.__dict__ = self.__dict__ | {"z": self.z.copy() if not self.z.eof else self.z, "queue": list(self.queue)}
        return other

    def read(self) -> bytes | None:
        """The next piece, at most `PIECE` bytes or so; None at the end."""
        if self.queue:
            return self.queue.pop(0)
        if self.ended or self.z.eof:
            return None
        if not self.rest:
            self.rest = self.view[self.pos : self.pos + PIECE]
            self.pos += len(self.rest)
        kept, rest = self.z.copy(), self.rest
        try:
            out = self.z.decompress(rest, PIECE) if len(rest) else self.z.flush()
        except zlib.error as e:
            self.why, self.ended = f"gzip member: {e}", True
            for i in range(len(rest)):  # all that comes before the failure
                try:
                    self.queue.append(kept.decompress(rest[i : i + 1]))
                except zlib.error:
                    self.pos += i + 1 - len(rest)
                    break
            return self.read()
        if not len(rest) and not self.z.eof:
            self.why, self.cut, self.ended = "gzip member without end", True, True
        self.rest = self.z.unconsumed_tail
        return out

    @property
    def end(self) -> int:
        return self.pos - len(self.z.unused_data) if not self.why else self.pos


class Member:
    """The gzip member at `at`: after `check`, where it ends (`end`), its first failure (`why`, empty for
    an intact one; `cut`: the data ended first) and how many bytes it inflates to (`size`)."""

    def __init__(self, data: bytes, at: int):
        self.data, self.at, self.end, self.why, self.cut, self.size = data, at, at, "", False, 0

    def check(self) -> Member:
        z = Inflater(self.data, self.at)
        while (piece := z.read()) is not None:
            self.size += len(piece)
        self.end, self.why, self.cut = z.end, z.why, z.cut
        return self

    def salvage(self) -> Iterator[tuple[str, int, int, object]]:
        """Records and gaps as of `salvage`, by inflated bytes; run `check` first."""
        doubtful, pieces = bool(self.why) and not self.cut, Inflater(self.data, self.at)
        buf, base, at, gap, why, more = b"", 0, 0, -1, "", True
        while more or at < len(buf):
            try:
                if at == len(buf):
                    raise Short("", 1)
                if more and len(buf) - at < 16:
                    raise Short("no version line", 16)
                head, block, end = parse_record(buf, at)
                if doubtful and not digest_holds(head, block):
                    raise Broken("no digest in a damaged member")
            except Broken as e:
                if more and isinstance(e, Short) and self._whole(buf, base + at, at, e.need, pieces):
                    parts, size = [buf[at:]], len(buf) - at
                    while size < e.need and more:
                        piece = pieces.read()
                        more = piece is not None
                        parts.append(piece or b"")
                        size += len(parts[-1])
                    buf, base, at = b"".join(parts), base + at, 0
                    continue
                if gap < 0:
                    gap, why = base + at, str(e)
                m = _LINE.search(buf, at + 1)
                # a version line may begin in the last bytes
                at = m.start() if m else max(at + 1, len(buf) - 10) if more else len(buf)
                continue
            if gap >= 0:
                yield "gap", gap, base + at, why
                gap = -1
            yield "record", base + at, base + end, (head, block)
            at = end
        if gap >= 0 or self.why:
            yield "gap", gap if gap >= 0 else base + at, base + at, self.why or why


    def _whole(self, buf: bytes, place: int, at: int, need: int, pieces: Inflater) -> bool:
        """Whether `need` bytes from `place` on are worth holding: a record must lie within its member, and
        a long one must end as records do, which a copy of the inflater finds out without keeping it."""
        if need <= AHEAD:
            return True
        if place + need > self.size:
            return False
        left, tail, z = need - (len(buf) - at), b"", pieces.copy()
        while left > 0 and (piece := z.read()) is not None:
            tail = (tail + piece[:left])[-4:]
            left -= len(piece)
        return tail.endswith(b"\r\n\r\n"[-len(tail) :] if tail else b"-")


def _key(head: dict[str, str], block: bytes) -> bytes:
    return hashlib.sha256(repr(sorted(head.items())).encode() + b"\0" + block).digest()


def _holds(data: bytes, at: int, seen: set[bytes]) -> bool:
    """Whether a record can be read at `at` that is not in `seen`."""
    if data[at : at + 3] == b"\x1f\x8b\x08":
        return any(x[0] == "record" for x in Member(data, at).check().salvage())
    try:
        head, block, _ = parse_record(data, at)
    except Broken:
        return False
    return not seen or _key(head, block) not in seen


def salvage(data: bytes) -> Iterator[tuple[str, int, int, object]]:
    """("record", start, end, (header, block)) and ("gap", start, end, reason), covering `data`."""
    at, gap, why = 0, -1, ""
    seen: set[bytes] = set()  # of a damaged member that ends before `until`; stored ones can be read twice
    until = 0
    while at < len(data):
        items, failed, end = [], "", at
        if data[at : at + 3] == b"\x1f\x8b\x08":
            member = Member(data, at).check()
            inner = member.salvage()
            first = []
            for x in inner:
                first.append(x)
                if x[0] == "record":
                    break
            items, end, failed = chain(first, inner), member.end, member.why
            if first and first[-1][0] == "gap":  # no record at all
                if gap < 0:
                    gap, why = at, str(failed or first[0][3])
                if failed:
                    m = _NEXT.search(data, at + 1)
                    end = m.start() if m else len(data)
                at = end
                continue
            if failed:
                until = end
                seen = {_key(*x[3]) for x in member.salvage() if x[0] == "record"}
                end = next((m.start() for m in _NEXT.finditer(data, at + 1) if _holds(data, m.start(), seen if m.start() < until else set())), len(data))
        else:
            try:
                head, block, end = parse_record(data, at)
                if at < until and _key(head, block) in seen:
                    raise Broken("record read from its member")
            except Broken as e:
                if gap < 0:
                    gap, why = at, str(e)
                m = _NEXT.search(data, at + 1)
                at = m.start() if m else len(data)
                continue
            items = [("record", at, end, (head, block))]
        if gap >= 0:
            yield "gap", gap, at, why
            gap = -1
        for kind, a, b, what in items:
            yield kind, at, end, what if kind == "record" else f"{what}, inflated bytes {a} to {b}"
        at = end
    if gap >= 0:
        yield "gap", gap, len(data), why


def http_payload(head: dict[str, str], block: bytes) -> tuple[bytes, int]:
    """(payload, its full length): without the HTTP header, whose Content-Length a revisit's payload had."""
    if not head.get("content-type", "").startswith("application/http"):
        return block, len(block)
    top, _, body = block.partition(b"\r\n\r\n")
    size = re.search(rb"(?im)^content-length:\s*(\d{1,18})(?!\d)", top)
    return body, int(size[1]) if size and head.get("warc-type") == "revisit" else len(body)


SCHEMA = (
    "path string, kind string, start long, end long, reason string, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def read_archives(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One row per record (kind ``record``) and per quarantined byte range (kind ``gap``) of all
    archives under `path`. payload_digest is that of the payload read, or of a revisit's header."""

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column("path"), batch.column("content")):
                name, rows = name.as_py(), []
                for kind, start, end, what in salvage(data.as_py() or b""):
                    row = {"path": name, "kind": kind, "start": start, "end": end}
                    if kind == "gap":
                        row["reason"] = what
                    else:
                        head, block = what
                        body, size = http_payload(head, block)
                        revisit = head.get("warc-type") == "revisit"
                        row |= {
                            "record_type": head.get("warc-type"), "record_id": head.get("warc-record-id"), "target_uri": head.get("warc-target-uri"),
                            "refers_to": head.get("warc-refers-to"), "payload_bytes": size, "payload": None if revisit else body,
                            "payload_digest": head.get("warc-payload-digest", "").rpartition(":")[2] if revisit else hashlib.sha256(body).hexdigest(),
                        }
                    rows.append(row)
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, SCHEMA)


_ARROW = pa.schema(
    [(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in SCHEMA.split(", "))]
)


def page_records(records: DataFrame, id_type: str = "long") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records that `write_pages` made."""
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(.*)>', 1) as {id_type})")
    return records.where("kind = 'record'").select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to")
    )
