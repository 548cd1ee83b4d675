"""Secret scanning: fixed patterns, and sliding-window Shannon entropy per character class.

Three patterns are always reported (kinds assign, access and hex). Besides, in every candidate string
(a run of 20 or more letters, digits and ``+/_=-``) a window slides over each maximal stretch of every
character class, so that a hexadecimal or base32 part of a longer run meets its own threshold. The
window's entropy follows from counts that are updated by the character that enters and the one that
leaves, so a run costs time in proportion to its length. Windows that reach the class's threshold and
hold its least number of digits are merged, over all classes, to spans of kind ``entropy``, unless a
pattern's span covers them or the whole run looks like an identifier or a path of words. Windows that
lie within a substring named by the allow list, or hold at most `REST` characters besides such, do
not count. The classes given ask for one digit, since letters alone are prose more often than keys;
`CharClass.digits` = 0 takes letters too.

Null and empty texts have no spans; every match of a repeated or very long text is reported. An empty
table gives no rows. Columns other than id and text are not read by `scan` and pass through `redact`.
Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass
from functools import cached_property
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.text import blocks, buffers

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A maximal run of 24 or more is what a maximal run filtered by length gives.
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
DIGIT = re.compile(r"[0-9]")
#: A window needs so many characters that the allow list does not name.
REST = 12
KINDS = ("assign", "access", "hex", "entropy")
MIN_ASSIGN, MIN_ACCESS = 6, 20


@dataclass(frozen=True)
class CharClass:
    """Stretches of `chars`; a window of `window` characters counts from `bits` of entropy on, with `digits` digits at least."""

    name: str
    chars: frozenset[str]
    window: int
    bits: float
    digits: int = 1

    @cached_property
    def stretch(self) -> re.Pattern:
        return re.compile(f"[{re.escape(''.join(sorted(self.chars)))}]{{{self.window},}}")


CLASSES = (
    CharClass("hexadecimal", frozenset("0123456789abcdefABCDEF"), 20, 3.0),
    CharClass("base32", frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567="), 20, 3.5),
    CharClass("base36", frozenset("abcdefghijklmnopqrstuvwxyz0123456789"), 20, 3.5, digits=2),
    CharClass("base64", frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"), 20, 3.8),
)

#: Suppressed: placeholders (words together with the letters joined to them), UUIDs; whole runs that are file or
#: URL paths or words joined by dashes or underscores, with a short number at the end at most.
ALLOW = (
    re.compile(r"(?i)(?:example|sample|dummy|placeholder|changeme|your[_-]|test[_-]?key)(?P<word>)|xxxx|0{8}|1234567890"),
    re.compile(r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"),
    re.compile(r"/?(?:[a-z]+[/_-])+(?:[a-z]+[0-9]{0,4}|[0-9]{1,4})"),
)


def window_entropies(s: str, window: int) -> list[float]:
    """Shannon entropy in bits of every window of `s`, each from the one before in constant time."""
    xlog = [0.0] + [k * math.log2(k) for k in range(1, window + 2)]  # for a moment one more is inside
    counts: dict[str, int] = {}
    total, out, base = 0.0, [], math.log2(window)
    for i, c in enumerate(s):
        n = counts.get(c, 0)
        total += xlog[n + 1] - xlog[n]
        counts[c] = n + 1
        if i >= window:
            gone = s[i - window]
            n = counts[gone]
            total += xlog[n - 1] - xlog[n]
            counts[gone] = n - 1
        if i >= window - 1:
            out.append(base - total / window)
    return out


def high_entropy(s: str, classes=CLASSES, skip: tuple | list = ()) -> list[tuple[int, int]]:
    """Merged [start, end) stretches of `s` in windows that reach the threshold of a class and have
    `REST` characters outside of `skip`."""
    spans: list[tuple[int, int]] = []
    free = [1] * len(s)
    for a, b in skip:
        free[a:b] = [0] * (b - a)
    free = [0, *accumulate(free)] if skip else range(len(s) + 1)
    digits = [0, *accumulate("0" <= c <= "9" for c in s)]
    for cls in classes:
        n = cls.window
        for m in cls.stretch.finditer(s):
            for i, bits in enumerate(window_entropies(m.group(), n), m.start()):
                if bits >= cls.bits and digits[i + n] - digits[i] >= cls.digits and free[i + n] - free[i] >= REST:
                    spans.append((i, i + n))
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def named(run: str, allow=ALLOW) -> list[tuple[int, int]]:
    """The stretches of `run` that the allow list names; a placeholder's word names the letters joined
    to it, but nothing beyond them: whether the rest is random is for its entropy to say."""
    out = []
    for p in allow[:2]:
        at = 0
        while m := p.search(run, at):
            a, b = m.span()
            if m.groupdict().get("word") is not None:
                while a > at and run[a - 1].isalpha():
                    a -= 1
                while b < len(run) and run[b].isalpha():
                    b += 1
            out.append((a, b))
            at = b
    return out


def scan_text(text: str, classes=CLASSES, allow=ALLOW) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret, by start and then kind in the order of `KINDS`."""
    found: list[tuple[str, int, int]] = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    if DIGIT.search(text) or not all(c.digits for c in classes):
        base = list(found)
        for m in CANDIDATE.finditer(text):
            run, at = m.group(), m.start()
            if any(p.fullmatch(run) for p in allow[2:]):
                continue
            for a, b in high_entropy(run, classes, named(run, allow)):
                if not any(s <= at + a and at + b <= e for _, s, e in base):
                    found.append(("entropy", at + a, at + b))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def redact_text(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """`text` with every stretch covered by spans replaced by `mark`."""
    out, at, merged = [], 0, []
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for s, e in merged:
        out += [text[at:s], mark]
        at = e
    return "".join([*out, text[at:]])


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, spans array<struct<kind, start, end>>), one row per row of `docs`."""
    kind = docs.schema[id_col].dataType
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            offs, _ = buffers(batch.column("text"))
            for lo, hi in blocks(offs):
                part = batch.slice(lo, hi - lo)
                rows = [[{"kind": k, "start": s, "end": e} for k, s, e in scan_text(t or "")] for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(rows, span)], ["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind.simpleString()}, spans array<struct<kind:string,start:int,end:int>>").withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_assign, n_access, n_hex, base_sha256, spans) from the spans of `scan`."""
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["kind"].isin("assign", "access", "hex"))
    return found.select(
        id_col,
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every secret in `text_col` replaced by `mark`; null texts stay null."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            offs, _ = buffers(batch.column(at))
            for lo, hi in blocks(offs):
                part = batch.slice(lo, hi - lo)
                got = [t and redact_text(t, scan_text(t), mark) for t in part.column(at).to_pylist()]
                yield part.set_column(at, part.schema.field(at), pa.array(got, part.schema.field(at).type))

    # columns by place, whatever their names
    placed = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return placed.mapInArrow(run, placed.schema).toDF(*docs.columns)
