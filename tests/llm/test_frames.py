"""Fill-in-the-middle from frames of any size against the text cut as a list of units."""

import hashlib
import re

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from meterflow.llm import frames

PACK, UNPACK = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def plain_way(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output)."""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def framed_way(doc_id, text, size):
    t = frames.framed(frames.pieces(memoryview(text.encode()), size), size, PACK)
    form, parts, p, m = frames.arranged(t, doc_id, UNPACK)
    out = frames.framed(frames.written(t, parts, UNPACK), size, PACK)
    assert b"".join(frames.restored(out, form, UNPACK)).decode() == text
    return t.units[-1], form, p, m, b"".join(out.read(0, out.bytes[-1], UNPACK)).decode()


@settings(max_examples=300, deadline=None)
@given(st.integers(-5, 10_000) | st.none(), st.text(st.sampled_from("abZ é𝄞\n<PSM>"), max_size=60), st.integers(1, 20))
def test_any_frame_size(doc_id, text, size):
    assert framed_way(doc_id, text, size) == plain_way(doc_id, text)


def test_only_cut_frames_are_opened_for_selection():
    text = "".join(f"word{i} " for i in range(20_000))
    t = frames.framed(frames.pieces(memoryview(text.encode()), 1_000), 1_000, PACK)
    opened = []

    class Counting:
        def decompress(self, data):
            opened.append(data)
            return UNPACK.decompress(data)

    at, chars = t.place(t.units[-1] // 2, Counting())
    assert len(opened) <= 2 and len(t.frames) > 100  # the cut frame, and the end of the one before
    assert len(re.findall(r"[A-Za-z]+|[^A-Za-z]", text[:chars])) == t.units[-1] // 2 and at == chars


@pytest.mark.parametrize("size", [frames.FRAME, 7])
def test_query_on_odd_rows(spark, size):
    rows = [(i, f"Some text {i}, é and\n\tmore " * (i % 9)) for i in range(120)]
    rows += [(None, None), (None, "null id"), (3, ""), (3, "again"), (3, "again"), (500, "a <S> marker"), (501, "<P"), (502, "x" * 400_000 if size > 100 else "x" * 4_000), (503, "<P><S><M>")]
    docs = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], "doc_id long, text string, frames string, n int")
    out = frames.fill_in_middle(frames.store(docs, frame=size), frame=size).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(d, *(x := plain_way(d, t or ""))[:4], sha(x[4]), sha(t or ""), x[4]) for d, t in rows]
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert frames.fill_in_middle(frames.store(docs.limit(0))).collect() == []
