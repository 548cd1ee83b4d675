"""WARC writing, revisits, and salvage of damaged archives."""

import gzip
import hashlib
import random

import pytest

from meterflow.llm import warc

PAGES = "page_id long, url string, html string, payload string"
LONG = "<p>é日本</p>" * 30


def pages(spark):
    rows = [
        (5, "http://a/x y\n", LONG), (2, "http://b/", LONG), (9, None, LONG), (1, "u", "short"), (3, "u", "short"), (4, "u", None), (6, "u", ""),
        (7, "u", f"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n{'x' * 100}"), (8, "u", "a\r\n\r\nb" * 50), (8, "u", "a\r\n\r\nb" * 50),
    ]
    return rows, spark.createDataFrame([(*r, "clash") for r in rows], PAGES)


@pytest.mark.parametrize("broadcast", [warc.BROADCAST, -1])
def test_round_trip_with_revisits(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(warc, "BROADCAST", broadcast)
    monkeypatch.setattr(warc, "LONG_PAGE", 400)
    rows, df = pages(spark)
    warc.write_pages(df, f"file://{tmp_path}/w")
    records = warc.read_archives(spark, f"file://{tmp_path}/w", "part-*")
    assert records.where("kind = 'gap'").count() == 0
    got = sorted(tuple(r) for r in warc.page_records(records).collect())
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        first = min(j for j, _, g in rows if (g or "") == (h or ""))
        again = len(raw) >= 100 and i != first
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=lambda t: (t[0], t[1]))
    urls = {r.record_id: r.target_uri for r in records.collect()}
    assert urls["<urn:page:5>"] == "http://a/x%20y%0A" and urls["<urn:page:9>"] is None
    # long pages stand alone
    files = {}
    for r in records.collect():
        files.setdefault(r.path, []).append(r.payload_bytes)
    assert all(len(n) == 1 or max(n) < 400 for n in files.values()) and sum(max(n) >= 400 for n in files.values()) == 3


def test_null_ids_and_long_pages(spark, tmp_path):
    rows = [(None, "u", LONG), (None, "u", LONG), (3, "u", LONG), (None, "u", "q" * 200), (4, None, "z" * 400_000), (5, "u", "z" * 400_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], PAGES)
    warc.write_pages(df, f"file://{tmp_path}/n")
    got = warc.page_records(warc.read_archives(spark, f"file://{tmp_path}/n", "part-*")).collect()
    size = len(LONG.encode())
    want = [(None, 200, "response", None), (None, size, "revisit", 3), (None, size, "revisit", 3), (3, size, "response", None), (4, 400_000, "response", None), (5, 400_000, "revisit", 4)]
    assert sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got), key=repr) == sorted(want, key=repr)


def test_empty_table(spark, tmp_path):
    _, df = pages(spark)
    warc.write_pages(df.limit(0), f"file://{tmp_path}/e")
    assert warc.page_records(warc.read_archives(spark, f"file://{tmp_path}/e", "part-*")).count() == 0


def record(i, body):
    block = body.encode()
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def ids(data):
    return [r[3][0]["warc-record-id"][10:-1] for r in warc.salvage(data) if r[0] == "record"]


def test_salvage_plain_and_gzip(spark, tmp_path):
    plain = [record(i, f"body {i} WARC/1.0\r\n" * 20) for i in range(6)]
    for parts in (plain, [gzip.compress(x) for x in plain]):
        whole = b"".join(parts)
        assert ids(whole) == list("012345")
        hurt = bytearray(whole)
        at = len(parts[0]) + len(parts[1]) + len(parts[2]) // 2
        hurt[at : at + 8] = b"\x00" * 8
        out = list(warc.salvage(bytes(hurt)))
        gaps = [r for r in out if r[0] == "gap"]
        assert ids(bytes(hurt)) == list("01345")
        assert [(g[1], g[2]) for g in gaps] == [(len(parts[0]) + len(parts[1]), len(parts[0]) + len(parts[1]) + len(parts[2]))]
        cut = whole[: -len(parts[5]) // 2]
        assert ids(cut) == list("01234") and list(warc.salvage(cut))[-1][:3] == ("gap", len(whole) - len(parts[5]), len(cut))
        assert ids(b"junk" + whole[3:]) == list("12345")
        # every byte belongs to a record's member or to a gap
        spans = sorted({(r[1], r[2]) for r in out})
        assert spans[0][0] == 0 and spans[-1][1] == len(hurt) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert list(warc.salvage(b"")) == [] and list(warc.salvage(b"nothing"))[0][:3] == ("gap", 0, 7)
    (tmp_path / "x.warc.gz").write_bytes(bytes(hurt))
    (tmp_path / "y.warc.gz").write_bytes(b"")
    rows = warc.read_archives(spark, f"file://{tmp_path}", "*.warc.gz").collect()
    assert sorted(r.kind for r in rows) == ["gap"] + ["record"] * 5
    assert all(r.reason for r in rows if r.kind == "gap")


def test_salvage_inside_members():
    plain = [record(i, f"body {i} {hashlib.sha256(bytes([i])).hexdigest()} WARC/1.0\r\n" * 40) for i in range(8)]
    bad = bytearray(b"".join(plain))
    at = len(plain[0]) + len(plain[1]) + len(plain[2]) - 20
    bad[at] ^= 1
    after = gzip.compress(record(9, "after"))
    for level in (0, 9):
        # a bad record in an intact member
        one = gzip.compress(bytes(bad), level)
        out = list(warc.salvage(one + after))
        assert ids(one + after) == list("01345679")
        assert [r[1:3] for r in out if r[0] == "gap"] == [(0, len(one))]
        whole = gzip.compress(b"".join(plain), level)
        # a wrong CRC, a cut member, and a cut one before an intact one
        assert ids(whole[:-8] + b"\x00" * 8 + after) == list("012345679")
        cut = ids(whole[: len(whole) * 3 // 4])
        assert cut == [str(i) for i in range(len(cut))] and 3 <= len(cut) < 8
        out = list(warc.salvage(whole[: len(whole) * 3 // 4] + after))
        assert [r[3][0]["warc-record-id"][10:-1] for r in out if r[0] == "record"][-1] == "9"
        assert sum(r[0] == "record" for r in out) <= len(cut) + 2
        spans = sorted({(r[1], r[2]) for r in out})
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    # large blocks and long garbage, over many pieces
    big = record(1, "x" * 300_000) + b"?" * 200_000 + record(2, "y" * 70_000)
    assert ids(gzip.compress(big)) == list("12") and ids(gzip.compress(b"")) == []


def test_random_damage_never_raises():
    """Whatever happens to an archive: records and gaps cover it, and records away from the damage come through."""
    rng = random.Random(4)
    plain = [record(i, f"body {i} {hashlib.sha256(bytes([i])).hexdigest()} WARC/1.1\r\n" * rng.randint(1, 60)) for i in range(8)]
    forms = [plain, [gzip.compress(x) for x in plain], [gzip.compress(b"".join(plain[:4])), gzip.compress(b"".join(plain[4:]))]]
    junk = ["\u00b2\u0663".encode(), b"\r\n\r\n", b"WARC/1.0\r\n", b"\x1f\x8b\x08", b"Content-Length: 99999999999999999999999\r\n", b":", b"\xff\xfe"]
    for trial in range(240):
        parts = rng.choice(forms)
        data = bytearray(b"".join(parts))
        hurt = set()
        for _ in range(rng.randint(1, 3)):
            at, how = rng.randrange(len(data)), rng.randrange(4)
            if how == 0:
                data[at] ^= 1 << rng.randrange(8)
            elif how == 1:
                data[at : at + len(junk[trial % 7])] = junk[trial % 7]
            elif how == 2 and trial % 2:
                del data[at : at + rng.randint(1, 300)]
            else:
                data[at:at] = rng.choice(junk)
            hurt.add(at)
        out = list(warc.salvage(bytes(data)))
        spans = sorted({(r[1], r[2]) for r in out})
        assert spans[0][0] == 0 and spans[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        first = min(hurt)
        end, whole = 0, []
        for i, x in enumerate(parts):
            end += len(x)
            if end <= first:
                whole += [str(i)] if len(parts) == 8 else [str(k) for k in range(4 * i, 4 * i + 4)]
        got = [r[3][0].get("warc-record-id", "")[10:-1] for r in out if r[0] == "record"]
        assert got[: len(whole)] == whole
    one = record(1, "x").replace(b"Content-Length: 1", "Content-Length: \u00b2".encode())
    assert ids(one + record(2, "y")) == ["2"]
    revisit = record(3, "HTTP/1.1 200 OK\r\nContent-Length: 99999999999999999999\r\n\r\n").replace(b"resource", b"revisit")
    head, block = list(warc.salvage(revisit))[0][3]
    assert warc.http_payload(head | {"content-type": "application/http"}, block) == (b"", 0)


def sealed(body, n=None):
    size = len(body) if n is None else n
    return b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Block-Digest: sha256:" + hashlib.sha256(body).hexdigest().encode() + f"\r\nContent-Length: {size}\r\n\r\n".encode() + body + b"\r\n\r\n"


def test_version_lines_take_linear_time():
    import time

    for line in (b"WARC/1.0\r\n", b"WARC/1.0\n", b"WARC/1.0\r\na: b\r\n", b"WARC/1.0\r\nContent-Length: 99999999\r\n\r\n"):
        took = []
        for size in (1 << 20, 1 << 22):
            data = line * (size // len(line))
            began = time.process_time()
            assert [x[:3] for x in warc.salvage(data)] == [("gap", 0, len(data))]
            took.append(time.process_time() - began)
        assert took[1] < 8 * took[0] + 1


def test_wrong_length_in_a_member_costs_one_record_and_little_memory():
    """One number too large, by less and by more than what is left of a member of 40 MB."""
    import gzip
    import tracemalloc

    rng = random.Random(5)
    bodies = [rng.randbytes(20_000) for _ in range(2_000)]
    for wrong in (25_000_000, 10**12):
        data = gzip.compress(b"".join(sealed(b, wrong if i == 7 else None) for i, b in enumerate(bodies)), 1)
        tracemalloc.start()
        got = [x[0] for x in warc.salvage(data)]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert got.count("record") == len(bodies) - 1 and got.count("gap") == 1
        assert peak < 50 << 20


def test_long_records_in_members_are_read():
    import gzip

    big = random.Random(6).randbytes(5 << 20)
    got = list(warc.salvage(gzip.compress(sealed(b"a") + sealed(big) + sealed(b"c"), 1)))
    assert [x[0] for x in got] == ["record"] * 3 and got[1][3][1] == big


def test_odd_columns(spark, tmp_path):
    """Columns with names used inside pass by; very long URLs are left out, long ones kept."""
    rows = [(1, "u" * 300_000, "<p>", "x", "y", "z"), (2, "v" * (5 << 20), "q", "x", "y", "z"), (3, None, None, "x", "y", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, id string, digest string, value string")
    warc.write_pages(pages, f"file://{tmp_path}/odd")
    got = {r.record_id: r.target_uri for r in warc.read_archives(spark, f"file://{tmp_path}/odd", "part-*").collect()}
    assert got == {"<urn:page:1>": "u" * 300_000, "<urn:page:2>": None, "<urn:page:3>": None}
