import gzip
import hashlib
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from pacekit.llm import warc

PAGE = "page_id long, url string, html string"


def pages():
    big = "<p>" + "same text " * 200 + "</p>"
    return [(1, "http://a/1", big), (9, "http://a/9", big), (5, "http://a/5", big), (2, "http://a/2", "short"), (3, None, "short"), (4, "http://x/\r\nWARC/1.1 é", None),
            (6, "http://a/6", ""), (7, "u", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 30), (8, "u", "é漢" * 2000), (8, "u", "é漢" * 2000),
            (10, "u", big + "!"), (None, "u", "no id " * 300)]


def flat(spark, rows):
    return warc.write_archives(spark, spark.createDataFrame(rows, PAGE).coalesce(1))


@pytest.mark.parametrize("compress", [True, False])
def test_round_trip(spark, compress):
    manifest = warc.write_archives(spark, spark.createDataFrame(pages(), PAGE), compress=compress)
    got = warc.read_archives(manifest).collect()
    assert all(r["kind"] == "record" for r in got)
    by_id = {r["record_id"]: r["key"] for r in got if r["record_type"] == "response"}
    found = sorted(((r["key"], r["payload_bytes"], r["payload_digest"], r["record_type"], by_id.get(r["refers_to"])) for r in got), key=str)
    expected = []
    for key, _, html in pages():
        data = (html or "").encode()
        chief = max((k for k, _, h in pages() if h == html and k is not None), default=None)
        revisit = len(data) >= 1000 and chief is not None and chief != key
        expected.append((key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", chief if revisit else None))
    assert found == sorted(expected, key=str)
    payloads = {r["key"]: r["payload"] for r in got if r["record_type"] == "response"}
    assert all(payloads[k] == (h or "").encode() for k, _, h in pages() if k in payloads)
    assert manifest.agg(F.sum("records")).first()[0] == len(pages())


def test_empty_table(spark):
    manifest = warc.write_archives(spark, spark.createDataFrame([], PAGE))
    assert manifest.count() == 0 and warc.read_archives(manifest).count() == 0


def records(n=40):
    rng = random.Random(n)
    return [warc.record(i, f"http://h/{i}", rng.randbytes(rng.randint(0, 3000)), None, False) for i in range(n)]


def salvaged(data, gz):
    out = list(warc.salvage(io.BytesIO(data), gz))
    spans = [(s, e) for s, e, _, _ in out]
    assert spans == sorted(spans) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))      # every byte once
    if data:
        assert spans[0][0] == 0 and spans[-1][1] == len(data)
    return [int(h["x-page-id"]) for _, _, h, _ in out if not isinstance(h, str)], [(s, e, h) for s, e, h, _ in out if isinstance(h, str)]


@pytest.mark.parametrize("gz", [True, False])
@pytest.mark.parametrize("harm", ["none", "flip", "cut", "junk", "zero", "head"])
def test_salvage_recovers_later_records(gz, harm):
    parts = [gzip.compress(r, mtime=0) if gz else r for r in records()]
    starts = [sum(map(len, parts[:i])) for i in range(len(parts) + 1)]
    data, lost = bytearray(b"".join(parts)), set()
    if harm == "flip":
        lost = {3, 17, 39}
        for i in lost:
            data[(starts[i] + starts[i + 1]) // 2 + 20] ^= 0xFF
    if harm == "zero":
        lost = {5, 6}
        data[starts[5] + 4:starts[7]] = bytes(starts[7] - starts[5] - 4)
    if harm == "head":
        lost = {0}
        data[0:8] = b"\x00" * 8
    if harm == "junk":
        data[starts[10]:starts[10]] = b"junk \x1f\x8b\x08 WARC/1.0\r\nno record here" * 3
    if harm == "cut":
        lost = {38, 39}
        data = data[:starts[38] + 30]
    got, gaps = salvaged(bytes(data), gz)
    assert got == sorted(got)
    assert set(got) == set(range(40)) - lost
    assert bool(gaps) == (harm != "none")
    if harm == "junk":
        assert sum(e - s for s, e, _ in gaps) == len(b"junk \x1f\x8b\x08 WARC/1.0\r\nno record here" * 3)


def test_salvage_with_small_chunks(monkeypatch):
    monkeypatch.setattr(warc, "_CHUNK", 37)
    parts = [gzip.compress(r, mtime=0) for r in records(12)]
    data = b"".join(parts[:5]) + b"x" * 100 + b"".join(parts[5:])
    assert salvaged(data, True)[0] == list(range(12))
    assert salvaged(b"".join(records(12)), False)[0] == list(range(12))
    assert salvaged(b"", True) == ([], []) and salvaged(b"\x1f", True)[0] == []


def test_damaged_file_logs_gaps(spark):
    manifest = flat(spark, [(i, "u", f"page {i} " * 300) for i in range(30)])
    path = manifest.first()["path"]
    with open(path, "r+b") as f:
        data = bytearray(f.read())
        second = data.find(b"\x1f\x8b\x08", 10)
        data[second + 40] ^= 0x55
        f.seek(0)
        f.write(data)
    got = warc.read_archives(manifest).collect()
    gaps = [r for r in got if r["kind"] == "gap"]
    assert len(gaps) == 1 and gaps[0]["start"] == second and gaps[0]["problem"] and len(got) == 30


def test_header_lines_stay_one_line():
    data = warc.record(1, "http://x/\r\nWARC-Type: evil ", b"", None, False)
    assert re.findall(rb"^WARC-Type: (\w+)\r$", data, re.M) == [b"response"]


class Counted(io.BytesIO):
    """A stream that notes how far it was read before each record came out."""
    read_to = 0

    def read(self, n=-1):
        got = super().read(n)
        self.read_to = max(self.read_to, self.tell())
        return got


def test_a_wrong_length_does_not_pull_in_the_file():
    parts = records(30)
    parts[4] = re.sub(rb"\r\nContent-Length: \d+", b"\r\nContent-Length: 999999999", parts[4])
    parts[9] = re.sub(rb"\r\nContent-Length: \d+", b"\r\nContent-Length: 20000", parts[9])
    stream, window = Counted(b"".join(parts)), []
    got = []
    for start, stop, h, _ in warc.salvage(stream, False, most=8000):
        window.append(stream.read_to - start)
        got += [int(h["x-page-id"])] if not isinstance(h, str) else []
    assert got == [i for i in range(30) if i not in (4, 9)]
    assert max(window) <= 8000 + 2 * warc._CHUNK


def test_a_member_that_unpacks_to_too_much():
    parts = [gzip.compress(r, mtime=0) for r in records(10)]
    bomb = gzip.compress(warc.record(99, "u", b"a" * 5_000_000, None, False), mtime=0)
    data = b"".join(parts[:4]) + bomb + b"".join(parts[4:])
    out = list(warc.salvage(io.BytesIO(data), True, most=100_000))
    assert [int(h["x-page-id"]) for _, _, h, _ in out if not isinstance(h, str)] == list(range(10))
    assert [(s, e) for s, e, h, _ in out if isinstance(h, str)] == [(len(b"".join(parts[:4])), len(b"".join(parts[:4]) + bomb))]
    assert len(list(warc.salvage(io.BytesIO(data), True))) == 11


def test_members_with_several_records():
    rs = records(9)
    data = gzip.compress(rs[0] + rs[1] + rs[2], mtime=0) + gzip.compress(rs[3] + b"junk" + rs[4], mtime=0) + gzip.compress(rs[5], mtime=0)
    out = list(warc.salvage(io.BytesIO(data), True))
    assert [int(h["x-page-id"]) for _, _, h, _ in out if not isinstance(h, str)] == [0, 1, 2, 3, 5]
    assert [h for _, _, h, _ in out if isinstance(h, str)] == ["no version line"]


def test_records_of_other_writers(spark, tmp_path):
    """Digests in hex, of other algorithms, or none; records that are not HTTP; a wrong digest."""
    body = b"<p>x</p>"
    http = b"HTTP/1.1 200 OK\r\n\r\n" + body
    sha = hashlib.sha1(body).hexdigest()

    def rec(kind, block, *more, http=True):
        head = [b"WARC/1.0", b"WARC-Type: " + kind, b"Content-Type: " + (b"application/http;msgtype=response" if http else b"application/warc-fields"), *more,
                b"Content-Length: %d" % len(block)]
        return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"
    data = (rec(b"warcinfo", b"software: x\r\n\r\n", http=False) + rec(b"response", http) + rec(b"response", http, b"WARC-Payload-Digest: sha1:" + sha.upper().encode())
            + rec(b"response", http, b"WARC-Payload-Digest: md5:abc") + rec(b"response", http, b"WARC-Payload-Digest: sha1:" + b"0" * 40)
            + rec(b"metadata", b"a: b", b"WARC-Block-Digest: sha1:" + hashlib.sha1(b"a: b").hexdigest().encode(), http=False))
    path = tmp_path / "foreign.warc"
    path.write_bytes(data)
    got = warc.read_archives(spark.createDataFrame([(str(path), str(tmp_path))], "path string, base string")).orderBy("start").collect()
    assert [(r["kind"], r["record_type"]) for r in got] == [("record", "warcinfo"), ("record", "response"), ("record", "response"), ("record", "response"),
                                                            ("gap", None), ("record", "metadata")]
    assert [r["payload_digest"] for r in got[1:4]] == [sha] * 3 and got[4]["problem"] == "payload digest differs"
    assert bytes(got[0]["payload"]) == b"software: x\r\n\r\n" and all(r["key"] is None for r in got)
