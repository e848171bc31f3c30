"""Web archives: writing WARC files as tasks and reading damaged ones back.

Writing: of records with equal payloads, found by an aggregation over their digests, the one with
the largest id is stored whole and the others become revisit records that refer to it. Every task
writes its rows to files of its own, each record a gzip member, under the shared folder; a file
counts only once it is in the manifest that the finished task returns, so a task that is run again
leaves no half-written file in the result.

Reading salvages: a member is checked (its gzip CRC, the WARC header, the block's length and
digest); after a failed check the reader searches for the next member, or in a plain file the
next version line, that passes, reads on from there, and logs the bytes between as a quarantined
gap. Files are read as streams with a bounded window: a record that claims more than ``most`` bytes, or a
member that unpacks to more, is quarantined and the search goes on inside it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored

VERSION = b"WARC/1.1"
_MAGIC = b"\x1f\x8b\x08"
_CHUNK = 1 << 16
_MOST = 128 << 20                       # bytes of a record, or of an unpacked member, that the reader holds
_HEADER = re.compile(rb"WARC/1\.\d+(\r\n([!-9;-~]+:|[ \t])[^\r\n]*)*")
_EPOCH = b"1970-01-01T00:00:00Z"
MANIFEST = "path string, bytes long, records long"
RECORDS = ("path string, start long, stop long, kind string, record_type string, record_id string, key long, uri string, "
           "payload_bytes long, payload_digest string, refers_to string, payload binary, problem string")


def _filesystem(uri: str):
    """The store of a shared folder, as tasks reach it, and the folder's path there."""
    from pyarrow import fs
    if re.match(r"[a-z][a-z0-9+.-]*:", uri) and not uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), re.sub(r"^file:(//(?=/))?", "", uri)


def _record_id(key: int | None, payload: bytes) -> bytes:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{key}:{hashlib.sha1(payload).hexdigest()}')}".encode()


def _line(value: str) -> bytes:
    """A header value on one line: control characters and line ends are percent-encoded."""
    return re.sub("[\\x00-\\x1f\\x7f-\\x9f\\u2028\\u2029]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), value).encode()


def record(key: int | None, uri: str, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit keeps the HTTP header (with the length) but not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload

    def sha1(data: bytes) -> bytes:
        return b"sha1:" + base64.b32encode(hashlib.sha1(data).digest())
    head = [VERSION, b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Record-ID: <%s>" % _record_id(key, payload),
            b"WARC-Date: " + _EPOCH, b"WARC-Target-URI: " + _line(uri), b"Content-Type: application/http; msgtype=response",
            b"WARC-Block-Digest: " + sha1(block), b"WARC-Payload-Digest: " + sha1(payload)]
    if key is not None:
        head.append(b"X-Page-Id: %d" % key)
    if revisit:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 b"WARC-Refers-To: <%s>" % _record_id(refers_to, payload)]
    head.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least_bytes: int = 1000, file_bytes: int = 32 << 20, compress: bool = True,
                   harm: Callable[[int | None, bytes], bytes] | None = None) -> DataFrame:
    """Write a record per row of ``pages`` below the shared folder; gives the manifest
    ``(path, bytes, records)`` of the files.

    Null html is an empty payload and a null url an empty one. Rows whose payloads of
    ``least_bytes`` or more are equal are one group: those with its largest id are responses
    (repeated rows all), the others revisits; a group without ids is all responses. An empty table
    gives no files. ``harm`` may change a record's bytes as they are written, to try the reader.
    """
    base = scratch_path(spark, f"warc/{uuid.uuid4().hex}")
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("key"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("uri"),
                        payload.alias("payload"), F.octet_length(payload).alias("size"),
                        F.sha1(payload).alias("digest"), F.crc32(payload).alias("crc"))
    large = F.col("size") >= least_bytes
    same = (rows.where(large).groupBy("digest", "crc", "size").agg(F.max("key").alias("chief"), F.count(F.lit(1)).alias("n"))
                .where("n > 1 AND chief IS NOT NULL").select("digest", "crc", "size", "chief"))
    same = stored(same, "equal-payloads")
    marked = rows.join(same, ["digest", "crc", "size"], "left")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, folder = _filesystem(base)
        store.create_dir(folder, recursive=True)
        out = path = None
        size = count = 0

        def closed() -> pd.DataFrame:
            out.close()
            return pd.DataFrame({"path": [path], "bytes": [size], "records": [count]})
        for f in frames:
            for key, uri, data, chief in zip(f["key"], f["uri"], f["payload"], f["chief"]):
                key = None if pd.isna(key) else int(key)
                chief = None if pd.isna(chief) else int(chief)
                data = record(key, uri, bytes(data), chief, chief is not None and key != chief)
                if compress:
                    z = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = z.compress(data) + z.flush()
                if harm:
                    data = harm(key, data)
                if out is None:
                    path, size, count = f"{folder}/{uuid.uuid4().hex}.warc" + ".gz" * compress, 0, 0
                    out = store.open_output_stream(path, compression=None)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()
    manifest = marked.select("key", "uri", "payload", "chief").mapInPandas(write, MANIFEST)
    return stored(manifest, "warc-manifest").withColumn("base", F.lit(base))


class _Window:
    """A stream with look-ahead: bytes from ``at`` on, read in chunks and dropped when passed."""

    def __init__(self, stream):
        self.stream, self.at, self.data, self.ended = stream, 0, bytearray(), False

    def more(self) -> bool:
        got = b"" if self.ended else self.stream.read(_CHUNK)
        self.ended = not got
        self.data += got
        return bool(got)

    def peek(self, n: int) -> bytearray:
        while len(self.data) < n and self.more():
            pass
        return self.data[:n]

    def skip(self, n: int) -> None:
        self.peek(n)
        self.at += min(n, len(self.data))
        del self.data[:n]


def _headers(head: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {k.strip().lower().decode("utf-8", "replace"): v.strip().decode("utf-8", "replace") for k, _, v in pairs if k.strip()}


def _sha1_hex(value: str) -> str | None:
    """A SHA-1 header value, in base32 or hex of either case, as lower-case hex; None if it is no such."""
    name, _, digits = value.strip().partition(":")
    if name.lower() != "sha1":
        return None
    if re.fullmatch("[0-9a-fA-F]{40}", digits):
        return digits.lower()
    return base64.b32decode(digits.upper()).hex() if re.fullmatch("[A-Za-z2-7]{32}", digits) else None


def parse_record(data: bytes | bytearray, whole: bool, at: int = 0, most: int = _MOST) -> tuple[dict, bytes, int] | str | None:
    """Headers, block and length of the record that begins at ``at``; the failed check as text;
    None if the data ends before the record does and may go on (``whole`` is false)."""
    if not data.startswith(b"WARC/1.", at):
        return None if not whole and b"WARC/1.".startswith(data[at:at + 7]) else "no version line"
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return "header without end" if whole or len(data) - at > 1 << 20 else None
    if not _HEADER.fullmatch(data, at, end):
        return "bad header line"
    h = _headers(bytes(data[at:end]))
    if not re.fullmatch(r"\d{1,15}", h.get("content-length", "")):
        return "no content length"
    if int(h["content-length"]) > most:
        return "record too long"
    stop = end + 4 + int(h["content-length"])
    if len(data) < stop + 4:
        return "record cut off" if whole else None
    block = bytes(data[end + 4:stop])
    if data[stop:stop + 4] != b"\r\n\r\n":
        return "record without end"
    if _sha1_hex(h.get("warc-block-digest", "")) not in (None, hashlib.sha1(block).hexdigest()):
        return "block digest differs"
    return h, block, stop + 4 - at


def _member(win: _Window, at: int = 0, most: int = _MOST) -> tuple[bytes, int] | str:
    """The unpacked gzip member at offset ``at`` of the window and its end there, or the failed check."""
    z, pos, parts, size = zlib.decompressobj(31), at, [], 0
    win.peek(at + 10)
    if win.data[at:at + 3] != _MAGIC:
        return "no gzip member"
    try:
        while not z.eof:
            if not z.unconsumed_tail and pos >= len(win.data) and not win.more():
                return "member cut off"
            tail = z.unconsumed_tail or win.data[pos:pos + _CHUNK]
            pos = pos if z.unconsumed_tail else min(pos + _CHUNK, len(win.data))
            parts.append(z.decompress(tail, _CHUNK * 16))
            size += len(parts[-1])
            if len(parts) == 1 and len(parts[0]) >= 7 and not parts[0].startswith(b"WARC/1."):
                return "no version line"
            if size > most:
                return "member too long"
    except zlib.error as e:
        return f"gzip: {str(e)[:60]}"
    return b"".join(parts), pos - len(z.unused_data)


def salvage(stream, gz: bool, most: int = _MOST) -> Iterator[tuple[int, int, dict | str, bytes]]:
    """``(start, stop, headers, block)`` of every record that passes its checks, and
    ``(start, stop, failed check, b"")`` of every quarantined gap, in the order of the file. The records of a
    member that holds several share its place; from the first that fails on, the member is a gap."""
    win, gap, why = _Window(stream), None, ""
    mark = _MAGIC if gz else b"WARC/1."
    while win.peek(1):
        found: list[tuple[dict, bytes]] = []
        if gz:
            got = _member(win, 0, most)
            if not isinstance(got, str):
                unpacked, size = got
                at, got = 0, "no version line"
                while at < len(unpacked) and not isinstance(got := parse_record(unpacked, True, at, most), str):
                    found.append(got[:2])
                    at += got[2]
        else:
            while (got := parse_record(win.data, win.ended, 0, most)) is None:
                win.more()
            if not isinstance(got, str):
                found, size = [got[:2]], got[2]
        if found:
            if gap is not None:
                yield gap, win.at, why, b""
                gap = None
            start = win.at
            win.skip(size)
            for headers, block in found:
                yield start, win.at, headers, block
            if isinstance(got, str):
                yield start, win.at, got, b""
            continue
        if gap is None:
            gap, why = win.at, got
        # on to the next place that may begin a record
        win.skip(1)
        while (place := win.data.find(mark)) < 0 and not win.ended:
            win.skip(max(0, len(win.data) - len(mark) + 1))
            win.more()
        win.skip(place if place >= 0 else len(win.data))
    if gap is not None:
        yield gap, win.at, why, b""


def read_archives(manifest: DataFrame, payloads: bool = True, most: int = _MOST) -> DataFrame:
    """Records and gaps of the files of ``manifest(path, base)``: a row each, with its bytes.

    ``kind`` is ``record`` or ``gap``; a gap has only its place and the check that failed. The
    payload is what follows a block's HTTP header, or the whole block of a record that is not HTTP (null
    for revisits, or without ``payloads``); its length and digest are those of the full payload. A record
    whose payload does not match its digest is a gap; a digest is optional, and one that cannot be read (of
    another algorithm) is no failure. Records of other writers may lack any field but the type: their
    key is null. A damaged record never hides later ones; an empty manifest gives no rows.
    """
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def row(path: str, start: int, stop: int, h, block: bytes) -> dict:
        out = dict.fromkeys(names) | {"path": path, "start": start, "stop": stop}
        if isinstance(h, str):
            return out | {"kind": "gap", "problem": h}
        revisit = h.get("warc-type") == "revisit"
        head, _, body = block.partition(b"\r\n\r\n") if revisit or h.get("content-type", "").lower().startswith("application/http") else (b"", b"", block)
        length = len(body)
        if revisit and (m := re.search(rb"\r\ncontent-length:\s*(\d+)", head, re.I)):
            length = int(m[1])
        digest = _sha1_hex(h.get("warc-payload-digest", ""))
        if not revisit:
            own = hashlib.sha1(body).hexdigest()
            if digest not in (None, own):
                return out | {"kind": "gap", "problem": "payload digest differs"}
            digest = own
        key = h.get("x-page-id", "")
        return out | {"kind": "record", "record_type": h.get("warc-type"), "record_id": h.get("warc-record-id", "").strip("<>"),
                      "key": int(key) if re.fullmatch(r"-?\d+", key) else None, "uri": h.get("warc-target-uri"),
                      "payload_bytes": length, "payload_digest": digest, "refers_to": h.get("warc-refers-to", "").strip("<>") or None,
                      "payload": body if payloads and not revisit else None}

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, base in zip(f["path"], f["base"]):
                store, _ = _filesystem(base)
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for found in salvage(stream, path.endswith(".gz"), most):
                        rows.append(row(path, *found))
                        held += len(found[3])
                        if len(rows) >= 2000 or held > 8 << 20:
                            yield pd.DataFrame(rows, columns=names).astype({c: "Int64" for c in ("start", "stop", "key", "payload_bytes")})
                            rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names).astype({c: "Int64" for c in ("start", "stop", "key", "payload_bytes")})
    files = manifest.select("path", "base")
    return files.repartition(max(1, min(files.count(), 10_000))).mapInPandas(read, RECORDS)
