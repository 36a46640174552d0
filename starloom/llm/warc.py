"""WARC archives: written from pages, and read back with segment reassembly.

Writing.  Each page becomes an HTTP response with a chunked body.  Records longer than ``SEGMENT`` bytes are
segmented: a first record (WARC-Segment-Number 1) and continuation records that name it in
WARC-Segment-Origin-ID, the last with WARC-Segment-Total-Length.  Of pages with equal payloads of at least
``LEAST`` bytes the one with the largest page_id is a response, the others are revisit records that refer to it.
Records are the rows of Spark's text sink with two CRLFs as line separator, so every part file, gzip-compressed,
is an archive; files hold a bounded number of records.

Reading.  Archives, of this writer or others, plain or gzip (one member or one per record), are parsed record by record by
Content-Length.  Segments are grouped by origin identifier and ordered by number; numbers must run from 1 and the length must
equal the stated total.  The chunked framing is decoded and the payload compared with its digest (any hash that Python
has, hexadecimal or base32).  Records of all types come back, one row each; what is wrong with one is in its
``error`` and ends neither the job nor the archive: a record cut short, bytes that no record claims, a missing segment, a payload that
is not what its digest says.  A record that occurs several times (an archive given twice) comes back as often.  An archive's compressed
bytes are held by one task, its uncompressed ones piece by piece.

Null html counts as empty, a null url is left out, a page without page_id is a response.  Repeated rows are records of
their own (record identifiers come from the row).  Rows of equal payload and equal largest page_id are all responses; a revisit
names the record identifier of one of them.  ``pages`` is read twice: give a stored table.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._tables import store

LEAST = 1000
SEGMENT = 16_384
CHUNK = 4096
RECORDS_PER_FILE = 2_000
CRLF = "\r\n"


def plan(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, size, refers_to, row, main_row): which record each page becomes."""
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).alias("html"), F.sha1(body).alias("digest"),
                        F.octet_length(body).cast("long").alias("size"), F.monotonically_increasing_id().alias("row"))
    # payloads that occur once need no look-up; the table of the others is written, so both sides of the join
    # are plain exchanges that AQE can split when one payload is very common
    first = store(base.filter(F.col("size") >= LEAST).groupBy("digest", "size")
                  .agg(F.max("page_id").alias("main"), F.max_by("row", "page_id").alias("main_row"), F.count(F.lit(1)).alias("n"))
                  .filter("n > 1 and main is not null").select("digest", "size", "main", "main_row"), "warc-payloads")
    revisit = F.col("page_id") < F.col("main")  # null where either is: a response
    return (base.join(first, ["digest", "size"], "left")
            .select("page_id", "url", "html", "digest", "size", F.when(revisit, F.col("main")).alias("refers_to"),
                    "row", "main_row"))


def _pieces(text: str, most: int) -> list[str]:
    """Cut at code points into pieces of at most ``most`` bytes (4 at least)."""
    raw, out, a = text.encode(), [], 0
    while a < len(raw):
        b = min(len(raw), a + most)
        while b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        out.append(raw[a:b].decode())
        a = b
    return out


def _chunked(body: str) -> str:
    return "".join(f"{len(p.encode()):x}{CRLF}{p}{CRLF}" for p in _pieces(body, CHUNK)) + f"0{CRLF}{CRLF}"


def _record(fields: list[tuple[str, str]], block: str) -> str:
    fields = [*fields, ("Content-Length", str(len(block.encode())))]
    return "WARC/1.1" + CRLF + "".join(f"{k}: {v}{CRLF}" for k, v in fields) + CRLF + block


def records(page_id: int | None, url: str | None, html: str, digest: str, refers_to: int | None, name: str,
            main: str | None = None) -> list[str]:
    """The WARC records of a page, without the two CRLFs that end each; ``name`` and ``main`` are the UUIDs of its record and of
    the one that a revisit refers to."""
    ident = f"<urn:uuid:{name}>"
    common = [("WARC-Record-ID", ident), ("WARC-Date", "2020-01-01T00:00:00Z")]
    if url is not None:
        common.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~-._")))
    if page_id is not None:
        common.append(("X-Page-Id", str(page_id)))
    common += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    head = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
    if refers_to is not None:
        return [_record([("WARC-Type", "revisit"), *common, ("WARC-Refers-To", f"<urn:uuid:{main}>"),
                         ("X-Refers-To-Page-Id", str(refers_to)),
                         ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")],
                        f"{head}Content-Length: {len(html.encode())}{CRLF}{CRLF}")]
    block = f"{head}Transfer-Encoding: chunked{CRLF}{CRLF}{_chunked(html)}"
    pieces = _pieces(block, SEGMENT)
    if len(pieces) == 1:
        return [_record([("WARC-Type", "response"), *common], block)]
    out = [_record([("WARC-Type", "response"), *common, ("WARC-Segment-Number", "1")], pieces[0])]
    for k, piece in enumerate(pieces[1:], 2):
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.UUID(name), str(k))}>"),
                ("WARC-Date", "2020-01-01T00:00:00Z"), ("WARC-Segment-Origin-ID", ident), ("WARC-Segment-Number", str(k))]
        if k == len(pieces):
            more.append(("WARC-Segment-Total-Length", str(len(block.encode()))))
        out.append(_record(more, piece))
    return out


def write(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write archives of ``pages`` into folder ``path``."""
    planned = plan(pages)
    space = uuid.uuid4()  # record identifiers are new in each archive

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[str] = []
            size = 0
            for r in range(batch.num_rows):
                page_id, url, html, digest, _, refers, row, main = (c[r].as_py() for c in batch.columns)
                new = records(page_id, url, html, digest, refers, str(uuid.uuid5(space, str(row))),
                              None if refers is None else str(uuid.uuid5(space, str(main))))
                out += new
                size += sum(map(len, new))
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    (planned.mapInArrow(run, "value string").write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


GZIP = b"\x1f\x8b\x08"
PIECE = 1 << 16
HEADER = 1 << 20  # bytes of a record's header at most; more means that it is none


def inflate(raw: bytes) -> Iterator[bytes | None]:
    """Uncompressed pieces of an archive; None where compressed bytes are damaged or end too early."""
    view, at = memoryview(raw), 0
    if raw[:2] != GZIP[:2]:
        for a in range(0, len(raw), PIECE):
            yield bytes(view[a:a + PIECE])
        return
    while at < len(raw):
        if raw[at:at + 3] != GZIP:  # zeros may fill an archive up; anything else belongs to no member
            member = raw.find(GZIP, at)
            member = len(raw) if member < 0 else member
            if bytes(view[at:member]).strip(b"\0"):
                yield None
            at = member
            continue
        member, z, feed = at, zlib.decompressobj(31), b""
        try:
            while not z.eof:
                if not feed:
                    feed = bytes(view[at:at + PIECE])
                    at += len(feed)
                out = z.decompress(feed, PIECE)
                if out:
                    yield out
                elif not feed:  # the end, and nothing is left inside
                    yield None
                    return
                feed = z.unconsumed_tail
            at -= len(z.unused_data)
        except zlib.error:
            yield None
            at = raw.find(GZIP, member + 1)
            if at < 0:
                return


Fields = dict[str, str]


class _Records:
    """The records of an archive whose uncompressed bytes come piece by piece."""

    def __init__(self, raw: bytes):
        self.pieces, self.buf, self.gap, self.done = inflate(raw), bytearray(), False, False

    def more(self) -> bool:
        """One piece more, unless the bytes at hand end in a gap or with the archive."""
        if self.gap or self.done:
            return False
        piece = next(self.pieces, b"")
        if piece is None:
            self.gap = True
        elif piece:
            self.buf += piece
            return True
        else:
            self.done = True
        return False

    def until(self, what: bytes, start: int, most: int | None = None) -> int:
        """Where ``what`` stands next; -1 if it does not (within ``most`` bytes)."""
        while True:
            at = self.buf.find(what, start)
            if at >= 0 or (most is not None and len(self.buf) > most):
                return at
            start = max(start, len(self.buf) - len(what) + 1)
            if not self.more():
                return -1

    def skip(self) -> None:
        """Go on with what looks like the next record."""
        while (at := self.buf.find(b"\nWARC/", 1)) < 0:
            del self.buf[:max(0, len(self.buf) - 5)]
            if not self.more():
                self.buf.clear()
                return
        del self.buf[:at + 1]

    def __iter__(self) -> Iterator[tuple[Fields, bytes, str | None]]:
        while True:
            while len(self.buf) < 5 and self.more():
                pass
            while self.buf[:1] in (b"\r", b"\n"):
                del self.buf[:len(self.buf) - len(self.buf.lstrip(b"\r\n"))]
                while len(self.buf) < 5 and self.more():
                    pass
            if not self.buf:
                if self.gap:
                    yield {}, b"", "damaged bytes"
                    self.gap = False
                    continue
                return
            yield self.one()

    def one(self) -> tuple[Fields, bytes, str | None]:
        end = self.until(b"\r\n\r\n", 0, HEADER) if self.buf[:5] == b"WARC/" else -1
        if end < 0:
            start = self.buf[:5] == b"WARC/"
            self.skip()
            return {}, b"", "header cut short" if start and not self.buf else "bytes outside of records"
        lines = bytes(self.buf[:end]).decode("utf-8", "replace").split(CRLF)[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = fields.get("content-length", "")
        if not (length.isascii() and length.isdigit()):
            self.skip()
            return fields, b"", "no length"
        stop = end + 4 + int(length)
        while len(self.buf) < stop + 2 and self.more():
            pass
        block = bytes(self.buf[end + 4:stop])
        if len(block) < int(length):
            self.buf.clear()
            return fields, block, "cut short"
        after = bytes(self.buf[stop:stop + 2])
        if after not in (b"", CRLF.encode()):
            self.skip()
            return fields, block, "does not end after its length"
        del self.buf[:stop]
        return fields, block, None


def parse(raw: bytes) -> Iterator[tuple[Fields, bytes, str | None]]:
    """(header fields, block, what is wrong) of each record of an archive, compressed or not."""
    return iter(_Records(raw))


def dechunk(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        n = int(body[at:line].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        at = line + 2
        if n < 0 or body[at + n:at + n + 2] != b"\r\n":
            raise ValueError("a chunk does not end after its length")
        out.append(body[at:at + n])
        at += n + 2


def digest_hex(stated: str | None) -> tuple[str, str] | None:
    """(hash name, lower-case hexadecimal value) of a digest field such as ``sha1:...``; None if it is not understood."""
    name, _, value = (stated or "").partition(":")
    name = name.strip().lower().replace("-", "")
    if name not in hashlib.algorithms_guaranteed or name.startswith("shake"):
        return None
    size = hashlib.new(name).digest_size
    try:
        if len(value) == 2 * size:
            return name, bytes.fromhex(value).hex()
        raw = base64.b32decode(value.upper() + "=" * (-len(value) % 8))
        return (name, raw.hex()) if len(raw) == size else None
    except (ValueError, binascii.Error):
        return None


_FIELDS = [("origin", "string"), ("record_id", "string"), ("number", "int"), ("total", "long"), ("type", "string"), ("page_id", "long"),
           ("url", "string"), ("digest", "string"), ("refers_to", "long"), ("refers_to_id", "string"), ("content_type", "string"),
           ("block", "binary"), ("error", "string")]
SEGMENTS = ", ".join(f"{n} {t}" for n, t in _FIELDS) + ", segmented boolean"
_ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _number(text: str | None, most: int = (1 << 63) - 1) -> int | None:
    return int(text) if text and text.isascii() and text.isdigit() and int(text) <= most else None


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record of all archives in ``path``, and per damaged stretch."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    names, kinds = [*(n for n, _ in _FIELDS), "segmented"], [*(_ARROW[t] for _, t in _FIELDS), pa.bool_()]

    def row(f: Fields, block: bytes, error: str | None) -> tuple:
        number = f.get("warc-segment-number")
        k = _number(number or "1", (1 << 31) - 1)
        if k is None:
            error = error or "segment number is none"
        ident, kind = f.get("warc-record-id"), f.get("warc-type", "").lower() or None
        if f and (ident is None or kind is None):
            error = error or "no identifier or type"
        return (f.get("warc-segment-origin-id", ident), ident, k, _number(f.get("warc-segment-total-length")), kind,
                _number(f.get("x-page-id")), f.get("warc-target-uri"), f.get("warc-payload-digest"),
                _number(f.get("x-refers-to-page-id")), f.get("warc-refers-to"), f.get("content-type"), block, error,
                number is not None and error is None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        for batch in batches:
            for content in batch.column("content"):
                rows: list[tuple] = []
                size = 0
                for record in parse(content.as_buffer().to_pybytes()):
                    rows.append(row(*record))
                    size += len(record[1])
                    if size > 4 << 20:
                        yield out(rows)
                        rows, size = [], 0
                if rows:
                    yield out(rows)

    return files.mapInArrow(run, SEGMENTS)


def reassemble(segments: DataFrame) -> DataFrame:
    """Whole records.  Only segmented ones are shuffled; a record's segments are as large as that record.  Equal segments count
    once in a record and are counted, so a record whose first segment occurs k times comes back k times."""
    alone = segments.filter(~F.col("segmented")).drop("segmented")
    head = lambda c: F.max(F.when(F.col("number") == 1, F.col(c))).alias(c)
    part = F.sort_array(F.collect_set(F.struct("number", "block")))
    carried = [n for n, _ in _FIELDS if n not in ("origin", "number", "total", "block", "error")]
    whole = (segments.filter("segmented").groupBy("origin")
             .agg(part.alias("parts"), F.max("total").alias("total"), F.max("number").alias("number"),
                  F.count(F.when(F.col("number") == 1, 1)).alias("copies"), *[head(c) for c in carried]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                parts, total = batch.column("parts")[r].as_py(), batch.column("total")[r].as_py()
                block, error = b"".join(p["block"] for p in parts), None
                if [p["number"] for p in parts] != list(range(1, len(parts) + 1)) or total != len(block):
                    block, error = None, "segments missing or of wrong length"
                one = {"block": pa.array([block], pa.binary()), "error": pa.array([error], pa.string())}
                out = pa.RecordBatch.from_arrays([one[n] if n in one else batch.column(n).slice(r, 1) for n, _ in _FIELDS],
                                                 names=[n for n, _ in _FIELDS])
                for _ in range(max(1, batch.column("copies")[r].as_py())):
                    yield out

    return alone.unionByName(whole.mapInArrow(run, alone.schema))


def payload_of(kind: str | None, content_type: str | None, digest: str | None, block: bytes) -> tuple[int | None, str | None, bytes | None, str | None]:
    """(bytes, SHA-1 in hexadecimal, payload, what is wrong) of a whole record.

    The payload of an HTTP message is its body, decoded if it is chunked; of other records it is the block.  A revisit holds no
    payload: its length and digest are those it states (a digest by another hash than SHA-1 is left out).
    """
    stated = digest_hex(digest)
    fields: dict[bytes, bytes] = {}
    data, raw, error = block, block, None
    if (content_type or "").lower().replace(" ", "").startswith("application/http") or (kind == "revisit" and block[:5] == b"HTTP/"):
        head, found, raw = block.partition(b"\r\n\r\n")
        if not found and kind != "revisit":
            error = "no end of the HTTP header"
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
        data = raw
    if kind == "revisit":
        length = fields.get(b"content-length", b"").decode("latin-1")
        return _number(length), stated[1] if stated and stated[0] == "sha1" else None, None, error
    if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
        try:
            data = dechunk(raw)
        except ValueError:  # some crawlers store the decoded body and keep the field: right if the digest says so
            if stated is None or hashlib.new(stated[0], raw).hexdigest() != stated[1]:
                error = error or "bad chunked framing"
    sha = hashlib.sha1(data).hexdigest()
    if digest and stated is None:
        error = error or "digest not understood"
    elif stated is not None and stated != ("sha1", sha):
        # some state the digest of the body as it was sent
        if stated[1] not in (hashlib.new(stated[0], data).hexdigest(), hashlib.new(stated[0], raw).hexdigest()):
            error = error or "payload digest differs"
    return len(data), sha, data, error


def payloads(records: DataFrame) -> DataFrame:
    """(record_id, page_id, url, record_type, refers_to, refers_to_id, payload_bytes, payload_digest, payload, error) of whole
    records (``payload_of``); records found to be wrong before have no payload columns."""
    types = (pa.int64(), pa.string(), pa.binary(), pa.string())
    kept = ["record_id", "page_id", "url", "type", "refers_to", "refers_to_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {c: batch.column(c) for c in ("type", "content_type", "digest", "block", "error")}
            out = []
            for r in range(batch.num_rows):
                kind, content_type, digest, block, error = (c[r].as_py() for c in col.values())
                out.append((None, None, None, error) if error is not None else payload_of(kind, content_type, digest, block))
            done = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *done],
                names=["record_id", "page_id", "url", "record_type", "refers_to", "refers_to_id", "payload_bytes", "payload_digest",
                       "payload", "error"])

    return records.mapInArrow(run, "record_id string, page_id long, url string, record_type string, refers_to long, refers_to_id string, "
                                   "payload_bytes long, payload_digest string, payload binary, error string")


def read(spark: SparkSession, path: str) -> DataFrame:
    return payloads(reassemble(read_segments(spark, path)))
