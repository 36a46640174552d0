"""Archives that other programs wrote, repeated archives and damaged ones."""

import base64
import gzip
import hashlib
import zlib

import pytest

from starloom.llm import warc


def record(kind, block, ident, *extra, length=None):
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{ident}>"), ("WARC-Date", "2024-05-06T07:08:09Z"), *extra,
              ("Content-Length", len(block) if length is None else length)]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def http(body, *fields):
    return b"HTTP/1.1 200 OK\r\n" + b"".join(f + b"\r\n" for f in fields) + b"\r\n" + body


HTTP = ("Content-Type", "application/http; msgtype=response")
BODY = "<p>Grüße</p>\r\n\r\nWARC/1.0\r\n".encode() * 40
SHA = hashlib.sha1(BODY).digest()
B32 = "sha1:" + base64.b32encode(SHA).decode()
CHUNKED = b"a;x=1\r\n" + BODY[:10] + b"\r\n" + b"%x\r\n" % len(BODY[10:]) + BODY[10:] + b"\r\n0\r\n\r\n"
RECORDS = [
    record("warcinfo", b"software: other\r\n", "info", ("Content-Type", "application/warc-fields")),
    record("request", b"GET / HTTP/1.1\r\nHost: h\r\n\r\n", "req", ("Content-Type", "application/http; msgtype=request")),
    record("response", http(BODY), "b32", ("WARC-Payload-Digest", B32), HTTP),
    record("response", http(BODY), "hex", ("WARC-Payload-Digest", "SHA1:" + SHA.hex().upper()), HTTP),
    record("response", http(BODY), "sha256", ("WARC-Payload-Digest", "sha-256:" + hashlib.sha256(BODY).hexdigest()), HTTP),
    record("response", http(CHUNKED, b"Transfer-Encoding: Chunked"), "chunked", ("WARC-Payload-Digest", B32), HTTP),
    record("response", http(CHUNKED, b"Transfer-Encoding: chunked"), "sent",
           ("WARC-Payload-Digest", "sha1:" + hashlib.sha1(CHUNKED).hexdigest()), HTTP),
    record("response", http(BODY, b"Transfer-Encoding: chunked"), "decoded", ("WARC-Payload-Digest", B32), HTTP),
    record("resource", b"plain", "res", ("Content-Type", "text/plain")),
    record("metadata", b"", "meta", ("Content-Type", "application/warc-fields")),
    record("revisit", http(b"", b"Content-Length: 7"), "rev", ("WARC-Payload-Digest", B32), ("WARC-Refers-To", "<urn:uuid:b32>"), HTTP),
    record("revisit", b"", "bare", ("WARC-Payload-Digest", B32), ("WARC-Refers-To-Target-URI", "http://h/")),
    record("response", http(BODY)[:60], "seg", ("WARC-Segment-Number", 1), ("WARC-Payload-Digest", B32), HTTP),
    record("continuation", http(BODY)[60:], "seg2", ("WARC-Segment-Origin-ID", "<urn:uuid:seg>"), ("WARC-Segment-Number", 2),
           ("WARC-Segment-Total-Length", len(http(BODY)))),
]
FULL = (len(BODY), SHA.hex(), BODY, None)
EXPECTED = {
    "info": (17, hashlib.sha1(b"software: other\r\n").hexdigest(), b"software: other\r\n", None),
    "req": (0, hashlib.sha1(b"").hexdigest(), b"", None),
    **dict.fromkeys(["b32", "hex", "sha256", "chunked", "sent", "decoded", "seg"], FULL),
    "res": (5, hashlib.sha1(b"plain").hexdigest(), b"plain", None), "meta": (0, hashlib.sha1(b"").hexdigest(), b"", None),
    "rev": (7, SHA.hex(), None, None), "bare": (None, SHA.hex(), None, None)}


def rows(spark, path):
    out = []
    for r in warc.read(spark, str(path)).collect():
        body = None if r["payload"] is None else bytes(r["payload"])
        name = None if r["record_id"] is None else r["record_id"].removeprefix("<urn:uuid:").rstrip(">")
        out.append((name, (r["payload_bytes"], r["payload_digest"], body, r["error"])))
    return sorted(out, key=repr)


def test_foreign_records_in_three_forms_of_file(spark, tmp_path):
    (tmp_path / "plain.warc").write_bytes(b"".join(RECORDS))
    (tmp_path / "whole.warc.gz").write_bytes(gzip.compress(b"".join(RECORDS)))
    (tmp_path / "each.warc.gz").write_bytes(b"".join(map(gzip.compress, RECORDS)) + b"\0" * 100)
    assert rows(spark, tmp_path) == sorted([x for x in EXPECTED.items() for _ in range(3)], key=repr)
    got = {r["record_id"]: r for r in warc.read(spark, str(tmp_path)).collect()}
    assert got["<urn:uuid:rev>"]["refers_to_id"] == "<urn:uuid:b32>" and got["<urn:uuid:rev>"]["refers_to"] is None
    assert got["<urn:uuid:info>"]["record_type"] == "warcinfo" and got["<urn:uuid:info>"]["page_id"] is None


def test_one_bad_record_spoils_no_other(spark, tmp_path):
    good = [RECORDS[2], RECORDS[8]]
    wrong = {"differs": record("response", http(b"x"), "differs", ("WARC-Payload-Digest", B32), HTTP),
             "unknown": record("resource", b"x", "unknown", ("WARC-Payload-Digest", "crc:1")),
             "short": record("resource", b"abc", "short", length=2), "nolength": record("resource", b"abc", "nolength", length="x"),
             "frame": record("response", http(b"zz\r\n", b"Transfer-Encoding: chunked"), "frame", HTTP),
             "lost": record("response", b"HTTP", "lost", ("WARC-Segment-Number", 1), HTTP)}
    (tmp_path / "a.warc").write_bytes(good[0] + b"".join(wrong.values()) + b"noise\r\nmore\r\n" + good[1] + RECORDS[3][:-200])
    got = rows(spark, tmp_path)
    whole = [x for x in got if x[1][3] is None]
    assert whole == sorted([("b32", FULL), ("res", EXPECTED["res"])], key=repr)
    errors = {n: v[3] for n, v in got if v[3] is not None}
    assert errors == {"differs": "payload digest differs", "unknown": "digest not understood", "short": "does not end after its length",
                      "nolength": "no length", "frame": "bad chunked framing", "lost": "segments missing or of wrong length",
                      None: "bytes outside of records", "hex": "cut short"}


@pytest.mark.parametrize("cut", [5, 400, -30, -9])
def test_truncated_and_damaged_gzip(cut):
    each = list(map(gzip.compress, [RECORDS[2], RECORDS[8]]))
    names = lambda raw: [(f.get("warc-record-id"), e) for f, _, e in warc.parse(raw)]
    damaged = bytearray(each[0])
    damaged[len(damaged) // 2] ^= 0xFF
    found = names(bytes(damaged) + each[1])
    assert found[-1] == ("<urn:uuid:res>", None) and any(e for _, e in found)
    whole = gzip.compress(b"".join(RECORDS))
    found = names(whole[:cut])
    assert found[-1] == (None, "damaged bytes") and len(found) <= len(RECORDS) + 1
    assert all(e is None for _, e in found[:-2])  # the one before is the record that was cut, unless the cut fell between two


def test_pieces_are_bounded_and_whole():
    data = b"".join(RECORDS[2:4]) * 3_000
    pieces = list(warc.inflate(gzip.compress(data)))
    assert b"".join(pieces) == data and max(map(len, pieces)) <= warc.PIECE
    raw = zlib.compressobj(9, zlib.DEFLATED, 31)
    assert b"".join(warc.inflate(raw.compress(b"\0" * 9_000_000) + raw.flush())) == b"\0" * 9_000_000
    assert sum(1 for _ in warc.parse(gzip.compress(data))) == 6_000
    assert list(warc.parse(b"")) == [] and list(warc.parse(b"\r\n\r\n")) == []


def test_revisits_name_records_of_the_archive_given_twice(spark, tmp_path):
    pages = spark.createDataFrame([(i, None, ("y" if i < 5 else "z") * 1200) for i in (1, 2, 3, 3, 9, 7)], "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages"))
    stored = spark.read.parquet(str(tmp_path / "pages"))
    warc.write(stored, str(tmp_path / "a"))
    one = warc.read(spark, str(tmp_path / "a")).collect()
    pages_of = {r["record_id"]: r["page_id"] for r in one if r["record_type"] == "response"}
    assert sorted(pages_of.values()) == [3, 3, 9]
    revisits = {r["page_id"]: (r["refers_to"], pages_of[r["refers_to_id"]]) for r in one if r["record_type"] == "revisit"}
    assert revisits == {1: (3, 3), 2: (3, 3), 7: (9, 9)}
    twice = spark.read.format("binaryFile").load(str(tmp_path / "a")).collect()
    (tmp_path / "b").mkdir()
    for k, f in enumerate([*twice, *twice]):
        (tmp_path / "b" / f"{k}.warc.gz").write_bytes(bytes(f["content"]))
    assert sorted(map(repr, warc.read(spark, str(tmp_path / "b")).collect())) == sorted([*map(repr, one)] * 2)
