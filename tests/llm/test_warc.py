import base64
import gzip
import hashlib
import zlib

import pytest

from starledger.llm.queries import op1_warc
from starledger.llm.warc import ID_PREFIX, read_warc, write_warc

SF = "/root/testdata/sf0.001"

COLUMNS = "page_id long, url string, html string, body string, digest string, kept int"


def brute(rows, least=0):
    """What each record must state, one payload at a time."""
    bodies = [(key, (html or "").encode()) for key, _, html, *_ in rows]
    order = lambda key: (key is not None, key)
    out = []
    for key, body in bodies:
        copies = [k for k, other in bodies if other == body]
        kept = max(copies, key=order) if len(body) >= least else key
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        first = key == kept
        out.append((key, len(body), digest, "response" if first else "revisit", None if first else kept))
    return sorted(out, key=str)


def stated(records):
    key = lambda text: int(text.removeprefix(ID_PREFIX)) if text and text != ID_PREFIX else None
    return sorted(
        (
            (key(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, key(r.refers_to))
            for r in records
        ),
        key=str,
    )


def pages(spark, rows):
    return spark.createDataFrame([(*row, "x", "y", 1) for row in rows], COLUMNS)


@pytest.fixture(scope="module")
def rows():
    long = "lång " * 400_000
    return [
        (1, "http://a.com/", "<p>one</p>"),
        (2, "http://a.com/?q=1", "<p>one</p>"),
        (9, None, "<p>one</p>"),
        (3, "http://b.com/\r\nX: y z", ""),
        (4, "http://b.com/é", None),
        (5, "", "\r\n\r\nWARC/1.1\r\n\r\n"),
        (6, "http://c.com/", long),
        (7, "http://c.com/", long),
        (7, "http://c.com/", long),
        (None, "http://d.com/", "<p>one</p>"),
        (None, "http://d.com/", "no key"),
    ]


@pytest.mark.parametrize("least", [0, 11])
def test_states_what_brute_force_does(spark, rows, least):
    docs = pages(spark, rows)
    manifest = write_warc(docs, least_revisit_bytes=least, max_file_bytes=300)
    records = read_warc(manifest, piece_bytes=100).collect()
    assert stated(records) == brute([(*row, None) for row in rows], least)
    assert sum(r.records for r in manifest.collect()) == len(rows)
    for r in records:
        assert r.verified is (True if r.record_type == "response" else None)
        assert (r.payload is None) == (r.record_type == "revisit")
    assert any(r.target_uri == "http://b.com/%0D%0AX:%20y%20z" for r in records)


def test_each_record_is_a_gzip_member(spark, rows):
    records = read_warc(write_warc(pages(spark, rows))).collect()
    for path in {r.path for r in records}:
        data = open(path.removeprefix("file:"), "rb").read()
        offsets = sorted(r.offset for r in records if r.path == path)
        whole = b""
        for start in offsets:
            unpacker = zlib.decompressobj(31)
            member = unpacker.decompress(data[start:])
            assert unpacker.eof and member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n")
            whole += member
        assert whole == gzip.decompress(data)


def test_damage_is_found(spark, tmp_path):
    def member(payload, digest, length=None):
        head = (
            "WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:1>\r\n"
            f"WARC-Payload-Digest: sha1:{digest}\r\nContent-Length: {length or len(payload)}\r\n\r\n"
        )
        return gzip.compress(head.encode() + payload + b"\r\n\r\n")

    def read(*parts):
        file = tmp_path / f"{len(list(tmp_path.iterdir()))}.warc.gz"
        file.write_bytes(b"".join(parts))
        return read_warc(spark.createDataFrame([(str(file),)], "path string")).collect()

    digest = base64.b32encode(hashlib.sha1(b"abc").digest()).decode()
    assert [r.verified for r in read(member(b"abc", digest), member(b"abd", digest))] == [True, False]
    assert read() == []
    for damaged in ([member(b"abc", digest)[:-9]], [member(b"abc", digest, 2)], [member(b"abc", digest, 9)]):
        with pytest.raises(Exception, match="record"):
            read(*damaged)


def test_empty_tables(spark):
    manifest = write_warc(pages(spark, []))
    assert manifest.count() == 0
    assert read_warc(manifest).count() == 0


def test_query_over_a_whole_table(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    got = op1_warc(spark, SF).collect()
    want = brute([(*row, None) for row in table.collect()])
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[f] for f in fields) for r in got), key=str) == want
