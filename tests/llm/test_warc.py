import gzip
import hashlib
import io
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from barlab.llm import warc
from barlab.llm.warc import compressed, members, read_warc, record_bytes, write_warc

SCHEMA = "page_id long, url string, html string, path string, start string, sha string, key string, n string"
BIG = "<html>" + "grüße " * 300 + "</html>"
LONG = "".join(chr(32 + (i * i) % 90) for i in range(3_000_000))


def page_rows():
    extra = ("x",) * 5
    return [(r[0], r[1], r[2], *extra) for r in [
        (1, "http://a/1", BIG), (7, "http://a/7 with blank\n", BIG), (3, None, BIG), (None, "http://none", BIG),
        (4, "http://a/4", None), (5, "http://a/5", ""), (6, "http://é/6", "short"), (8, "u", "short"), (9, "u", LONG),
        (10, "u", "x" * 999), (11, "u", "x" * 999), (12, "u", "y" * 1000), (13, "u", "y" * 1000), (13, "v", "y" * 1000),
        (None, "u", "z" * 2000), (None, "u", "z" * 2000), (14, "u", "é" * 500), (15, "u", "é" * 500)]]


def brute(rows, least=1000):
    groups = defaultdict(list)
    for page, _, html, *_ in rows:
        groups[html or ""].append(page)
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        known = [p for p in groups[html or ""] if p is not None]
        best = max(known) if known and len(data) >= least else None
        revisit = best is not None and page != best
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    best if revisit else None))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


def answers(records):
    got = records.filter(F.col("warc_type") != "warcinfo").collect()
    assert all(r["sound"] for r in got)
    return sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["warc_type"], r["refers_to_page"]) for r in got],
                  key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("range_bytes", [300, 8 << 20])
def test_round_trip(spark, range_bytes):
    rows = page_rows()
    archives = write_warc(spark.createDataFrame(rows, SCHEMA).repartition(3), archive_bytes=4_000).cache()
    assert archives.count() > 3
    records = read_warc(spark, archives, range_bytes=range_bytes)
    assert answers(records) == brute(rows)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in records.filter("warc_type = 'response'").collect()}
    assert payloads[9] == LONG.encode() and payloads[4] == b"" and payloads[7] == BIG.encode()


def test_archives_are_plain_gzip_and_records_named_once(spark):
    rows = page_rows()
    got = [r.asDict() for r in write_warc(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()]
    for a in got:
        fs, at = warc.file_system(a["path"])
        data = fs.open_input_file(at).read()
        assert len(data) == a["bytes"] and gzip.decompress(data).count(b"WARC-Record-ID") == a["records"]


def test_copies_above_the_broadcast_bound_are_joined(spark, monkeypatch):
    monkeypatch.setattr(warc, "small_join", lambda left, right, on, how: left.join(right, on, how))
    rows = page_rows()
    assert answers(read_warc(spark, write_warc(spark.createDataFrame(rows, SCHEMA)))) == brute(rows)


def test_empty(spark):
    archives = write_warc(spark.createDataFrame([], SCHEMA))
    assert archives.count() == 0 and read_warc(spark, archives).count() == 0


def test_every_cut_gives_each_record_once():
    dice = random.Random(5)
    records = [record_bytes("response", [("WARC-Record-ID", f"<{i}>")], dice.randbytes(dice.randrange(1, 3000)))
               for i in range(30)]
    data = b"noise\x1f\x8b\x08" + b"".join(map(compressed, records)) + gzip.compress(b"no record")
    starts = [o for o, _, _ in members(io.BytesIO(data), 0, len(data))]
    assert [d for _, _, d in members(io.BytesIO(data), 0, len(data))] == records
    for step in (1 << 10, 777, 5_000):
        found = [m for a in range(0, len(data), step) for m in members(io.BytesIO(data), a, min(len(data), a + step))]
        assert [o for o, _, _ in found] == starts and [d for _, _, d in found] == records


def test_magic_inside_compressed_bytes_is_no_record():
    inner = compressed(record_bytes("response", [], b"inner"))
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    plain = stored.compress(inner * 3) + stored.flush()
    assert plain.find(warc.MAGIC, 1) > 0
    outer = compressed(record_bytes("resource", [], inner * 3 + random.Random(1).randbytes(5000)))
    for a in range(0, len(outer), 100):
        found = list(members(io.BytesIO(outer), a, len(outer)))
        assert [o for o, _, _ in found] == ([0] if a == 0 else [])


def test_cut_off_or_damaged_members_are_left_out():
    good = [compressed(record_bytes("response", [("WARC-Record-ID", f"<{i}>")], b"body" * i)) for i in range(1, 5)]
    broken = bytearray(good[1])
    broken[-6] ^= 1  # the checksum
    data = good[0] + bytes(broken) + good[2] + good[3][:-3]
    assert [o for o, _, _ in members(io.BytesIO(data), 0, len(data))] == [0, len(good[0]) + len(broken)]


def test_headers_that_lie(spark):
    wrong = record_bytes("response", [("WARC-Payload-Digest", "sha1:" + "A" * 32), ("Content-Type", "application/http")],
                         b"HTTP/1.1 200 OK\r\n\r\nbody")
    row = warc.record_row("p", 0, 1, wrong)
    assert row[9] == hashlib.sha1(b"body").hexdigest() and row[12] is False
    assert warc.record_row("p", 0, 1, b"WARC/1.1\r\nContent-Length: 99\r\n\r\nshort")[12] is False
