import gzip
import hashlib
import os
import zlib
from urllib.parse import urlparse

import duckdb
import pytest
from pyspark.sql import functions as F

from privlink.llm import queries, warc

from .conftest import SF

LONG = "é" * 60


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, record string, digest string, size string")


def row(i, html, url="http://a/"):
    return (i, url, html, "record", "digest", "size")


def round_trip(spark, workdir, pages, **kw):
    raw, out = f"{workdir}/raw", f"{workdir}/out"
    warc.write_monolithic(warc.page_records(pages), raw, **kw)
    index = warc.normalise(spark, raw, out)
    return raw, out, index


def files(folder, end):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(urlparse(folder).path) for f in names if f.endswith(end) and not f.startswith("."))


def brute(rows):
    """(page_id, payload bytes, digest, type, refers_to) by the contract."""
    first = {}
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(i, first.get(data, i))
    out = []
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        revisit = data in first and first[data] != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first[data] if revisit else None))
    return sorted(out, key=str)


ROWS = [row(5, LONG), row(2, LONG), row(9, LONG), row(3, "short"), row(4, "short"), row(6, None), row(7, "", None), row(8, "a\r\n\r\nb\r\n\r\n" * 30, "http://x/\r\nEvil: 1"), row(10, "WARC/1.1\r\n\r\n\x00" * 20), row(11, LONG), row(11, LONG), row(None, LONG), row(None, "z" * 200), row(12, "日本😀" * 50)]


def test_round_trip_of_odd_rows(spark, workdir):
    raw, out, index = round_trip(spark, workdir, pages_of(spark, ROWS).repartition(3), most=600)
    got = warc.read_archives(spark, out).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(ROWS)
    assert "http://x/%20%20Evil:%201" in {r.url for r in got}


def test_files_and_archives_are_closed_by_bytes(spark, workdir):
    pages = [row(i, chr(97 + i % 26) * (40_000 if i % 9 == 4 else 300)) for i in range(40)]
    raw, out = f"{workdir}/raw", f"{workdir}/out"
    warc.write_monolithic(warc.page_records(pages_of(spark, pages).coalesce(1)), raw, most=2_000)
    sizes = [len(gzip.open(f).read()) for f in files(raw, ".gz")]
    assert len(sizes) > 5 and max(sizes) < 43_000  # a long page closes the file that it is in
    warc.normalise(spark, raw, out, most=500)
    archives = files(f"{out}/archives", ".txt")
    assert len(archives) > len(sizes) and max(map(os.path.getsize, archives)) < 1_200
    got = warc.read_archives(spark, out).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(pages)
    assert len({r.archive for r in got}) == len(archives)


def test_every_record_is_a_member_and_the_index_points_to_it(spark, workdir):
    raw, out, index = round_trip(spark, workdir, pages_of(spark, ROWS).coalesce(1))
    assert all(gzip.open(f).read().startswith(b"WARC/1.1\r\n") for f in files(raw, ".gz"))
    (archive,) = files(f"{out}/archives", ".txt")
    data = open(archive, "rb").read()
    spots = sorted((r.offset, r.length) for r in index.collect())
    assert len(spots) == len(ROWS) and spots[0][0] == 0
    assert all(a + n == b for (a, n), (b, _) in zip(spots, spots[1:], strict=False))
    for a, n in spots:
        stream = zlib.decompressobj(31)
        record = stream.decompress(data[a : a + n])
        assert stream.eof and not stream.unused_data
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
    assert sum(n for _, n in spots) == len(data)
    some = index.where(F.col("record_type") == "response").where("record_id in ('<urn:page:3>', '<urn:page:12>')")
    assert {r.page_id: bytes(r.payload).decode() for r in warc.read_at(spark, out, some).collect()} == {3: "short", 12: "日本😀" * 50}
    bodies = {r.page_id: r.payload for r in warc.read_archives(spark, out, payloads=True).collect()}
    assert bodies[9] is None and bytes(bodies[2]).decode() == LONG


def test_record_over_16_mb_keeps_the_archive_whole(spark, workdir):
    big = [row(1, "x" * (17 << 20)), row(2, "y")]
    raw, out, index = round_trip(spark, workdir, pages_of(spark, big).coalesce(1))
    got = {r.page_id: r.payload_bytes for r in warc.read_archives(spark, out).collect()}
    assert got == {1: 17 << 20, 2: 1}
    assert index.count() == 2


def test_inflates_in_pieces_and_rejects_torn_files():
    records = [warc_record(i, os.urandom(3000).hex()) for i in range(5)]
    for packed in (gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records)), b"".join(map(gzip.compress, records)) + b"\0" * 9):
        for piece in (1, 100, 1 << 20):
            assert list(warc.inflate_records(packed, piece)) == records
    with pytest.raises(ValueError):
        list(warc.inflate_records(gzip.compress(b"".join(records)[:-30])))
    assert list(warc.inflate_records(gzip.compress(b""))) == []


def warc_record(i, body):
    return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n".encode()


def test_empty_table(spark, workdir):
    raw, out, index = round_trip(spark, workdir, pages_of(spark, []))
    assert index.count() == 0
    assert warc.read_archives(spark, out).count() == 0


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = sorted(con.sql(queries.ORACLE["op2_warc_normalise"]).fetchall())
    assert sorted(map(tuple, queries.QUERIES["op2_warc_normalise"](spark, SF).collect())) == want
