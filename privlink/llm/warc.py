"""WARC archives: writing, normalising monolithic gzip files, reading back.

- :func:`write_monolithic` writes records with Spark's text sink, one gzip stream
  for each file, records separated by the two line ends that close a record.
- :func:`normalise` is the monolithic gzip normaliser: each file's stream is
  inflated once, piece by piece; every record is written as a gzip member of its
  own, and its offset goes to a sidecar index.
- :func:`read_archives` reads normalised archives from end to end,
  :func:`read_at` reads the records that rows of the index point to.

All files are read and written by Spark, so any store that it reaches will do
and a lost task is run again. A file or archive is the unit of work of one task; it is closed once it has
ARCHIVE_BYTES bytes, so it holds at most one record more than that, whatever
the number and length of the pages.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import map_batches, materialise

#: Bytes (not compressed) at which a file of records, or an archive (compressed), is closed.
ARCHIVE_BYTES = 32 << 20
#: Payloads of at least so many bytes may be revisits.
REVISIT_BYTES = 100
_END = b"\r\n\r\n"
_DATE = "2025-01-01T00:00:00Z"


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = REVISIT_BYTES, date: str = _DATE) -> DataFrame:
    """(record string): a WARC record for each page, without its closing line ends.

    Of pages with equal payloads of at least ``min_bytes`` bytes, those of the
    smallest id are responses, the others revisits of it. A null payload is
    empty; a null url leaves out the target URI; rows without an id are never
    the page that others revisit, unless none has one. Repeated rows give
    repeated records.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.octet_length(payload).alias("size"), F.sha2(payload, 256).alias("digest"))
    copies = rows.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
    firsts = materialise(copies.select(F.col("digest").alias("of"), "first"), "warc-firsts")
    said = rows.join(firsts, rows["digest"] == firsts["of"], "left").withColumn("revisit", F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.col("size")), F.lit("\r\n"))
    body = F.when(F.col("revisit"), http).otherwise(F.concat(http, "payload"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name(F.col("id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(F.col("revisit"), F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"), line("WARC-Refers-To", name(F.col("first"))))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length(body)),
        F.lit("\r\n"),
    )
    return said.select(F.concat(head, body).alias("record"))


def write_monolithic(records: DataFrame, path: str, most: int = ARCHIVE_BYTES) -> None:
    """Write records as WARC files that are one gzip stream each, closed at ``most`` bytes."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, size = 0, 0
        for batch in batches:
            files = []
            for n in pc.binary_length(batch.column(0)).to_pylist():
                if size >= most:
                    file, size = file + 1, 0
                files.append(file)
                size += n
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(files, pa.int32())], names=["record", "file"])

    dealt = records.mapInArrow(deal, "record string, file int")
    dealt.write.option("lineSep", _END.decode()).option("compression", "gzip").partitionBy("file").text(path)


def inflate_records(data: bytes, piece: int = 1 << 20) -> Iterator[bytes]:
    """The records of a gzip file (any number of members), closing line ends
    included, without inflating more than a piece and a record at a time."""
    held, need, pos = bytearray(), None, 0
    view = memoryview(data)
    stream = zlib.decompressobj(31)
    while pos < len(view) or stream.unconsumed_tail or stream.unused_data:
        if stream.eof:  # the next member begins where this one ended
            pos -= len(stream.unused_data)
            stream = zlib.decompressobj(31)
            if not any(view[pos : pos + 2]):
                break
            continue
        if stream.unconsumed_tail:
            held += stream.decompress(stream.unconsumed_tail, piece)
        else:
            part = view[pos : pos + piece]
            pos += len(part)
            held += stream.decompress(part, piece)
        while True:
            if need is None:
                # line ends left over between records are skipped
                skip = 0
                while skip < len(held) and held[skip] in b"\r\n":
                    skip += 1
                del held[:skip]
                end = held.find(_END)
                if end < 0:
                    break
                need = end + 4 + int(_headers(bytes(held[: end + 2])).get("content-length", "0")) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if need is not None or held.strip(b"\r\n"):
        raise ValueError("the archive ends within a record")


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def parse_record(record: bytes) -> dict:
    """Type, page id, payload and digest of one record (closing line ends included)."""
    end = record.find(_END) + 4
    head = _headers(record[: end - 2])
    block = record[end : end + int(head["content-length"])]
    cut = block.find(_END) + 4
    http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in block[: cut - 4].split(b"\r\n")[1:])}
    number = lambda uri: int(uri[len("<urn:page:") : -1]) if uri and len(uri) > len("<urn:page:>") else None
    payload = block[cut:] if head["warc-type"] == "response" else None
    said = head["warc-payload-digest"].partition(":")[2]
    digest = said if payload is None else hashlib.sha256(payload).hexdigest()
    if digest != said:
        raise ValueError(f"payload digest of {head['warc-record-id']} is wrong")
    return {
        "page_id": number(head["warc-record-id"]),
        "record_type": head["warc-type"],
        "url": head.get("warc-target-uri"),
        "refers_to": number(head.get("warc-refers-to")),
        "payload_bytes": int(http[b"content-length"]),
        "payload_digest": digest,
        "payload": payload,
    }


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


_INDEX = pa.struct([("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string())])
_FILES = pa.schema([("archive", pa.string()), ("data", pa.binary()), ("entries", pa.list_(_INDEX))])


def _rewrite(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            # a file of Spark's has its name within its folder; k counts the file's archives
            stem, k = "-".join(x.split(".")[0].removeprefix("file=") for x in path.rsplit("/", 2)[1:]), 0
            out, entries = bytearray(), []
            for record in inflate_records(data.as_py()):
                member = _member(record)
                head = _headers(record[: record.find(_END) + 2])
                entries.append({"offset": len(out), "length": len(member), "record_id": head.get("warc-record-id"), "record_type": head.get("warc-type")})
                out += member
                if len(out) >= most:
                    yield _archive(f"{stem}-{k}", out, entries)
                    out, entries, k = bytearray(), [], k + 1
            if entries:
                yield _archive(f"{stem}-{k}", out, entries)


def _archive(name: str, out: bytearray, entries: list[dict]) -> pa.RecordBatch:
    if out[-1]:  # the sink's separator is a zero byte: close with an empty member
        out += _member(b"")
    return pa.RecordBatch.from_pylist([{"archive": name, "data": bytes(out), "entries": entries}], schema=_FILES)


def normalise(spark: SparkSession, path: str, out: str, most: int = ARCHIVE_BYTES) -> DataFrame:
    """Rewrite the gzip WARC files in ``path`` as archives with a member for each
    record under ``out``/archives; returns the sidecar index written to
    ``out``/index: (archive, offset, length, record_id, record_type).

    A file gives an archive, or several where one reaches ``most`` bytes, and none if it
    has no records. A gzip member ends with the high
    byte of its size, zero for records under 16 MB; that byte is left to the
    text sink's separator, which makes it write the archive's bytes as they are.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    kinds = "archive string, data binary, entries array<struct<offset: long, length: long, record_id: string, record_type: string>>"
    done = materialise(files.mapInArrow(lambda it: _rewrite(it, most), kinds), "warc-members")
    raw = done.select("archive", F.expr("substring(data, 1, octet_length(data) - 1)").cast("string").alias("value"))
    raw.write.option("lineSep", "\0").partitionBy("archive").text(f"{out}/archives")
    done.select("archive", F.explode("entries").alias("e")).select("archive", "e.*").write.parquet(f"{out}/index")
    return spark.read.parquet(f"{out}/index")


_RECORD = "archive string, page_id long, record_type string, url string, refers_to long, payload_bytes long, payload_digest string"


def _archive_name(path: Column) -> Column:
    return F.regexp_extract(path, r"archive=([^/]*)/", 1)


def _rows(found: list[dict], payloads: bool) -> pa.RecordBatch:
    kinds = [("archive", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    return pa.RecordBatch.from_pylist(found, schema=pa.schema([*kinds, *[("payload", pa.binary())] * payloads]))


def read_archives(spark: SparkSession, out: str, payloads: bool = False) -> DataFrame:
    """A row for each record of the archives under ``out``: ids, type, payload
    size and digest (computed from the payload, checked against the header), and
    the payload if asked for (null for revisits)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for record in inflate_records(data.as_py()):
                row = parse_record(record)
                found.append(row | {"archive": name, "payload": row["payload"] if payloads else None})
        return _rows(found, payloads)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{out}/archives")
    return map_batches(files.select(_archive_name(F.col("path")).alias("archive"), "content"), run, _RECORD + ", payload binary" * payloads)


def read_at(spark: SparkSession, out: str, index: DataFrame) -> DataFrame:
    """The records (payloads included) that rows of the index point to, each
    inflated on its own; other members are not touched."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for name, data, spots in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            data = data.as_py()
            for s in spots:
                found.append(parse_record(zlib.decompress(data[s["offset"] : s["offset"] + s["length"]], 31)) | {"archive": name})
        return _rows(found, True)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{out}/archives").select(_archive_name(F.col("path")).alias("archive"), "content")
    spots = index.groupBy("archive").agg(F.collect_list(F.struct("offset", "length")).alias("spots"))
    return map_batches(files.join(spots, "archive").select("archive", "content", "spots"), run, _RECORD + ", payload binary")
