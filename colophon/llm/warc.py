"""WARC revisit resolution: which record of an archive repeats another's payload, and archives without the repeats.

Only headers are exchanged to find repeats: one partial aggregation by payload digest (SHA-256) names the
original of each digest, the first response that has it, and a join by digest gives every other record its original. ``resolved``
does that for the revisit records of an existing archive. ``deduplicated`` makes a new one of pages: one response
record for each distinct payload, a revisit record for each repeat, all with fresh headers (record id, date, lengths, digest,
and for revisits what they refer to). Payloads move once, to the headers of their page.

Pages without page_id are left out. A null url or html is an empty one. Rows equal in page_id, url and html are one record; rows that only
repeat a page_id are records of their own. Of equal payloads the least (page_id, url) is the original; empty payloads are equal to one another. Line ends in a
url are dropped. Empty tables give empty results. Other columns don't matter. Texts are used whole.
"""

from __future__ import annotations

import gzip
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_root

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE = "\r\n"
HTTP = f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "
ARCHIVE = "record_id string, warc_type string, uri string, date string, digest string, refers_to string, block binary"


def record_id(kind: str, page: Column, url: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), page.cast("string"), url, digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def deduplicated(pages: DataFrame, date: str = DATE) -> DataFrame:
    """(page_id, url, warc_type, digest, original_page_id, record): the new archive, a row for each record.
    original_page_id is null for responses; record is the whole record, header and block."""
    key = ["page_id", "url", "digest"]
    rows = pages.where("page_id is not null").select(
        F.col("page_id").cast("long").alias("page_id"), F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]", "").alias("url"), F.coalesce("html", F.lit("")).alias("html")
    )
    rows = rows.withColumn("digest", F.sha2("html", 256))
    headers = rows.select(*key)
    several = headers.groupBy("digest").agg(F.min(F.struct("page_id", "url")).alias("o"), F.max(F.struct("page_id", "url")).alias("z")).where("o <> z")
    repeats = headers.join(several, "digest").where("struct(page_id, url) <> o").select(*key, F.col("o.page_id").alias("o_page"), F.col("o.url").alias("o_url")).distinct()
    records = rows.groupBy(*key).agg(F.first("html").alias("html")).join(repeats, key, "left")
    page, url, digest, again = F.col("page_id"), F.col("url"), F.col("digest"), F.col("o_page").isNotNull()
    block = F.concat(F.lit(HTTP), F.octet_length("html").cast("string"), F.lit(LINE * 2), F.when(again, "").otherwise(F.col("html")))
    own = F.when(again, record_id("revisit", page, url, digest)).otherwise(record_id("response", page, url, digest))
    to = F.concat(
        F.lit(f"WARC-Profile: {PROFILE}{LINE}WARC-Refers-To: "), record_id("response", F.col("o_page"), F.col("o_url"), digest), F.lit(f"{LINE}WARC-Refers-To-Target-URI: "), F.col("o_url"), F.lit(f"{LINE}WARC-Refers-To-Date: {date}{LINE}")
    )
    head = F.concat(
        F.lit(f"WARC/1.1{LINE}WARC-Type: "), F.when(again, "revisit").otherwise("response"), F.lit(f"{LINE}WARC-Record-ID: "), own, F.lit(f"{LINE}WARC-Date: {date}{LINE}WARC-Target-URI: "), url,
        F.lit(f"{LINE}WARC-Payload-Digest: sha256:"), digest, F.lit(LINE), F.when(again, to).otherwise(""), F.lit(f"Content-Type: application/http; msgtype=response{LINE}Content-Length: "), F.octet_length("block").cast("string"), F.lit(LINE * 2),
    )
    return records.withColumn("block", block).select(
        "page_id", "url", F.when(again, "revisit").otherwise("response").alias("warc_type"), "digest", F.col("o_page").alias("original_page_id"), F.concat(head, "block").alias("record")
    )


def sql(date: str = DATE) -> str:
    """deduplicated() of pages, for DuckDB."""
    def urn(kind: str, page: str, url: str) -> str:
        h = f"md5(concat_ws('|', '{kind}', {page}::VARCHAR, {url}, digest))"
        return f"'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || substr({h}, 17, 4) || '-' || substr({h}, 21, 12) || '>'"

    end = "chr(13) || chr(10)"
    http = " || ".join(f"'{x}'" if x else "''" for x in ["HTTP/1.1 200 OK"]) + f" || {end} || 'Content-Type: text/html; charset=utf-8' || {end} || 'Content-Length: '"
    return f"""
WITH p AS (
  SELECT DISTINCT page_id, regexp_replace(coalesce(url, ''), '[\\r\\n]', '', 'g') AS url, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest
  FROM pages WHERE page_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY digest ORDER BY page_id, url) AS k,
    first_value(page_id) OVER (PARTITION BY digest ORDER BY page_id, url) AS o_page,
    first_value(url) OVER (PARTITION BY digest ORDER BY page_id, url) AS o_url FROM p),
b AS (SELECT *, {http} || strlen(html)::VARCHAR || {end} || {end} || CASE WHEN k > 1 THEN '' ELSE html END AS block FROM o)
SELECT page_id, url, CASE WHEN k > 1 THEN 'revisit' ELSE 'response' END AS warc_type, digest, CASE WHEN k > 1 THEN o_page END AS original_page_id,
  'WARC/1.1' || {end} || 'WARC-Type: ' || CASE WHEN k > 1 THEN 'revisit' ELSE 'response' END || {end} || 'WARC-Record-ID: '
  || CASE WHEN k > 1 THEN {urn("revisit", "page_id", "url")} ELSE {urn("response", "page_id", "url")} END
  || {end} || 'WARC-Date: {date}' || {end} || 'WARC-Target-URI: ' || url || {end} || 'WARC-Payload-Digest: sha256:' || digest || {end}
  || CASE WHEN k > 1 THEN 'WARC-Profile: {PROFILE}' || {end} || 'WARC-Refers-To: ' || {urn("response", "o_page", "o_url")} || {end}
    || 'WARC-Refers-To-Target-URI: ' || o_url || {end} || 'WARC-Refers-To-Date: {date}' || {end} ELSE '' END
  || 'Content-Type: application/http; msgtype=response' || {end} || 'Content-Length: ' || strlen(block)::VARCHAR || {end} || {end} || block AS record
FROM b"""


def write_archive(records: DataFrame, path: str) -> DataFrame:
    """The column record as WARC files in the folder path (any that pyarrow knows), gzipped record by record, as the format asks, so that one can be read by its offset; each file begins with a warcinfo record.
    A file is written under another name and moved when it is whole, so a task that runs again replaces what it wrote. Returns (file, n_records, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, folder = pa_fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pa_fs.LocalFileSystem(), path)
        fs.create_dir(folder, recursive=True)
        part = TaskContext.get().partitionId()
        name, temporary, n = f"{folder}/part-{part:05d}.warc.gz", f"{folder}/_part-{part:05d}-{uuid.uuid4().hex}", 0
        with fs.open_output_stream(temporary, compression=None) as out:
            info = "software: colophon" + LINE + "format: WARC File Format 1.1" + LINE
            head = f"WARC/1.1{LINE}WARC-Type: warcinfo{LINE}WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>{LINE}WARC-Date: {DATE}{LINE}Content-Type: application/warc-fields{LINE}Content-Length: {len(info)}{LINE * 2}"
            out.write(gzip.compress((head + info + LINE * 2).encode(), 6, mtime=0))
            for b in batches:
                for record in b.column(0):
                    out.write(gzip.compress((record.as_py() + LINE * 2).encode(), 6, mtime=0))
                    n += 1
            size = out.tell()
        fs.move(temporary, name)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n]), pa.array([size])], ["file", "n_records", "bytes"])

    return records.select("record").mapInArrow(run, "file string, n_records long, bytes long")


def _inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Chunks of a file, decompressed where they are gzip members, one after another. Each byte is looked at once."""
    d, plain = None, None
    for chunk in chunks:
        if plain is None:
            plain = chunk[:2] != b"\x1f\x8b"
        if plain:
            yield chunk
            continue
        while chunk:
            d = d or zlib.decompressobj(31)
            yield d.decompress(chunk)
            chunk = b""
            if d.eof:
                chunk, d = d.unused_data.lstrip(b"\0"), None


def records_of(chunks: Iterator[bytes]) -> Iterator[tuple]:
    """ARCHIVE rows of a WARC file, given in chunks; what follows the last whole record is left out. No more is held than a record and a chunk."""
    names = ("warc-record-id", "warc-type", "warc-target-uri", "warc-date", "warc-payload-digest", "warc-refers-to")
    buffer, sep, need = bytearray(), LINE.encode() * 2, 0
    for chunk in _inflated(chunks):
        buffer += chunk
        if len(buffer) < need:
            continue
        at = 0
        while (begin := buffer.find(b"WARC/", at)) >= 0 and (end := buffer.find(sep, begin)) >= 0:
            pairs = [x.split(":", 1) for x in buffer[begin:end].decode("utf-8", "replace").split(LINE)[1:] if ":" in x]
            h = {k.strip().lower(): v.strip() for k, v in pairs}
            size = int(h.get("content-length") or 0)
            if len(buffer) < end + 4 + size:
                need = end + 4 + size - at
                break
            yield (*(h.get(x) for x in names), bytes(buffer[end + 4 : end + 4 + size]))
            at, need = end + 4 + size, 0
        del buffer[:at]


def read_archive(spark: SparkSession, path: str, chunk: int = 1 << 20) -> DataFrame:
    """The records of the WARC files (gzipped or not, of any size) at path, as ARCHIVE. A file is streamed by one task; hidden files are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in ARCHIVE.split(", ")]

        def batch(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "block" else pa.string()) for c, n in zip(zip(*rows), names)], names)

        for b in batches:
            for name in b.column(0).to_pylist():
                fs, file = pa_fs.FileSystem.from_uri(name)
                rows, held = [], 0
                with fs.open_input_stream(file, compression=None) as stream:
                    for r in records_of(iter(lambda: stream.read(chunk), b"")):  # noqa: B023
                        rows.append(r)
                        held += len(r[-1])
                        if held > 1 << 24:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    return spark.read.format("binaryFile").load(path).select("path").mapInArrow(run, ARCHIVE)


def resolved(archive: DataFrame) -> DataFrame:
    """(record_id, uri, date, digest, original_id, original_uri, original_date) of each revisit record of an archive: the earliest response with the same
    payload digest (ties: the least record id), or nulls where there is none or the digest is null. Blocks aren't read."""
    heads = archive.select("record_id", "warc_type", "uri", "date", "digest")
    first = heads.where("warc_type = 'response' and digest is not null").groupBy("digest").agg(F.min(F.struct("date", "record_id", "uri")).alias("o"))
    return (
        heads.where("warc_type = 'revisit'")
        .join(first, "digest", "left")
        .select("record_id", "uri", "date", "digest", F.col("o.record_id").alias("original_id"), F.col("o.uri").alias("original_uri"), F.col("o.date").alias("original_date"))
    )


def crawled_twice(pages: DataFrame) -> DataFrame:
    """pages, and each page again under another address: an archive with a revisit record for each at least."""
    page = pages.select("page_id", "url", "html")
    return page.union(page.select("page_id", F.concat(F.coalesce("url", F.lit("")), F.lit("#again")), "html"))


def round_trip(pages: DataFrame) -> DataFrame:
    """resolved() of an archive of pages that were crawled twice, after it was written as WARC files to the shared folder and read from there."""
    path = f"{scratch_root(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write_archive(deduplicated(crawled_twice(pages)), path).agg(F.sum("n_records")).collect()
    return resolved(read_archive(pages.sparkSession, path))


def round_trip_sql(date: str = DATE) -> str:
    """round_trip() of pages, for DuckDB."""
    again = "pages AS (SELECT page_id, url, html FROM main.pages UNION ALL SELECT page_id, coalesce(url, '') || '#again', html FROM main.pages), p AS ("
    head = lambda name: f"regexp_extract(record, '{name}: ([^\r]*)', 1)"
    return f"""
WITH made AS ({sql(date).replace("WITH p AS (", f"WITH {again}", 1)}),
h AS (SELECT {head("WARC-Record-ID")} AS record_id, warc_type, {head("WARC-Target-URI")} AS uri, {head("WARC-Date")} AS date, {head("WARC-Payload-Digest")} AS digest FROM made),
o AS (SELECT digest, min((date, record_id, uri)) AS o FROM h WHERE warc_type = 'response' GROUP BY 1)
SELECT record_id, uri, date, digest, o[2] AS original_id, o[3] AS original_uri, o[1] AS original_date FROM h LEFT JOIN o USING (digest) WHERE warc_type = 'revisit'"""
