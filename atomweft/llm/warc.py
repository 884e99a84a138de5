"""WARC archives with revisit resolution.

Only headers (id, payload digest, length) are shuffled by digest to find the first record of each payload; the payloads themselves meet the
decision by a join that broadcasts when the decisions are few and else hashes them, never by a sort of payloads. Each record is a gzip member
of its own, as the format has it, so that a reader can seek to it; the tasks compress, and Spark's text writer, whose committer survives lost
tasks, puts the bytes into files. They are read back member by member with length framing, each digest checked.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atomweft.llm.common import BROADCAST_ROWS, cut, sized, stored

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of compressed records in one row of the writer, and rows in one file: a file has about 64 MB, or as many of the largest records.
ROW_BYTES, FILE_ROWS = 4 << 20, 16
#: Of gzip: most of the time goes into compression, and higher levels save little on pages.
LEVEL = 2


def base32_sha1(col: Column) -> Column:
    """SHA-1 of the UTF-8 bytes in upper-case base32, computed in the JVM: 40 bits are 10 hex digits and 8 base32 digits."""
    hexa = F.sha1(col)
    parts = [F.lpad(F.conv(F.substring(hexa, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def decide(heads: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, digest, keeper) of the records to write as revisits.

    ``heads`` has page_id, digest and bytes. Of records with equal payloads of at least ``least_bytes`` the smallest page_id is the original;
    rows that repeat it are originals too. A null page_id comes after every other; a payload that only such rows hold has no revisits.
    """
    groups = heads.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1 AND keeper IS NOT NULL").drop("n")
    groups = sized(stored(groups, "payloads"))
    return heads.where(F.col("bytes") >= least_bytes).join(groups, "digest").where("NOT (page_id <=> keeper)").select("page_id", "digest", "keeper").distinct()


def _record_id(page_id: Column, digest: Column) -> Column:
    """A stable name-based id: a task that runs again writes the same record."""
    name = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes one record per row of ``pages`` (page_id, url, html) under ``path`` as WARC/1.1 files, a gzip member for each record.

    Responses carry the payload in an HTTP message with fresh headers; revisits carry the HTTP head only and name the original. Line breaks
    in a url are percent-encoded; a null url or page_id has no header line; a null html is an empty payload.
    """
    records = pages.select("page_id", F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A").alias("url"), F.coalesce("html", F.lit("")).alias("payload"))
    records = records.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("bytes", F.octet_length("payload"))
    found = cut(decide(records.select("page_id", "digest", "bytes"), least_bytes)).select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "keeper")
    found = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found.hint("shuffle_hash")
    records = records.join(found, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    again = F.col("keeper").isNotNull()
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Page-Id", F.col("page_id").cast("string")),
        line("WARC-Profile", F.when(again, PROFILE)),
        line("WARC-Refers-To", F.when(again, _record_id(F.col("keeper"), F.col("digest")))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", (F.octet_length("http") + F.when(again, 0).otherwise(F.col("bytes"))).cast("string")),
        F.lit("\r\n"),
        F.col("http"),
        F.when(again, "").otherwise(F.col("payload")),
        F.lit("\r\n\r\n"),
    )
    packed = records.withColumn("http", http).select(record.alias("value")).mapInArrow(_members, "value binary")
    packed.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").option("maxRecordsPerFile", FILE_ROWS).text(path)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records as gzip members, several in a row of about ROW_BYTES, without the zero byte at the end: the writer puts one after each row.

    A member ends with its length, of which the highest byte is zero up to 16 MB; a longer one is followed by an empty member.
    """
    held: list[bytes] = []
    size = 0
    for batch in batches:
        for text in batch.column("value"):
            data = text.as_py().encode("utf-8", "surrogatepass")
            held.append(gzip.compress(data, LEVEL, mtime=0))
            if held[-1][-1]:
                held.append(gzip.compress(b"", mtime=0))
            size += len(held[-1])
            if size >= ROW_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["value"])
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["value"])


def members(data: bytes) -> Iterator[bytes]:
    """The contents of the gzip members of a file, one after the other."""
    while data:
        one = zlib.decompressobj(31)
        yield one.decompress(data)
        data = one.unused_data


_HEADER = re.compile(rb"([^:\r\n]+): ?([^\r\n]*)\r\n")
READ = "record_type string, record_id string, page_id bigint, refers_to_id string, url string, payload_digest string, payload_bytes bigint, intact boolean"


def _parse(with_payload: bool):
    names = [x.split()[0] for x in READ.split(", ")] + ["payload"] * with_payload
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.bool_()] + [pa.string()] * with_payload

    def records(data: bytes) -> Iterator[tuple]:
        at = 0
        while (end := data.find(b"\r\n\r\n", at)) >= 0:
            head = dict(_HEADER.findall(data, at, end + 2))
            size = int(head[b"Content-Length"])
            start = end + 4
            text = lambda name: v.decode() if (v := head.get(name)) is not None else None  # noqa: E731, B023
            kind, digest, page = text(b"WARC-Type"), text(b"WARC-Payload-Digest"), text(b"X-Page-Id")
            digest = digest and digest.removeprefix("sha1:")
            row = (kind, text(b"WARC-Record-ID"), int(page) if page else None, text(b"WARC-Refers-To"), text(b"WARC-Target-URI"), digest)
            if kind == "response":
                body = memoryview(data)[data.index(b"\r\n\r\n", start) + 4 : start + size]
                row += (len(body), digest and base64.b32encode(hashlib.sha1(body).digest()).decode() == digest)
                yield row + ((str(body, "utf-8", "replace"),) if with_payload else ())
            else:
                yield row + (None, None) + (None,) * with_payload
            at = start + size + 4

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item in batch.column("content"):
                found = (row for part in members(item.as_py()) for row in records(part))
                while rows := list(itertools.islice(found, 1000)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return parse


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row per record of the archives under ``path``, whatever the number of records in a gzip member; records of other kinds, and revisits
    until they are resolved, have no payload figures, and ``intact`` is null for a record without a digest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(path).select("content")
    return files.mapInArrow(_parse(with_payload), READ + ", payload string" * with_payload)


def resolve(records: DataFrame) -> DataFrame:
    """``records`` with refers_to (the original's page_id) and payload_bytes of revisits filled in from the original response.

    Only rows that refer to another are joined, so no null key gathers the rest in one task; the originals are broadcast up to a checked number and
    else written, so that adaptive execution can split the revisits of a hot original. A revisit whose original is not there has nulls. Give ``cut``
    or stored records: they are read three times.
    """
    refers = F.col("refers_to_id").isNotNull()
    originals = records.where("record_type = 'response' AND record_id IS NOT NULL").select(F.col("record_id").alias("_id"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_bytes")).dropDuplicates(["_id"])
    originals = sized(stored(originals, "originals"))
    columns = [c for c in records.columns if c != "payload_bytes"]
    found = records.where(refers).join(originals, F.col("refers_to_id") == F.col("_id"), "left").select(*columns, F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"), F.col("_page").alias("refers_to"))
    return records.where(~refers).select(*columns, "payload_bytes", F.lit(None).cast("bigint").alias("refers_to")).unionAll(found)
