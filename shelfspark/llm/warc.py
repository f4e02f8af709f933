"""WARC archives with revisit records for payloads that were seen before."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from io import BufferedReader, RawIOBase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm.frames import named
from shelfspark.session import settle

# Fixed values of the archive format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n"


def payload_digest(payload: Column) -> Column:
    """SHA-1 in upper-case base32: four letters for each five hexadecimal digits."""
    hexa = F.sha1(payload)
    letters = F.lit(BASE32)
    out = []
    for k in range(8):
        bits = F.conv(F.substring(hexa, 5 * k + 1, 5), 16, 10).cast("int")
        out += [F.substring(letters, F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def _record_id(page: Column, digest: Column, size: Column) -> Column:
    """Page numbers may repeat with other payloads, so the payload is part of a record's identity."""
    digest = F.md5(F.concat_ws(":", F.lit("page"), F.coalesce(page.cast("string"), F.lit("")), digest, size.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digest, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), F.lit(">"))


def write_archives(
    pages: DataFrame,
    path: str,
    page: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = 0,
    date: str = "2020-01-01T00:00:00Z",
) -> None:
    """Write one record per row of ``pages`` below ``path``: gzip files of whole records.

    Of payloads (UTF-8, null: empty) of ``least`` bytes or more that are equal, the one with the smallest page number is
    a response and the others are revisit records that name it; shorter payloads are all responses. Rows that repeat
    the smallest page number are responses each; a null number is never the smallest unless all are null. A page number that
    repeats with another payload is another record. Only digests are grouped; those that repeat are written as a small
    table first, so that a hot payload can be split. An empty table writes no record; columns other than the three named are
    not read, whatever their names; a payload is whole in one record, however long.
    """
    payload = F.coalesce(named(html), F.lit(""))
    rows = pages.select(
        named(page).cast("bigint").alias("page"),
        F.regexp_replace(F.coalesce(named(url), F.lit("")), r"[\r\n]+", "%0D%0A").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).alias("bytes"),
    ).withColumn("digest", payload_digest(F.col("payload").cast("binary")))
    headers = rows.select("page", "url", "bytes", "digest").filter(F.col("bytes") >= least)
    first = F.min(F.struct(F.col("page").isNull().alias("unknown"), "page", "url")).alias("first")
    repeated = headers.groupBy("digest", "bytes").agg(first, F.count("*").alias("n")).filter("n > 1")
    repeated = settle(repeated.select("digest", "bytes", F.col("first.page").alias("of"), F.col("first.url").alias("of_url")), "originals")

    found = rows.join(repeated.withColumn("repeats", F.lit(True)), ["digest", "bytes"], "left")
    revisit = F.coalesce(F.col("repeats"), F.lit(False)) & ~F.col("page").eqNullSafe(F.col("of"))

    def header(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(END))

    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("bytes").cast("string"), F.lit(END * 2))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    record = F.concat(
        F.lit(VERSION + END),
        header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        header("WARC-Record-ID", _record_id(F.col("page"), F.col("digest"), F.col("bytes"))),
        header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", F.col("url")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(
            revisit,
            F.concat(
                header("WARC-Profile", F.lit(PROFILE)),
                header("WARC-Refers-To", _record_id(F.col("of"), F.col("digest"), F.col("bytes"))),
                header("WARC-Refers-To-Target-URI", F.col("of_url")),
                header("WARC-Refers-To-Date", F.lit(date)),
            ),
        ).otherwise(F.lit("")),
        F.when(F.col("page").isNotNull(), header("Page-Number", F.col("page").cast("string"))).otherwise(F.lit("")),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
        block,
    )
    # A record ends with two line ends: the text writer's separator.
    found.select(record.alias("value")).write.option("lineSep", END * 2).option("compression", "gzip").text(path)


class _Unzipped(RawIOBase):
    """Reads gzip members one after another, a piece at a time."""

    def __init__(self, data: bytes):
        self.rest, self.out, self.unzip = memoryview(data), b"", zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self.out and len(self.rest):
            piece, self.rest = self.rest[: 1 << 16], self.rest[1 << 16 :]
            self.out = self.unzip.decompress(piece)
            if self.unzip.eof:
                left = self.unzip.unused_data
                self.rest = self.rest if not left else memoryview(left + bytes(self.rest))
                self.unzip = zlib.decompressobj(31)
        n = min(len(target), len(self.out))
        target[:n], self.out = self.out[:n], self.out[n:]
        return n


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive file."""
    lines = BufferedReader(_Unzipped(data), 1 << 17)
    while line := lines.readline():
        if line.strip() != VERSION.encode():
            raise ValueError(f"no record begins with {line[:40]!r}")
        headers = {}
        while (line := lines.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        block = lines.read(int(headers["Content-Length"]))
        if lines.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers['WARC-Record-ID']} does not end where it should")
        yield headers, block


FIELDS = "page bigint, record string, type string, url string, refers_to string, digest string, payload binary"


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record: ``page``, ``record``, ``type``, ``url``, ``refers_to`` (a record), ``digest``, ``bytes`` of the
    block's payload and, if wanted, the ``payload``, empty for revisit records."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                rows, held = [], 0
                for headers, block in records(data.as_py()):
                    payload = block.partition(b"\r\n\r\n")[2]
                    rows.append(
                        {
                            "page": int(headers["Page-Number"]) if "Page-Number" in headers else None,
                            "record": headers["WARC-Record-ID"],
                            "type": headers["WARC-Type"],
                            "url": headers["WARC-Target-URI"],
                            "refers_to": headers.get("WARC-Refers-To"),
                            "digest": headers["WARC-Payload-Digest"].removeprefix("sha1:"),
                            "bytes": len(payload),
                            "payload": payload if payloads else None,
                        }
                    )
                    held += len(payload) * payloads + 500
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, shape)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, shape)

    texts = ("record", "type", "url", "refers_to", "digest")
    shape = pa.schema([("page", pa.int64()), *((t, pa.string()) for t in texts), ("bytes", pa.int64()), ("payload", pa.binary())])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    kinds = "page bigint, record string, type string, url string, refers_to string, digest string, bytes bigint, payload binary"
    found = files.mapInArrow(parse, kinds)
    return found if payloads else found.drop("payload")


def resolved(found: DataFrame) -> DataFrame:
    """Each record with the page and the payload size of the response that it is or refers to.

    ``found`` comes from ``read_archives`` and should be a written table: both sides of the join read it.
    """
    # Responses of one record id have the same page and payload, so one of them stands for all.
    of = found.filter("type = 'response'").groupBy("record").agg(F.first("page").alias("of"), F.first("bytes").alias("full"))
    of = settle(of, "responses")
    seen = found.join(of.withColumnRenamed("record", "refers_to"), "refers_to", "left")
    return seen.select(
        "page",
        F.when(F.col("type") == "revisit", F.col("full")).otherwise(F.col("bytes")).alias("bytes"),
        "digest",
        "type",
        F.when(F.col("type") == "revisit", F.col("of")).alias("refers_to"),
    )
