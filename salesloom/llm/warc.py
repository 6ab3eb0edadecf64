"""WARC archives whose revisits are resolved by payload digest.

``web_records`` makes records of pages.  ``resolve`` shuffles their headers (digest,
page and count, never a payload) by digest, and of records with equal payloads
leaves one the response; the others become revisits of it.  ``write_archives``
writes them under fresh headers, ``read_archives`` streams archives back and hashes
what they hold, and ``with_originals`` joins the revisits found to their responses.

Archives are written by Spark's text sink, whose line separator is the blank lines
that end a record, so any file system that Spark writes to will do, and the sink's
commit drops what lost executors left.  They hold plain records and can be
concatenated; the reader also takes archives compressed record by record.
"""

from __future__ import annotations

import base64
import hashlib
import math
import zlib
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.context import shared_root
from salesloom.llm.common import column, ship, stored, table

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTENT = "application/http;msgtype=response"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n\r\n"

PAGE_FIELD = "Page-Id"  # a field of our own: the page a record was made of
DATE = "1970-01-01T00:00:00Z"  # no clock is read; callers state when they write
ARCHIVE_BYTES = 16 * 1024 * 1024  # aim of one archive, which a task reads as a whole
CHUNK = 32 * 1024  # so many bytes of an archive go to the parser at a time
MOST_BROADCAST = 200_000  # groups of equal payloads that are sent to all tasks, at most
COPIES_PER_ROW = 1000


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _digest(payload: Column) -> Column:
    """Base32 of SHA-1 in built-in functions: five hexadecimal digits make four letters."""
    text, letters = F.sha1(payload.cast("binary")), []
    for k in range(8):
        number = F.conv(F.substring(text, 5 * k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*letters)


def web_records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest of every row; NULL html is empty."""
    payload = F.coalesce(column(pages, "html", "string"), F.lit(""))
    return pages.select(
        column(pages, "page_id", "long").alias("page_id"), column(pages, "url", "string").alias("url"),
        payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        _digest(payload).alias("payload_digest"))


def record_id(page_id: Column, url: Column, digest: Column, copy: Column) -> Column:
    """The same record gets the same id again, so a lost task may be run once more."""
    h = F.md5(F.to_json(F.struct(page_id.alias("p"), url.alias("u"), digest.alias("d"), copy.alias("c"))))
    return F.concat(F.lit("urn:uuid:"), *[
        p for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
        for p in ((F.lit("-"),) if a > 1 else ()) + (F.substring(h, a, n),)])


def by_size(rows: DataFrame, small: DataFrame, key: str, how: str) -> DataFrame:
    """Join with ``small``, which is broadcast up to ``MOST_BROADCAST`` rows.

    Beyond, both sides are shuffled, and AQE splits what a frequent key makes large.
    """
    few = small.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    return rows.join(F.broadcast(small) if few else small, key, how)


def resolve(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The records with record_type, record_id and the id they refer to.

    Of records with equal payloads of at least ``least_bytes`` bytes, the one with the
    smallest page_id (NULL last, then by url) is the response; the others revisit it
    and lose their payload.  Smaller payloads are all responses.  Rows repeated
    as a whole give one response and revisits of it for the rest.
    """
    large = F.col("payload_bytes") >= least_bytes
    groups = stored(
        records.where(large).groupBy("payload_digest", "page_id", "url")
        .agg(F.count(F.lit(1)).alias("copies"))
        .groupBy("payload_digest").agg(
            F.min(F.struct(F.col("page_id").isNull().alias("no_page"), "page_id",
                           F.col("url").isNull().alias("no_url"), "url", "copies")).alias("first"),
            F.sum("copies").alias("total"))
        .where("total > 1").select(
            "payload_digest", F.lit(True).alias("shared"), F.col("first.page_id").alias("first_page"),
            F.col("first.url").alias("first_url"), "first.copies"))
    original = record_id(F.col("first_page"), F.col("first_url"), F.col("payload_digest"), F.lit(0))
    rows = by_size(records, groups, "payload_digest", "left")
    again = large & F.coalesce("shared", F.lit(False))
    first = F.col("page_id").eqNullSafe(F.col("first_page")) & F.col("url").eqNullSafe(F.col("first_url"))
    several = again & first & (F.col("copies") > 1)
    revisit = again & ~first

    def made(df: DataFrame, is_revisit: Column, copy: Column) -> DataFrame:
        return df.select(
            "page_id", "url", F.when(~is_revisit, F.col("payload")).alias("payload"),
            F.when(~is_revisit, F.col("payload_bytes")).alias("payload_bytes"), "payload_digest",
            F.when(is_revisit, "revisit").otherwise("response").alias("record_type"),
            record_id(F.col("page_id"), F.col("url"), F.col("payload_digest"), copy).alias("record_id"),
            F.when(is_revisit, original).alias("refers_to_id"))

    # rows repeated as a whole: one of them, and its copies by number
    many = groups.where("copies > 1")
    blocks = many.select("*", F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"(copies - 2) div {COPIES_PER_ROW}"))).alias("block"))
    numbered = blocks.repartition(F.col("payload_digest"), F.col("block")).select("*", F.explode(F.sequence(
        F.col("block") * COPIES_PER_ROW + 1,
        F.least(F.col("copies") - 1, (F.col("block") + 1) * COPIES_PER_ROW))).alias("copy"))
    copies = numbered.select(
        F.col("first_page").alias("page_id"), F.col("first_url").alias("url"),
        F.lit(None).cast("string").alias("payload"), F.lit(None).cast("long").alias("payload_bytes"),
        "payload_digest", "first_page", "first_url", "copy")
    return (made(rows.where(~several), revisit, F.lit(0))
            .unionByName(made(rows.where(several).dropDuplicates(["payload_digest"]), F.lit(False), F.lit(0)))
            .unionByName(made(copies, F.lit(True), F.col("copy"))))


def record_text(date: str) -> Column:
    """A record without the blank lines that end it: fresh headers, then the block."""
    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    # white space and control characters can't stand in a header line
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]+", "%20")
    uri = F.when(uri == "", F.lit("about:blank")).otherwise(uri)
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        field("Content-Length", F.col("payload_bytes").cast("string")), F.lit("\r\n"))
    block = F.concat(http, F.coalesce("payload", F.lit("")))
    held = F.octet_length(http) + F.coalesce("payload_bytes", F.lit(0))
    return F.concat(
        F.lit(VERSION + "\r\n"), field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", F.concat(F.lit("<"), "record_id", F.lit(">"))),
        field("WARC-Date", F.lit(date)), field("WARC-Target-URI", uri),
        field(PAGE_FIELD, F.col("page_id").cast("string")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        field("WARC-Profile", F.when(F.col("record_type") == "revisit", PROFILE)),
        field("WARC-Refers-To", F.concat(F.lit("<"), "refers_to_id", F.lit(">"))),
        field("Content-Type", F.lit(CONTENT)), field("Content-Length", held.cast("string")),
        F.lit("\r\n"), block)


def write_archives(records: DataFrame, folder: str, mean_bytes: float, date: str = DATE) -> None:
    """Write resolved records below ``folder``, about ``ARCHIVE_BYTES`` an archive.

    ``mean_bytes`` is the mean payload, from which the records of an archive are counted.
    """
    (records.select(record_text(date).alias("value")).write.option("lineSep", END)
     .option("maxRecordsPerFile", max(1, math.floor(ARCHIVE_BYTES / (mean_bytes + 1024)))).text(folder))


class Parser:
    """The records of one archive, from its bytes in order."""

    def __init__(self) -> None:
        self.held = bytearray()
        self.inflate = None
        self.plain: bool | None = None

    def feed(self, data: bytes) -> Iterator[tuple]:
        if self.plain is None:
            self.plain = not data.startswith(b"\x1f\x8b")
        if self.plain:
            self.held += data
        while not self.plain and data:
            self.inflate = self.inflate or zlib.decompressobj(31)
            self.held += self.inflate.decompress(data)
            data = self.inflate.unused_data
            if self.inflate.eof:
                self.inflate = None
        at = 0
        while True:
            while self.held[at:at + 2] == b"\r\n":  # the blank lines after a record
                at += 2
            end = self.held.find(b"\r\n\r\n", at)
            if end < 0:
                break
            fields = self.fields(bytes(self.held[at:end]))
            size = int(fields["content-length"])
            if len(self.held) < end + 4 + size:
                break
            yield self.record(fields, bytes(self.held[end + 4:end + 4 + size]))
            at = end + 4 + size
        del self.held[:at]

    def close(self) -> None:
        if self.held.strip(b"\r\n"):
            raise ValueError("an archive ends inside a record")

    @staticmethod
    def fields(head: bytes) -> dict[str, str]:
        version, *lines = head.decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        pairs = (line.partition(":") for line in lines)
        return {name.strip().lower(): value.strip() for name, _, value in pairs}

    @staticmethod
    def record(fields: dict[str, str], block: bytes) -> tuple:
        kind = fields.get("warc-type")
        declared = fields.get("warc-payload-digest", "").rpartition(":")[2] or None
        size = digest = None
        if kind == "response":
            payload = block.partition(b"\r\n\r\n")[2]
            size, digest = len(payload), payload_digest(payload)
            if declared and declared.upper() != digest:
                raise ValueError(f"payload of {fields.get('warc-record-id')} does not fit its digest")
        page = fields.get(PAGE_FIELD.lower())
        return (int(page) if page else None, fields.get("warc-target-uri"), kind,
                fields.get("warc-record-id", "").strip("<>") or None, size, digest or declared,
                fields.get("warc-refers-to", "").strip("<>") or None)


RECORD = pa.schema([("page_id", pa.int64()), ("uri", pa.string()), ("record_type", pa.string()),
                    ("record_id", pa.string()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("refers_to_id", pa.string())])


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, uri, record_type, record_id, payload_bytes, payload_digest, refers_to_id by record.

    Size and digest are those of the payload as read; a response that does not fit
    its declared digest, or an archive cut short, raises.  Revisits have their declared
    digest and no size.
    """
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser()
        for batch in batches:
            rows: list[tuple] = []
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if number == 0:
                    parser.close()
                    parser = Parser()
                rows += parser.feed(data.as_py())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(RECORD), RECORD)],
                schema=RECORD)
        parser.close()

    def chunks(content: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), ((F.length(content) - 1) / CHUNK).cast("int")),
            lambda k: F.struct(k.alias("number"),
                               F.substring(content, k * CHUNK + 1, F.lit(CHUNK)).alias("data")))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    # a column named inside a lambda is copied from its row for every chunk, a lambda's variable once
    return files.where("length > 0").select(F.inline(F.transform(F.array("content"), chunks)[0])).mapInArrow(
        run, "page_id long, uri string, record_type string, record_id string, payload_bytes long, "
             "payload_digest string, refers_to_id string")


def with_originals(records: DataFrame) -> DataFrame:
    """Records as read, revisits with the page, size and digest of their response.

    Revisits whose response is not in the archives keep their digest and get no size.
    """
    revisits = records.where("record_type = 'revisit'")
    targets = revisits.select(F.col("refers_to_id").alias("record_id")).distinct()
    originals = stored(
        records.where("record_type = 'response'").join(targets, "record_id", "left_semi")
        .select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
                F.col("payload_bytes").alias("size"), F.col("payload_digest").alias("digest")))
    found = by_size(revisits, originals, "refers_to_id", "left").select(
        "page_id", "uri", F.col("size").alias("payload_bytes"),
        F.coalesce("digest", "payload_digest").alias("payload_digest"), "record_type", "refers_to")
    return records.where("record_type = 'response'").select(
        "page_id", "uri", "payload_bytes", "payload_digest", "record_type",
        F.lit(None).cast("long").alias("refers_to")).unionByName(found)


def archive_pages(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = DATE) -> DataFrame:
    """Write pages as deduplicated archives below ``folder`` and return what those hold.

    page_id, uri, payload_bytes, payload_digest, record_type, refers_to, a row for every
    row of ``pages``: also those without page_id, url or html (empty payload), which
    are compared like others.  Other columns are ignored; an empty table gives no row.
    """
    records = web_records(pages)
    mean = records.agg(F.avg("payload_bytes")).first()[0] or 0.0
    write_archives(resolve(records, least_bytes), folder, mean, date)
    return with_originals(stored(read_archives(pages.sparkSession, folder)))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page in an archive, read back."""
    folder = f"{shared_root(spark)}/salesloom/archives/{uuid4().hex}"
    return archive_pages(table(spark, sf_dir, "pages"), folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
