"""Web archives: writing pages as WARC transactions, reading them back, assembling captures.

Each page becomes three records: a response (or a revisit of an equal payload), a request and
a metadata record, the last two naming the first in WARC-Concurrent-To. Records are text, so
Spark's text writer puts them into any store, gzipped, with a bounded number of pages a file;
the separator of lines is the two line ends that close a record. Reading parses whole files by
their length fields. Assembly brings the records of a transaction together by the identifier
they are concurrent to, one nested row a capture.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hushline.llm.storage import shared_folder, written

LINE = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads of fewer bytes are never revisits.
LEAST_REVISITED = 1000
PAGES_PER_FILE = 5000

RECORD = (
    "record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, "
    "payload_digest string, payload_bytes long, fields map<string,string>"
)


def _record_id(kind: str, page: Column, url: Column, digest: Column) -> Column:
    """A name-based identifier: the same page, address and payload always get the same."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))
    h = F.md5(F.concat_ws("\n", F.lit(kind), part(page), part(url), digest))
    cut = lambda start, n: F.substring(h, start, n)
    return F.concat(
        F.lit("<urn:uuid:"), cut(1, 8), F.lit("-"), cut(9, 4), F.lit("-8"), cut(14, 3), F.lit("-a"), cut(18, 3), F.lit("-"),
        cut(21, 12), F.lit(">"),
    )


def _lines(*lines: Column | tuple[str, Column]) -> Column:
    """Header lines; a pair is a field, left out where its value is null."""
    made = [F.concat(F.lit(f"{x[0]}: "), x[1].cast("string"), F.lit(LINE)) if isinstance(x, tuple) else F.concat(x, F.lit(LINE)) for x in lines]
    return F.concat(*(F.coalesce(x, F.lit("")) for x in made))


def _record(kind: Column, record_id: Column, fields: list[tuple[str, Column]], date: str, block: Column) -> Column:
    return F.concat(
        _lines(F.lit("WARC/1.1"), ("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", F.lit(date)), *fields,
               ("Content-Length", F.octet_length(block))),
        F.lit(LINE), block,
    )


def with_roles(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page, url, payload, payload_bytes, digest, original): original is the (page, url) whose equal payload is revisited.

    The row with the largest page (then address) among equal payloads is the response;
    original is null for it, for payloads of under LEAST_REVISITED bytes and for unique ones.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    source = pages.select(F.col(page).alias("page"), F.col(url).alias("url"), payload.alias("payload"))
    source = source.withColumn("payload_bytes", F.octet_length("payload")).withColumn(
        "digest", F.sha1(F.col("payload").cast("binary"))
    )
    groups = source.where(f"payload_bytes >= {LEAST_REVISITED}").groupBy("digest").agg(
        F.max(F.struct("page", "url")).alias("original"), F.count(F.lit(1)).alias("n")
    )
    # Written first: its size is then known, and where it is small no payload is shuffled.
    groups = written(groups.where("n > 1").select("digest", "original"), "revisited")
    joined = source.join(groups, "digest", "left")
    same = F.col("page").eqNullSafe(F.col("original.page")) & F.col("url").eqNullSafe(F.col("original.url"))
    big = F.col("payload_bytes") >= LEAST_REVISITED
    return joined.withColumn("original", F.when(big & F.col("original").isNotNull() & ~same, F.col("original")))


def transactions(pages: DataFrame, date: str) -> DataFrame:
    """One string a page: its three records."""
    rows = with_roles(pages)
    page, url, digest, original = (F.col(c) for c in ("page", "url", "digest", "original"))
    uri = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    main = _record_id("response", page, url, digest)
    revisit = original.isNotNull()
    http = F.concat(
        _lines(F.lit("HTTP/1.1 200 OK"), ("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", F.col("payload_bytes"))),
        F.lit(LINE), F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    )
    response = _record(F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), main, [
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        ("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        ("WARC-Refers-To", F.when(revisit, _record_id("response", original["page"], original["url"], digest))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
    ], date, http)
    asked = F.concat(_lines(F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1"))), F.lit(LINE))
    request = _record(F.lit("request"), _record_id("request", page, url, digest), [
        ("WARC-Target-URI", uri), ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/http; msgtype=request")),
    ], date, asked)
    about = _record(F.lit("metadata"), _record_id("metadata", page, url, digest), [
        ("WARC-Target-URI", uri), ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/warc-fields")),
    ], date, _lines(("page_id", page)))
    end = F.lit(LINE + LINE)
    return rows.select(F.concat(response, end, request, end, about).alias("value"))


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Gzipped archives below path; null payloads are empty, repeated rows are written as often as they come."""
    (
        transactions(pages, date).write.option("lineSep", LINE + LINE).option("compression", "gzip")
        .option("maxRecordsPerFile", PAGES_PER_FILE).text(path)
    )


def _header(lines: Iterator[bytes]) -> dict[str, str]:
    fields = {}
    for line in lines:
        line = line.rstrip(b"\r\n")
        if not line:
            break
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    return fields


def parse_archive(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-cased names) and block of each record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a WARC record: {line[:40]!r}")
        fields = _header(iter(stream.readline, b""))
        yield fields, stream.read(int(fields["content-length"]))


def _parsed(fields: dict[str, str], block: bytes) -> dict:
    kind = fields.get("warc-type")
    row = {
        "record_id": fields.get("warc-record-id"), "type": kind, "concurrent_to": fields.get("warc-concurrent-to"),
        "refers_to": fields.get("warc-refers-to"), "target_uri": fields.get("warc-target-uri"),
        "date": fields.get("warc-date"), "payload_digest": None, "payload_bytes": None, "fields": [],
    }
    if kind in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        stated = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        if kind == "response":
            row["payload_digest"], row["payload_bytes"] = hashlib.sha1(payload).hexdigest(), len(payload)
            if stated and stated != row["payload_digest"]:
                raise ValueError(f"payload of {row['record_id']} does not have the digest stated")
        else:
            http = _header(iter(head.split(b"\r\n")[1:]))
            row["payload_digest"], row["payload_bytes"] = stated, int(http.get("content-length", 0))
    elif kind == "metadata":
        row["fields"] = list(_header(iter(block.split(b"\r\n"))).items())
    return row


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below path; response payloads are checked against their digests."""
    schema = pa.schema([
        (name, pa.map_(pa.string(), pa.string()) if name == "fields" else pa.int64() if name == "payload_bytes" else pa.string())
        for name in (part.split(" ")[0] for part in RECORD.split(", "))
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                # An uncompressed view of the file is read record by record, never held whole.
                stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())), 1 << 16)
                rows = [_parsed(*record) for record in parse_archive(stream)]
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """(capture_id, response, request, metadata): a nested row for each capture.

    The join on the identifier that records are concurrent to is one aggregation, summed
    before the shuffle. Captures whose response was archived n times give n rows; requests and
    metadata without a response give a row with a null response.
    """
    main = F.col("type").isin("response", "revisit")
    of = lambda kind, *cols: F.first(F.when(kind, F.struct(*cols)), ignorenulls=True)
    grouped = records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id")).agg(
        of(main, "record_id", "type", "refers_to", "target_uri", "date", "payload_digest", "payload_bytes").alias("response"),
        of(F.col("type") == "request", "record_id", "target_uri", "date").alias("request"),
        of(F.col("type") == "metadata", "record_id", "fields").alias("metadata"),
        F.count(F.when(main, True)).alias("n"),
    )
    return grouped.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.greatest("n", F.lit(1).cast("long"))))).drop("n", "copy")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages to archives in the shared folder, reads them back, and gives one row a page.

    (page_id, payload_bytes, payload_digest, record_type, refers_to). Null html is an empty
    payload; null addresses have no target; null page ids are smaller than all others.
    Identical rows are all responses or all revisits.
    """
    spark = pages.sparkSession
    path = shared_folder(spark, "archives")
    write_archives(pages, path)
    found = written(captures(read_archives(spark, path)), "captures")
    number = F.col("metadata.fields").getItem("page_id").cast("long")
    rows = found.select(number.alias("page_id"), "response.*")
    targets = found.select(F.col("response.record_id").alias("refers_to"), number.alias("target")).where(
        F.col("response.type") == "response"
    ).dropDuplicates(["refers_to"])
    targets = written(targets, "targets")  # so that very many revisits of one page can be split
    return rows.join(targets, "refers_to", "left").select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("target").alias("refers_to")
    )
