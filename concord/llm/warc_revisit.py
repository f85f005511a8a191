"""WARC archives with revisit records (operator 10).

Headers are shuffled by payload digest: of the pages with one payload, that with the smallest id is written in
full as a response, the others become revisit records that name it, its target and its date. The digest, the choice and the join need the
headers only. A bitmap of the digests that several pages have goes to all tasks: a page whose digest is surely its own is a response and is written where it was
read, without a shuffle. The others meet their verdict in one join, which Spark splits where one payload is very common; a second bitmap, of these payloads' responses, tells
pages that are surely revisits, which leave their html behind. Either bitmap has 1 MB; a full one only says that more html is shuffled. Records are
text, so Spark's own writer puts them into archives in the shared folder, on whatever file system that is;
the writer's line separator ends each record with the two line ends the format asks for. Archives are plain, which any reader can seek in: compressed ones should have a gzip
member for each record, but Spark's writer makes one a file. Of these (compression="gzip") only whole files can be read. An archive has about ARCHIVE_BYTES; there is no warcinfo record, which the format leaves free.

Reading back parses each archive by the Content-Length of its records, recomputes every response's digest from its bytes and joins
revisits to their responses by record id, so payload size and digest of a revisit are those of the page it refers to.

Record ids are made of the page's id, its payload digest and the row's number in the scan, so that no two records share one, whatever repeats. The
pages are scanned three times and must come in the same order each time, as a table does; if not, a revisit finds no response and reading back fails.
Every record is dated by the time of writing, one for a whole run.

Cases: a null html is an empty payload; empty payloads are deduplicated like others unless `least_bytes` says that smaller
ones are always written in full. Rows that repeat the smallest id of a payload are all responses, and revisits refer to the first of them. An id may
have several payloads; each counts for itself. A null id is the smallest, and its record has no Page-ID; other ids are written url-encoded, so that
blanks, line ends and the empty id come back as they were. A null url is written as an empty target. A very long html is one record, held whole by a task. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions.bitmaps import mark_maybe
from concord.session import cut_lineage, discard, shared_path

CRLF = "\r\n"
ARCHIVE_BYTES = 1 << 24
HEADER_BYTES = 600
GZIP = b"\x1f\x8b"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARSED = "page_id string, record_type string, record_id string, refers_to string, payload_bytes long, payload_digest string, stated_digest string"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 160 bits are eight runs of five hex digits, and each run is four base32 digits."""
    hexed = F.sha1(payload.cast("binary"))
    digits = F.concat(*[F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(page_id: Column, digest: Column, row: Column) -> Column:
    """A name-based id, so that a page's record can be referred to without looking it up."""
    h = F.md5(F.concat_ws(":", F.lit("record"), page_id, digest, row.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def plan_records(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """pages as page_id (text), url, html (may be null for revisits), digest, n_bytes, record_id, and of a revisit the page, record id and url of the response it refers to."""
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("digest", base32_sha1(F.col("html"))).withColumn("n_bytes", F.octet_length("html").cast("long"))
    order = F.struct(F.col("id").isNotNull().alias("known"), "id", "row", "url")
    # As a table of its own, the choice is joined by a plain sort-merge join, whose large partitions Spark can split.
    originals = cut_lineage(rows.select("digest", order.alias("first")).groupBy("digest").agg(F.min("first").alias("first"), F.count("*").alias("n")))
    marked = mark_maybe(rows, originals.where("n > 1"), ["digest"], "shared")
    alone = marked.where("NOT shared").withColumn("first", order)
    # Those that the bitmap takes for shared, with their responses: a page that is none of these leaves its html behind.
    taken = mark_maybe(originals, originals.where("n > 1"), ["digest"], "shared").where("shared").select("digest", "first")
    full = mark_maybe(marked.where("shared").drop("shared"), taken.select("digest", F.col("first.id").alias("id")), ["digest", "id"], "full")
    html = F.when(F.col("full") | (F.col("n_bytes") < least_bytes), F.col("html"))
    met = full.withColumn("html", html).drop("full").join(taken, "digest").unionByName(alone.drop("shared"))
    revisit = (F.col("n_bytes") >= least_bytes) & ~F.col("first.id").eqNullSafe(F.col("id"))
    text_id = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    digest = F.col("digest")
    return met.select(
        F.col("id").cast("string").alias("page_id"), "url", "html", "digest", "n_bytes", record_id(text_id("id"), digest, F.col("row")).alias("record_id"),
        F.when(revisit, text_id("first.id")).alias("original"), F.when(revisit, record_id(text_id("first.id"), digest, F.col("first.row"))).alias("original_record"), F.when(revisit, F.col("first.url")).alias("original_url"),
    )


def records(planned: DataFrame, written: Column | None = None) -> DataFrame:
    """One text column: each row a whole WARC record, without the two line ends that close it. written: the time stamp of all records, now by default."""
    head = F.concat(F.lit(HTTP_HEAD), F.col("n_bytes").cast("string"), F.lit(CRLF + CRLF))
    revisit = F.col("original").isNotNull()
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("html")))
    target = lambda c: F.regexp_replace(c, r"[\r\n]", "")
    date = F.date_format(F.to_utc_timestamp(F.current_timestamp() if written is None else written, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), F.col("record_id")),
        F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("WARC-Target-URI: "), target("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), F.col("original_record"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To-Target-URI: "), target("original_url"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To-Date: "), date)),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.concat(F.lit("Page-ID: "), F.url_encode("page_id")),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return planned.select(F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block).alias("value"))


def write_archives(planned: DataFrame, path: str, records_per_file: int = 500, compression: str = "gzip") -> None:
    """Archives in the folder `path`; records_per_file bounds an archive, which is read by one task."""
    records(planned).write.option("lineSep", CRLF + CRLF).option("compression", compression).option("maxRecordsPerFile", records_per_file).text(path)


def parse_archive(data: bytes) -> Iterator[tuple]:
    """The columns of PARSED for each record; fails where a record is not as the format says."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split(CRLF)
        if first != "WARC/1.1":
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        start, length = end + 4, int(fields["Content-Length"])
        block = data[start : start + length]
        at = start + length + 4
        if data[at - 4 : at] != b"\r\n\r\n":
            raise ValueError(f"the record before byte {at} does not end")
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        full = fields["WARC-Type"] == "response"
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if full else None
        page = unquote_plus(fields["Page-ID"]) if "Page-ID" in fields else None
        yield (page, fields["WARC-Type"], fields["WARC-Record-ID"], fields.get("WARC-Refers-To"), len(payload) if full else None, digest, fields["WARC-Payload-Digest"].removeprefix("sha1:"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """PARSED of every record in the archives below path."""
    import gzip

    names = [part.split()[0] for part in PARSED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                data = content.as_py()
                rows = list(parse_archive(gzip.decompress(data) if data.startswith(GZIP) else data))
                columns = [pa.array([r[i] for r in rows], type=pa.int64() if n == "payload_bytes" else pa.string()) for i, n in enumerate(names)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").mapInArrow(run, PARSED)


def resolve_revisits(parsed: DataFrame) -> DataFrame:
    """page_id, payload size and digest (of the full payload), record_type and refers_to (a page id) of every record."""
    responses = parsed.where("record_type = 'response'")  # record ids are unique
    originals = responses.select(F.col("record_id").alias("found"), F.col("page_id").alias("original"), F.col("payload_bytes").alias("bytes"), F.col("payload_digest").alias("digest"))
    met = parsed.join(originals, parsed["refers_to"] == originals["found"], "left")
    digest = F.coalesce("payload_digest", "digest")
    checked = F.when(digest == F.col("stated_digest"), digest).otherwise(F.raise_error(F.concat(F.lit("payload digest differs: "), F.col("record_id"))))
    return met.select("page_id", F.coalesce("payload_bytes", "bytes").alias("payload_bytes"), checked.alias("payload_digest"), "record_type", F.col("original").alias("refers_to"))


def archive_and_resolve(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", path: str | None = None) -> DataFrame:
    """Writes the archives of pages and returns what they say when read back. They stay in the folder `path`; without one they are in
    the shared folder and go once they were read."""
    spark = pages.sparkSession
    where = path or shared_path(spark, "warc")
    mean = pages.agg(F.avg(F.coalesce(F.octet_length(html_col), F.lit(0)))).first()[0] or 0
    write_archives(plan_records(pages, least_bytes, id_col, url_col, html_col), where, max(1, int(ARCHIVE_BYTES / (mean + HEADER_BYTES))), "none")
    kind = pages.schema[id_col].dataType
    parsed = cut_lineage(read_archives(spark, where))  # headers and digests only: archives are read once
    if path is None:
        discard(spark, where)
    found = resolve_revisits(parsed)
    return found.select(F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind))


#: The same rows for DuckDB; 160 bits are eight runs of five hex digits, and each run is four base32 digits.
ORACLE = f"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), digested AS (
  SELECT page_id, payload_bytes, {" || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(h, {1 + 5 * i}, 5))::BIGINT) >> {5 * k}) & 31)::INT, 1)" for i in range(8) for k in (3, 2, 1, 0))} AS payload_digest
  FROM hashed
), ranked AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM digested
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM ranked
"""


def op10_warc_revisits(spark, sf_dir: str) -> DataFrame:
    return archive_and_resolve(spark.read.parquet(f"{sf_dir}/pages.parquet"), least_bytes=0)
