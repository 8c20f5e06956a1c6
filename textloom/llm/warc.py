"""Content-addressed web archive: payloads stored once, exact record headers beside them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import scratch_path

REVISIT_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


def _lines(*parts) -> F.Column:
    """Header lines; a part that is null is left out."""
    return F.concat_ws(CRLF, *parts, F.lit(""))


def _headed(name: str, value) -> F.Column:
    return F.concat(F.lit(f"{name}: "), value)


def describe(pages: DataFrame) -> DataFrame:
    """(page_id, name, url, payload, payload_bytes, payload_digest) of pages; null html is empty.

    ``name`` is the page_id with a hash of the url, which tells pages apart that share an id.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    page = F.col("page_id").cast("long")
    name = F.concat_ws(":", F.coalesce(page.cast("string"), F.lit("none")), F.lower(F.hex(F.xxhash64("url"))))
    return pages.select(page.alias("page_id"), name.alias("name"), "url", payload.alias("payload")).select(
        "page_id",
        "name",
        "url",
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
    )


def with_headers(records: DataFrame, date: str) -> DataFrame:
    """Add the exact bytes before the payload: the WARC header and the HTTP header of the block.

    A line break inside a url is percent-encoded, as it would end the header line.
    """
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    record_id = F.concat(F.lit("<urn:x-page:"), "name", F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    http = _lines(F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), _headed("Content-Length", F.col("payload_bytes").cast("string")))
    http = F.concat(http, F.lit(CRLF))
    block_bytes = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    warc = _lines(
        F.lit("WARC/1.1"),
        _headed("WARC-Type", F.col("record_type")),
        _headed("WARC-Record-ID", record_id),
        F.lit(f"WARC-Date: {date}"),
        _headed("WARC-Target-URI", url),
        _headed("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(revisit, _headed("WARC-Refers-To", F.concat(F.lit("<urn:x-page:"), "response", F.lit(">")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        _headed("Content-Length", block_bytes.cast("string")),
    )
    return records.withColumns(
        {"warc_header": F.concat(warc, F.lit(CRLF)).cast("binary"), "http_header": http.cast("binary")}
    )


def write_archive(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``pages`` (page_id, url, html) as an archive of two Parquet tables under ``path``.

    ``headers`` holds one row per page with the exact header bytes and the payload's SHA-256;
    ``payloads`` holds each distinct payload once, keyed by that digest. Of pages with equal
    payloads of at least 100 bytes the smallest page_id is the response and the others revisit
    it; smaller payloads are always responses. Rows repeating the smallest page_id are
    responses too. A null page_id is a response only if its payload has no other page. Null
    html is an empty payload. An empty table gives two empty tables.
    """
    described = describe(pages)
    stored = described.select("payload_digest", "payload_bytes", "payload").dropDuplicates(["payload_digest"])
    stored.write.parquet(f"{path}/payloads")
    plain = described.select("page_id", "name", "url", "payload_bytes", "payload_digest")
    page = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "name"))
    shared = (
        plain.filter(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy("payload_digest")
        .agg(F.min(page).alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .select("payload_digest", F.col("first.page_id").alias("first"), F.col("first.name").alias("response"))
    )
    # Headers only; Spark splits the shuffle partition of a hot digest, whose other side is one row.
    joined = plain.join(shared.hint("merge"), "payload_digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    kind = F.when(revisit, "revisit").otherwise("response")
    records = with_headers(joined.withColumn("record_type", kind), date)
    records.select("payload_digest", "warc_header", "http_header").write.parquet(f"{path}/headers")


def header_field(name: str, pattern: str) -> F.Column:
    """The part of a WARC header line that the group of ``pattern`` matches; null without one."""
    text = F.decode("warc_header", "UTF-8")
    return F.nullif(F.regexp_extract(text, f"(?dm)^{name}: {pattern}\r$", 1), F.lit(""))


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, block_bytes, payload_digest, warc_header, http_header).

    All but the key of the payload is parsed from the header bytes.
    """
    page = "<urn:x-page:(-?[0-9]+):[0-9a-f]+>"
    return spark.read.parquet(f"{path}/headers").select(
        header_field("WARC-Record-ID", page).cast("long").alias("page_id"),
        header_field("WARC-Target-URI", "(.*)").alias("url"),
        header_field("WARC-Type", "(.*)").alias("record_type"),
        header_field("WARC-Refers-To", page).cast("long").alias("refers_to"),
        header_field("Content-Length", "([0-9]+)").cast("long").alias("block_bytes"),
        "payload_digest",
        "warc_header",
        "http_header",
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads; bytes that no longer have their digest stop the job."""
    found = spark.read.parquet(f"{path}/payloads")
    right = (F.sha2("payload", 256) == F.col("payload_digest")) & (
        F.octet_length("payload") == F.col("payload_bytes")
    )
    checked = F.when(right, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("payload_digest"))).cast("binary")
    )
    return found.select("payload_digest", checked.alias("payload"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """All records with their verified full payload and exact ``record`` bytes.

    A revisit's record has no payload in its block, but ``payload`` is that of the response. A
    record whose block is not as long as its header says stops the job.
    """
    records = read_headers(spark, path).join(read_payloads(spark, path).hint("merge"), "payload_digest", "left")
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    block = F.concat("http_header", body)
    short = F.raise_error(F.concat(F.lit("wrong length of record "), F.col("payload_digest"))).cast("binary")
    whole = F.when(F.octet_length(block) == F.col("block_bytes"), block).otherwise(short)
    end = F.lit((CRLF * 2).encode())
    return records.withColumn("record", F.concat("warc_header", whole, end))


def block_payload(record: str = "record") -> F.Column:
    """The bytes of a record after its two headers, without the line breaks that end it."""
    heads = F.octet_length("warc_header") + F.octet_length("http_header")
    return F.substring(record, heads + 1, F.octet_length(record) - heads - 2 * len(CRLF))


def op2(pages: DataFrame) -> DataFrame:
    """Write the archive to the shared folder, read the records back and describe them.

    Ids, types and references come from the header bytes; size and digest of a response from the
    bytes of its rebuilt record, those of a revisit from the payload that it refers to.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archive(pages, path)
    own = F.when(F.col("record_type") == "revisit", F.col("payload")).otherwise(block_payload())
    read = read_archive(spark, path).withColumn("payload", own)
    return read.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS t FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(encode(t)) AS BIGINT) AS payload_bytes, sha256(t) AS payload_digest FROM p
), f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first_id IS NOT NULL AND f.first_id <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id IS NOT NULL AND f.first_id <> d.page_id THEN f.first_id END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""
