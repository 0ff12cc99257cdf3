"""Content-addressed archive of WARC records.

``write_archive`` leaves two tables under a path:

* ``payloads``: each distinct payload once, under its SHA-256. Rows are combined by the payload's full
  bytes before and after the one shuffle they take, so a payload that a third of all pages share is
  one row for each task; an address that two different payloads share stops the write.
* ``headers``: the exact header bytes of every record (WARC header and HTTP head) and the address of
  its payload. Among equal payloads the record of the smallest page_id is ``response``, the others
  are ``revisit`` records without payload that name it.

``records`` joins both tables to the original records, byte for byte (the rows written with
``lineSep`` empty are a WARC file). ``read_records`` parses records and checks lengths and digests
of what it read; ``resolve`` gives revisits the payload facts of the record to which they refer.

Rows of a payload that many pages share are joined apart (``hot_join``).

Inputs: null html is an empty payload; payloads of any length are kept whole; a null url gives no
target URI, CR and LF in a url are written ``%0D`` and ``%0A``; a null page_id gives no page field and
is never the smallest unless all of a payload are null; rows that repeat the smallest page_id of a
payload are responses as well; an empty table gives an empty archive; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histwise.llm.common import hot_join, ready, shared_path, stored

#: The records' date where the caller names none: the tables hold no time of capture.
DATE = "1970-01-01T00:00:00Z"

# Line ends of the format, the HTTP head of a record, the profile of revisits.
LINE, BLANK = "\r\n", "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32, DIGITS32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def sha1_base32(payload: Column) -> Column:
    """SHA-1 in upper-case base32: of the 40 hex digits, ten are eight digits to base 32."""
    digits = [F.lpad(F.conv(F.substring(F.sha1(payload), 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*digits), DIGITS32, BASE32)


def record_id(page_id: Column, address: Column) -> Column:
    """A name of the record that follows from its page and payload."""
    h = F.md5(F.concat(F.coalesce(page_id.cast("string"), F.lit("-")), F.lit(":"), address))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def pages_with_address(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    return rows.withColumn("address", F.sha2("payload", 256))


def header(date: str) -> Column:
    """The header bytes of a record up to its payload, from page_id, url, address, digest, bytes, first_id, revisit."""
    own, first = record_id(F.col("page_id"), F.col("address")), record_id(F.col("first_id"), F.col("address"))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    length = F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("bytes")) + len(HTTP_HEAD)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(LINE))
    optional = lambda name, value: F.coalesce(line(name, value.cast("string")), F.lit(""))
    refers = F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", first), optional("X-Refers-To-Page", F.col("first_id")))
    return F.concat(
        F.lit(f"WARC/1.1{LINE}"), line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))), line("WARC-Record-ID", own),
        line("WARC-Date", F.lit(date)), optional("WARC-Target-URI", uri), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(F.col("revisit"), refers).otherwise(F.lit("")), line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", length.cast("string")), optional("X-Page-Id", F.col("page_id")), F.lit(LINE), F.lit(HTTP_HEAD))


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, date: str = DATE) -> None:
    """Write the archive of ``pages`` (page_id, url, html); payloads under ``min_bytes`` are response records
    for every page, stored once all the same."""
    spark = ready(pages.sparkSession)
    rows = pages_with_address(pages)
    once = rows.groupBy("address", "payload").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    once.select("address", "payload", sha1_base32(F.col("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("bytes"), "first_id", "n").write.option("compression", "zstd").parquet(f"{path}/payloads")
    payloads = spark.read.parquet(f"{path}/payloads")
    if not payloads.groupBy("address").count().where("count > 1").isEmpty():
        raise ValueError("two different payloads share a SHA-256")
    facts = payloads.select("address", "digest", "bytes", "first_id", "n")
    known = hot_join(rows.drop("payload"), facts, ["address"], "n", F.xxhash64("page_id", "url"))
    known = known.withColumn("revisit", ~F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("bytes") >= min_bytes))
    known.select(header(date).cast("binary").alias("header"), "address", "revisit").write.option("compression", "zstd").parquet(f"{path}/headers")


def records(spark: SparkSession, path: str, revisits: bool) -> DataFrame:
    """The original response or revisit records of an archive: record (binary, with its closing blank line)."""
    heads = spark.read.parquet(f"{path}/headers").where(F.col("revisit") == revisits)
    end = F.lit(BLANK).cast("binary")
    if revisits:
        return heads.select(F.concat("header", end).alias("record"))
    # a payload has one response, but for payloads below ``min_bytes`` and repeated rows
    several = heads.groupBy("address").agg(F.count("*").alias("responses"))
    payloads = spark.read.parquet(f"{path}/payloads").select("address", "payload").join(several, "address")
    whole = hot_join(heads.select("header", "address"), payloads, ["address"], "responses", F.xxhash64("header"))
    return whole.select(F.concat("header", "payload", end).alias("record"))


def field(head: Column, name: str) -> Column:
    found = F.regexp_extract(head, rf"\r\n{name}: ([^\r\n]*)(?:\r|$)", 1)
    return F.when(found != "", found)


def read_records(rows: DataFrame) -> DataFrame:
    """Parsed records of ``rows`` (record): record_id, page_id, record_type, refers_to (record) and refers_to_page,
    declared digest, payload. Broken lengths raise."""
    head = F.substring_index(F.col("record").cast("string"), BLANK, 1)
    out = rows.withColumn("head", head).withColumn("at", F.octet_length("head") + 4).withColumn("length", field(F.col("head"), "Content-Length").cast("int"))
    whole = (F.octet_length("record") == F.col("at") + F.col("length") + 4) & F.col("head").startswith("WARC/1.1")
    out = out.withColumn("block", F.when(F.coalesce(whole, F.lit(False)), F.substring("record", F.col("at") + 1, F.col("length"))).otherwise(F.raise_error(F.lit("broken record")).cast("binary")))
    http = F.octet_length(F.substring_index(F.col("block").cast("string"), BLANK, 1)) + 4
    return out.select(
        field(F.col("head"), "WARC-Record-ID").alias("record_id"), field(F.col("head"), "X-Page-Id").cast("long").alias("page_id"),
        field(F.col("head"), "WARC-Type").alias("record_type"), field(F.col("head"), "WARC-Refers-To").alias("refers_to"),
        field(F.col("head"), "X-Refers-To-Page").cast("long").alias("refers_to_page"),
        F.substring(field(F.col("head"), "WARC-Payload-Digest"), 6, 32).alias("digest"), F.substring("block", http + 1, F.col("length")).alias("payload"))


def resolve(spark: SparkSession, path: str) -> DataFrame:
    """Every record of an archive with length and digest of its full payload, as read back: a response's from
    its own bytes (checked against the declared digest), a revisit's from the record to which it refers."""
    read = read_records(records(spark, path, revisits=False)).withColumn("found", sha1_base32(F.col("payload")))
    digest = F.when(F.col("found") == F.col("digest"), F.col("found")).otherwise(F.raise_error(F.lit("payload does not match its digest")).cast("string"))
    responses = stored(read.select("page_id", "record_type", "record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), digest.alias("payload_digest")), "warc-responses")
    revisits = read_records(records(spark, path, revisits=True)).select("page_id", "record_type", "refers_to", "refers_to_page", "digest")
    asked = revisits.groupBy(F.col("refers_to").alias("record_id")).agg(F.count("*").alias("n"))
    facts = responses.dropDuplicates(["record_id"]).join(asked, "record_id").select(F.col("record_id").alias("refers_to"), "payload_bytes", "payload_digest", "n")
    full = hot_join(revisits, facts, ["refers_to"], "n", F.xxhash64("page_id"))
    same = F.when(F.col("payload_digest") == F.col("digest"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("revisit of another payload")).cast("string"))
    return responses.select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")).unionByName(
        full.select("page_id", "payload_bytes", same.alias("payload_digest"), "record_type", F.col("refers_to_page").alias("refers_to")))


def contract(pages: DataFrame) -> DataFrame:
    path = shared_path(pages.sparkSession, "warc")
    write_archive(pages, path)
    return resolve(pages.sparkSession, path)


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h,
                  min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least FROM pages)
SELECT page_id, strlen(t)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM least THEN least END AS refers_to
FROM p
"""
