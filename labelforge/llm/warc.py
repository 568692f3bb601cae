"""Operator 8: WARC archives with revisit records for repeated payloads.

Only headers are shuffled: the payload digest (SHA-1, base32) and the length meet per
group, where the record with the largest page_id is the original.  Groups of one need no
answer; the others are joined back, salted, to the pages where those lie.  Responses
carry their payload, revisits refer to the original; both get fresh headers.  Spark's
text writer puts records one after another, each ended by an empty line as the format
wants; the reader walks through an archive by the records' Content-Length.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelforge.llm.common import read, written
from labelforge.session import fresh_path

LEAST_BYTES, ARCHIVE_BYTES, SALTS = 0, 16 << 20, 16
DATE = "2024-01-01T00:00:00Z"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of a string's UTF-8 bytes in bare upper-case base32."""
    digest = F.sha1(payload.cast("binary"))
    signs = []
    for k in range(8):  # five hex digits are four base32 signs
        bits = F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            signs.append(F.substring(F.lit(ALPHABET), at, F.lit(1)))
    return F.concat(*signs)


def resolve(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``pages(page_id, url, html)``, other columns ignored, with payload, payload_bytes, payload_digest, _record (its
    position in the input), and for revisits original_id and original_record."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
                        F.octet_length(payload).cast("long").alias("payload_bytes"),
                        base32_sha1(payload).alias("payload_digest"),
                        F.monotonically_increasing_id().alias("_record"))
    keys = ["payload_digest", "payload_bytes"]
    groups = rows.where(F.col("payload_bytes") >= least_bytes).groupBy(*keys) \
        .agg(F.max(F.struct("page_id", "_record")).alias("o"), F.count(F.lit(1)).alias("n")).where("n > 1") \
        .select(F.col("payload_digest").alias("_d"), F.col("payload_bytes").alias("_b"),
                F.col("o.page_id").alias("original_id"), F.col("o._record").alias("original_record"))
    # written, so that Spark knows its size: a few repeats need no shuffle of the payloads
    groups = written(groups, "revisits").withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_record"), F.lit(SALTS)).cast("int"))
    joined = salted.join(groups, (salted["payload_digest"] == groups["_d"])
                         & (salted["payload_bytes"] == groups["_b"]) & (salted["_salt"] == groups["_s"]), "left")
    own = F.col("original_record").isNull() | (F.col("original_record") == F.col("_record"))
    return joined.select("page_id", "url", "payload", "payload_bytes", "payload_digest", "_record",
                         F.when(~own, F.struct("original_id", "original_record")).alias("original"))


def _uri(page: Column, record: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(":"),
                    record.cast("string"), F.lit(">"))


def records(resolved: DataFrame, date: str = DATE) -> DataFrame:
    """One WARC record per row, as text without its closing empty line."""
    revisit = F.col("original").isNotNull()
    size = F.col("payload_bytes").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "),
                    size, F.lit(_END * 2))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    uri = F.regexp_replace(F.coalesce("url", F.lit("about:blank")), "[\\x00-\\x20\\x7f]", "%20")
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
             F.concat(F.lit("WARC-Record-ID: "), _uri(F.col("page_id"), F.col("_record"))),
             F.lit(f"WARC-Date: {date}"), F.concat(F.lit("WARC-Target-URI: "), uri),
             F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
             F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}{_END}WARC-Refers-To: "),
                                      _uri(F.col("original.original_id"), F.col("original.original_record")))),
             F.lit("Content-Type: application/http; msgtype=response"),
             F.concat(F.lit("Content-Length: "), block.cast("string"))]
    head = F.concat_ws(_END, *lines)  # leaves out the lines that are null
    body = F.when(revisit, "").otherwise(F.col("payload"))
    return resolved.select(F.concat(head, F.lit(_END * 2), http, body).alias("record"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Deduplicated archives of ``pages`` under ``path``, of about ``archive_bytes`` each."""
    mean = pages.agg(F.avg(F.coalesce(F.octet_length("html"), F.lit(0)) + 600).alias("n")).first()["n"] or 600
    records(resolve(pages, least_bytes)).write.option("lineSep", _END * 2) \
        .option("maxRecordsPerFile", max(1, int(archive_bytes / mean))).text(path)


def parse(data: bytes):
    """(headers, block) of the records of an archive, by their Content-Length."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:head].split(b"\r\n")
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.lower().decode(): v.strip().decode() for k, v in (x.split(b":", 1) for x in lines)}
        end = head + 4 + int(headers["content-length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end at byte {end}")
        yield headers, memoryview(data)[head + 4:end]
        at = end + 4


def _page(uri: str) -> int | None:
    page = uri.strip("<>").split(":")[2]
    return None if page == "none" else int(page)


def read_archives(spark, path: str) -> DataFrame:
    """Per record of the archives: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to.  A response's digest is that of the bytes read; one that does not agree with
    its header is an error."""
    def rows(it):
        for batch in it:
            for data in batch.column(0).to_pylist():
                out = {k: [] for k in ("page_id", "url", "payload_bytes", "payload_digest", "record_type",
                                       "refers_to")}
                for headers, block in parse(data):
                    cut = bytes(block[:4096]).index(b"\r\n\r\n") + 4
                    digest, kind = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"]
                    size = int(bytes(block[:cut]).lower().split(b"content-length:")[1].split(b"\r\n")[0])
                    if kind == "response":
                        found = base64.b32encode(hashlib.sha1(block[cut:]).digest()).decode()
                        if (found, len(block) - cut) != (digest, size):
                            raise ValueError(f"damaged payload in {headers['warc-record-id']}")
                    refers = headers.get("warc-refers-to")
                    for k, v in zip(out, (_page(headers["warc-record-id"]), headers["warc-target-uri"], size,
                                          digest, kind, _page(refers) if refers else None)):
                        out[k].append(v)
                yield pa.RecordBatch.from_pydict({
                    k: pa.array(v, pa.int64() if k in ("page_id", "payload_bytes", "refers_to") else pa.string())
                    for k, v in out.items()})
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(
        rows, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long")


def query(spark, sf_dir: str) -> DataFrame:
    """op8: the records read back from the archives of all pages.

    A null html is an empty payload; repeated rows of one page_id are records of their own,
    the last of which in the input is the original; a null page_id comes before all others.
    An empty table gives empty archives and no rows."""
    path = fresh_path(spark, "archives")
    write_archives(read(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    return read_archives(spark, path).drop("url")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                  sha1(coalesce(html, '')) AS x FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS top FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(x, 1 + 5 * CAST(k // 4 AS INT), 5) AS BIGINT)
                 >> CAST(5 * (3 - k % 4) AS INT)) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM g
"""
