"""WARC archives without repeated payloads: revisit resolution.

Headers are grouped by payload digest; the first capture of a payload stays a ``response`` and later ones become
``revisit`` records that refer to it.  Archives are written by Spark's text sink: the separator of two records in a
WARC file, an empty line twice, is the sink's line separator, and a record is the header, an empty line and the block.
They are read back whole (``max_records`` bounds a file) and cut by ``Content-Length``, so a payload may contain
anything.

Equal payloads of at least ``min_bytes`` have one response, the capture with the smallest (id, URL), nulls last.
Rows equal in id, URL and payload are the same capture written twice: with the smallest id each of them is a response.
Null payloads are empty; a null id or URL has no header.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpulse.llm.common import id_of, ship, table, text_of
from regionpulse.session import scratch_path, stage

MIN_BYTES = 100
MAX_RECORDS = 10_000
END = "\r\n"
#: Fixed value of the standard for revisits of an equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = "page_id long, url string, record_id string, record_type string, refers_to_record string, declared_digest string, payload_bytes long, payload_digest string"


def captures(pages: DataFrame) -> DataFrame:
    """page_id, url, payload and its digest and size."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_of("html").alias("payload")
    )
    return rows.select(
        "*", F.sha2(F.col("payload").cast("binary"), 256).alias("digest"), F.octet_length("payload").cast("long").alias("size")
    ).withColumn("record_id", _uuid(F.concat_ws("\n", F.col("page_id").cast("string"), "digest", F.coalesce("url", F.lit("\t")))))


def _uuid(text: Column) -> Column:
    """A name-based id: the same record has the same id when a lost task runs again."""
    return F.regexp_replace(F.md5(text), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def resolve(rows: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``captures`` with ``original``: the record that a revisit refers to, null for responses.

    Only digests that occur more than once are kept between the two steps, as a table of their own, so that the join
    can be split where one payload holds much of the input.
    """
    first = F.min(F.struct(id_of("page_id").alias("id"), F.coalesce("url", F.lit("\U0010ffff")).alias("url"), F.col("record_id").alias("original")))
    repeated = stage(
        rows.where(F.col("size") >= min_bytes)
        .groupBy("digest")
        .agg(first.alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", F.col("first.original").alias("original"), F.col("first.url").alias("original_url"))
    )
    return rows.join(repeated, "digest", "left").withColumn(
        "original", F.when(F.col("original") != F.col("record_id"), F.col("original"))
    )


def write_archives(rows: DataFrame, path: str, date: str | None = None, max_records: int = MAX_RECORDS) -> None:
    """``resolve``d captures as WARC 1.1 files, compressed; a revisit has no payload."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(END))
    clean = lambda url: F.regexp_replace(url, "[\\s\\p{Cntrl}]", "%20")
    revisit = F.col("original").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"), line("Content-Length", F.col("size")), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    header = F.concat_ws(
        "",
        F.lit(f"WARC/1.1{END}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), "record_id", F.lit(">"))),
        F.lit(f"WARC-Date: {date}{END}"),
        line("WARC-Target-URI", clean(F.col("url"))),
        line("WARC-Page-ID", F.col("page_id")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}{END}")),
        F.when(revisit, line("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), "original", F.lit(">")))),
        F.when(revisit & (F.col("original_url") != "\U0010ffff"), line("WARC-Refers-To-Target-URI", clean(F.col("original_url")))),
        F.lit(f"Content-Type: application/http;msgtype=response{END}"),
        line("Content-Length", F.octet_length("block")),
        F.lit(END),
    )
    rows.withColumn("block", block).select(F.concat(header, F.col("block")).alias("value")).write.mode("overwrite").option(
        "lineSep", END + END
    ).option("compression", "gzip").option("maxRecordsPerFile", max_records).text(path)


def _records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of one compressed file."""
    data = zlib.decompressobj(31).decompress(content)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        stop = end + 4 + int(fields["Content-Length"])
        yield fields, data[end + 4 : stop]
        at = stop + 4


def _id(value: str | None) -> str | None:
    return value and value.removeprefix("<urn:uuid:").removesuffix(">")


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in HEADERS.split(", ")]
    for batch in batches:
        for content in batch["content"]:
            rows = []
            for fields, block in _records(content):
                payload = block[block.index(b"\r\n\r\n") + 4 :]
                rows.append((
                    int(fields["WARC-Page-ID"]) if "WARC-Page-ID" in fields else None, fields.get("WARC-Target-URI"),
                    _id(fields["WARC-Record-ID"]), fields["WARC-Type"], _id(fields.get("WARC-Refers-To")),
                    fields["WARC-Payload-Digest"].removeprefix("sha256:"), len(payload), hashlib.sha256(payload).hexdigest(),
                ))
            frame = pd.DataFrame(rows, columns=names)
            yield frame.astype({"page_id": "Int64"})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives in ``path``: its header fields, and size and digest of the payload it holds."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInPandas(_parsed, HEADERS)


def follow(records: DataFrame) -> DataFrame:
    """Every record with the payload it stands for: revisits are joined to the responses they refer to."""
    originals = records.where("record_type = 'response'").groupBy("record_id").agg(
        F.min("page_id").alias("refers_to"), F.first("payload_bytes").alias("bytes"), F.first("payload_digest").alias("sha256")
    )
    originals = stage(originals.join(records.where("record_type = 'revisit'").select(F.col("refers_to_record").alias("record_id")).distinct(), "record_id", "left_semi"))
    responses = records.where("record_type = 'response'").select(
        "page_id", "url", "payload_bytes", "payload_digest", "declared_digest", "record_type", F.lit(None).cast("long").alias("refers_to")
    )
    revisits = (
        records.where("record_type = 'revisit'")
        .join(originals.withColumnRenamed("record_id", "refers_to_record"), "refers_to_record")
        .select("page_id", "url", F.col("bytes").alias("payload_bytes"), F.col("sha256").alias("payload_digest"), "declared_digest", "record_type", "refers_to")
    )
    return responses.unionByName(revisits)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archives of all pages, reads them back and follows the revisits."""
    path = scratch_path(spark, "warc")
    write_archives(resolve(captures(table(spark, sf_dir, "pages"))), path)
    records = stage(read_archives(spark, path))
    return follow(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        (F.col("payload_digest") == F.col("declared_digest")).alias("intact"),
    )


ORACLE = """
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
       CASE WHEN bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN bytes >= 100 AND place > 1 THEN first_id END AS refers_to, TRUE AS intact
FROM (SELECT *, rank() OVER (PARTITION BY digest ORDER BY page_id NULLS LAST, url NULLS LAST) AS place, min(page_id) OVER (PARTITION BY digest) AS first_id
      FROM (SELECT page_id, url, strlen(coalesce(html, '')) AS bytes, sha256(coalesce(html, '')) AS digest FROM pages))
"""

ship(__name__)
