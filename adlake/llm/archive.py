"""Content-addressed WARC archive: payload bytes once, exact record headers apart.

An archive is a folder of two tables:

  payloads   digest, payload: the bytes of every different payload, once, named by SHA-256
  headers    the exact head of every record (WARC header block and HTTP header), its digest,
             and the key of the record that holds its payload

``records`` gives back every original record byte for byte, by a join on the digest, and
checks each stored payload against its name as it is read; a mismatch fails the read.

Of records with equal payloads of MIN_SHARED bytes or more, that with the smallest key is a
response and the others are revisits that refer to it; smaller payloads are always responses.

Defined cases: a null payload is empty. A null URL leaves its header line out; control
characters in a URL are percent-encoded. Rows that share a key and a payload are one page
written twice: each gets a record, and equal records stay repeated. A row with a null key is
the last of its payload's rows to be chosen as response. Other columns are not read. An
empty table gives an empty archive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.session import run_dir

MIN_SHARED = 100
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = ["page_id", "record_type", "payload_digest", "payload_bytes", "refers_to", "head"]


def _empty() -> Column:
    return F.lit("").cast("binary")


@dataclass(frozen=True)
class Archive:
    path: str

    @property
    def payloads(self) -> str:
        return f"{self.path}/payloads"

    @property
    def headers(self) -> str:
        return f"{self.path}/headers"


def _record_id(key: Column) -> Column:
    """A name-based identifier: version 5 layout over the hash of the key."""
    h = F.sha1(F.concat(F.lit("page:"), F.coalesce(key.cast("string"), F.lit("none"))).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), h.substr(1, 8), F.lit("-"), h.substr(9, 4), F.lit("-5"), h.substr(14, 3),
                    F.lit("-8"), h.substr(18, 3), F.lit("-"), h.substr(21, 12), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _head(date: str) -> Column:
    """The record's bytes before its payload."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    revisit = F.col("record_type") == "revisit"
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    return F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.col("record_type")), _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        F.when(F.col("url").isNotNull(), _line("WARC-Target-URI", url)).otherwise(""), _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(_line("WARC-Profile", F.lit(PROFILE)),
                                 _line("WARC-Refers-To", _record_id(F.col("refers_to"))))).otherwise(""),
        _line("Content-Type", F.lit("application/http; msgtype=response")), _line("Content-Length", block.cast("string")),
        F.lit("\r\n"), http)


def write_archive(pages: DataFrame, path: str, *, key: str = "page_id", url: str = "url", payload: str = "html",
                  date: str = DATE) -> Archive:
    """Archive a record for every row of pages in a new folder."""
    archive = Archive(path)
    body = F.coalesce(F.col(payload).cast("binary"), _empty())
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256)).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    # The content goes to the exchange once per different payload and task.
    (rows.groupBy("payload_digest").agg(F.first("payload").alias("payload"))
     .write.parquet(archive.payloads))
    large = F.col("payload_bytes") >= MIN_SHARED
    light = rows.drop("payload")
    first = (light.where(large).groupBy("payload_digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1"))
    told = light.join(first, "payload_digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    told = told.withColumn("record_type", F.when(again, "revisit").otherwise("response"))
    told = told.withColumn("refers_to", F.when(again, F.col("first")))
    told.withColumn("head", _head(date).cast("binary")).select(*HEADERS).write.parquet(archive.headers)
    return archive


def read_payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """(payload_digest, payload), each checked against its name."""
    held = spark.read.parquet(archive.payloads)
    good = F.sha2("payload", 256) == F.col("payload_digest")
    wrong = F.raise_error(F.concat(F.lit("damaged payload "), F.col("payload_digest")))
    return held.select("payload_digest", F.when(good, F.col("payload")).otherwise(wrong.cast("binary")).alias("payload"))


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record: its header table row, ``payload``, and ``record``, its original bytes."""
    heads = spark.read.parquet(archive.headers)
    rows = heads.join(read_payloads(spark, archive), "payload_digest", "left")
    missing = F.raise_error(F.concat(F.lit("no payload "), F.col("payload_digest"))).cast("binary")
    rows = rows.withColumn("payload", F.coalesce("payload", missing))
    body = F.when(F.col("record_type") == "revisit", _empty()).otherwise(F.col("payload"))
    return rows.select(*HEADERS, "payload", F.concat("head", body, F.lit("\r\n\r\n").cast("binary")).alias("record"))


def header_fields(record: Column) -> Column:
    """The named fields of a record's header block, as a map from lower-case name to value."""
    text = F.decode(record, "UTF-8")
    block = F.substring_index(text, "\r\n\r\n", 1)
    lines = F.filter(F.split(block, "\r\n"), lambda x: x.contains(": "))
    return F.map_from_entries(F.transform(lines, lambda x: F.struct(
        F.lower(F.substring_index(x, ": ", 1)), F.regexp_replace(x, "^[^:]*: ", ""))))


def archived_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages into a fresh archive, read it back, and tell each from its record."""
    archive = write_archive(pages, run_dir(spark, "llm-archive"))
    rows = read_archive(spark, archive)
    fields = header_fields(F.col("head"))
    told = rows.select("page_id", "refers_to", "payload", F.octet_length("record").alias("record_bytes"), fields.alias("f"))
    return told.select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.regexp_replace(F.col("f")["warc-payload-digest"], "^sha256:", "").alias("payload_digest"),
        F.col("f")["warc-type"].alias("record_type"), "refers_to", F.col("record_bytes").cast("long").alias("record_bytes"))
