"""A content-addressed WARC archive: payloads once by digest, exact headers beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_BYTES = 100  # smaller payloads are never recorded as revisits
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null. Line breaks in a value are percent-encoded."""
    clean = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(EOL)), F.lit(""))


def _record_id(column: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.col(column).cast("string"), F.lit(">"))


def _pages(pages: DataFrame, id_col: str, url_col: str, body_col: str) -> DataFrame:
    body = F.coalesce(F.col(body_col).cast("binary"), F.lit(b""))
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), body.alias("payload"),
        F.octet_length(body).cast("long").alias("bytes"), F.sha2(body, 256).alias("digest"),
    )


def write_archive(
    pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url",
    body_col: str = "html", least_bytes: int = LEAST_BYTES, date: str = DATE,
) -> None:
    """Write one record per row below ``path``: ``payloads`` by SHA-256, and ``headers``.

    Of the records with equal payloads of at least ``least_bytes``, the one with the smallest id is
    the response and the others revisit it (rows that repeat the smallest id are responses too).
    Smaller payloads are always responses. Each distinct payload is stored once, whatever its
    size. Headers are kept as the exact text of the record's header block.

    A null body is an empty payload, a null url leaves its header line out, a null id gives a
    record without id which is never revisited unless all ids of its payload are null. An empty table
    gives an empty archive. Only the three named columns are read.

    The first holders of the digests are a partial aggregate without the payload, so a hot payload is not
    moved for it; the joins have one row per digest on one side and can be split.
    """
    rows = _pages(pages, id_col, url_col, body_col)
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first_id"))
    # One stored copy even where rows repeat. A digest has one first id, so one row per pair of them is one per
    # digest, and the shuffle of the join does for both. Copies of a payload with other ids lie in other partitions.
    pair = first.select(F.struct("digest", F.col("first_id").alias("page_id")).alias("holder"))
    holders = rows.select(F.struct("digest", "page_id").alias("holder"), "bytes", "payload").join(pair, "holder", "left_semi")
    payloads = holders.dropDuplicates(["holder"]).select("holder.digest", "bytes", "payload")
    payloads.write.option("compression", "zstd").parquet(f"{path}/payloads")

    again = (F.col("bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    kind = F.when(again, "revisit").otherwise("response")
    header = F.concat(
        F.lit(VERSION + EOL),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", _record_id("page_id")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Profile", F.when(again, PROFILE)),
        _line("WARC-Refers-To", F.when(again, _record_id("first_id"))),
        _line("Content-Type", F.when(~again, "text/html; charset=utf-8")),
        _line("Content-Length", F.when(again, 0).otherwise(F.col("bytes"))),
    )
    rows.drop("payload").join(first, "digest").select("digest", header.alias("header")).write.option(
        "compression", "zstd"
    ).parquet(f"{path}/headers")


def _field(name: str) -> Column:
    found = F.regexp_extract("header", f"(?m)^{name}: ([^\\r\\n]*)", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive, each with its whole payload, through a join on the digest.

    Returns ``page_id, url, header, record_type, refers_to, payload, payload_bytes,
    payload_digest``. Length and digest are worked out anew from the stored payload, once per
    payload; a stored payload that no longer has its digest gives a null ``payload_digest``.
    """
    payloads = spark.read.parquet(f"{path}/payloads").select(
        "digest", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.sha2("payload", 256) == F.col("digest"), F.col("digest")).alias("payload_digest"),
    )
    number = "<urn:page:(-?\\d+)>"
    headers = spark.read.parquet(f"{path}/headers")
    return headers.join(payloads, "digest").select(
        F.regexp_extract(F.coalesce(_field("WARC-Record-ID"), F.lit("")), number, 1).try_cast("long").alias("page_id"),
        _field("WARC-Target-URI").alias("url"), "header", _field("WARC-Type").alias("record_type"),
        F.regexp_extract(F.coalesce(_field("WARC-Refers-To"), F.lit("")), number, 1).try_cast("long").alias("refers_to"),
        "payload", "payload_bytes", "payload_digest",
    )


def export_warc(spark: SparkSession, archive: str, path: str, records_per_file: int = 20_000) -> None:
    """Write the records of an archive as gzip-compressed WARC files.

    Payloads have to be UTF-8. A response carries its payload, a revisit none.
    """
    records = read_archive(spark, archive)
    body = F.when(F.col("record_type") == "response", F.decode("payload", "utf-8")).otherwise("")
    records.select(F.concat("header", F.lit(EOL), body).alias("record")).write.option(
        "lineSep", EOL + EOL
    ).option("maxRecordsPerFile", records_per_file).option("compression", "gzip").text(path)
