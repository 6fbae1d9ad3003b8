"""Queries of the file operators and verified writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.sinks import verified_write
from millrace.plans.registry import query, table
from millrace.session import scratch_path
from millrace.sources.files import (
    file_manifest,
    file_row_counts,
    object_path,
    pem_blocks,
    sync_plan,
)


@query("verified_write_counts", """
SELECT count(*) AS source_rows, count(*) AS target_rows FROM orders
""")
def _verified_write_counts(spark, sf):
    done = verified_write(table(spark, sf, "orders"), scratch_path(spark, "verified"))
    written = spark.read.parquet(done.target)
    return written.agg(
        F.lit(done.source_rows).cast("bigint").alias("source_rows"),
        F.count(F.lit(1)).alias("target_rows"),
    )


@query("file_row_counts", """
SELECT o_orderstatus AS status, count(*) AS row_count FROM orders GROUP BY 1
""")
def _file_row_counts(spark, sf):
    root = scratch_path(spark, "counted")
    table(spark, sf, "orders").write.partitionBy("o_orderstatus").option("header", True).csv(root)
    counts = file_row_counts(spark, root, recursive=True, glob="*.csv")
    status = F.regexp_extract("path", "o_orderstatus=([^/]*)/", 1)
    return counts.groupBy(status.alias("status")).agg(F.sum("row_count").alias("row_count"))


@query("file_manifest", """
SELECT o_orderstatus AS status,
       CAST(sum(strlen(o_orderkey || ',' || o_orderpriority) + 1) AS BIGINT) AS bytes
FROM orders GROUP BY 1
""")
def _file_manifest(spark, sf):
    root = scratch_path(spark, "manifest")
    table(spark, sf, "orders").select(
        "o_orderstatus", F.concat_ws(",", "o_orderkey", "o_orderpriority").alias("value")
    ).write.partitionBy("o_orderstatus").text(root)
    files = file_manifest(spark, root, glob="*.txt")
    status = F.regexp_extract("path", "o_orderstatus=([^/]*)/", 1)
    return files.groupBy(status.alias("status")).agg(F.sum("size").alias("bytes"))


@query("sync_plan", """
SELECT 'orders/' || o_orderkey AS path,
       CASE WHEN o_orderstatus <> 'O' THEN 'copy' WHEN o_custkey % 5 = 0 THEN 'unknown'
            ELSE 'delete_source' END AS action
FROM orders
""")
def _sync_plan(spark, sf):
    orders = table(spark, sf, "orders")
    path = F.format_string("orders/%d", "o_orderkey").alias("path")
    size = F.length("o_orderpriority")
    digest = F.sha2("o_orderpriority", 256).alias("checksum")
    source = orders.select(path, size.alias("size"), digest)
    # At the target, files of status F are missing, those of status P have changed (every other
    # one without a change of size), and of some the checksum is not known.
    changed = F.col("o_orderstatus") == "P"
    longer = (changed & (F.col("o_orderkey") % 2 == 0)).cast("int")
    other = F.when(changed, F.sha2(F.reverse("o_orderpriority"), 256)).when(F.col("o_custkey") % 5 > 0, digest)
    target = orders.where(F.col("o_orderstatus") != "F").select(
        path, (size + longer).alias("size"), other.alias("checksum")
    )
    return sync_plan(source, target).select("path", "action")


@query("pem_blocks", """
SELECT doc_id, 'CERTIFICATE' AS kind, CAST(strlen(text) AS INTEGER) AS der_length,
       sha256(text) AS fingerprint, TRUE AS whole FROM documents
UNION ALL
SELECT doc_id, 'PRIVATE KEY', CAST(strlen(lang || source) AS INTEGER), sha256(lang || source), TRUE
FROM documents
UNION ALL SELECT doc_id, 'Note', NULL, NULL, FALSE FROM documents WHERE doc_id % 3 = 0
UNION ALL SELECT doc_id, 'CERTIFICATE', NULL, NULL, FALSE FROM documents WHERE doc_id % 3 = 1
""")
def _pem_blocks(spark, sf):
    def block(kind, text):
        body = F.base64(F.encode(text, "UTF-8"))
        return F.concat(
            F.lit(f"-----BEGIN {kind}-----\n"), F.substring(body, 1, 64), F.lit("\n"),
            F.substring(body, F.lit(65), F.length(body)), F.lit(f"\n-----END {kind}-----\n"),
        )

    texts = table(spark, sf, "documents").select(
        "doc_id",
        F.concat(
            block("CERTIFICATE", F.col("text")), block("PRIVATE KEY", F.concat("lang", "source")),
            F.when(F.col("doc_id") % 3 == 0, block("Note", F.col("lang")))
            .when(F.col("doc_id") % 3 == 1, "-----BEGIN CERTIFICATE-----\nYQ==").otherwise(""),
        ).alias("text"),
    )
    return pem_blocks(texts)


@query("object_path_split", """
SELECT page_id, regexp_extract(url, '^https?://([^/]*)/(.*)$', 1) AS bucket,
       regexp_extract(url, '^https?://([^/]*)/(.*)$', 2) AS object
FROM pages
""")
def _object_path_split(spark, sf):
    path = F.regexp_replace("url", "^https?://", "gs://")
    return table(spark, sf, "pages").select("page_id", object_path(path).alias("o")).select(
        "page_id", "o.*"
    )


@query("sync_by_blocks", """
SELECT 'bucket=' || o_orderkey // 4096 AS folder,
       CASE WHEN o_orderkey // 4096 % 4 = 1 THEN 'copy' ELSE 'delete_source' END AS action,
       CAST(sum(strlen(o_orderkey || ',' || o_orderpriority) + 1) AS BIGINT) AS bytes
FROM orders GROUP BY ALL
""")
def _sync_by_blocks(spark, sf):
    """Two folders of equal files, but for some with their lines in another order, told apart by block digests."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.expr("o_orderkey div 4096").alias("bucket"), F.concat_ws(",", "o_orderkey", "o_orderpriority").alias("value")
    )
    turned = F.when(F.col("bucket") % 4 == 1, -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    sides = []
    for order in (F.col("o_orderkey"), turned):
        root = scratch_path(spark, "side")
        spread = orders.repartition("bucket").sortWithinPartitions("bucket", order)
        spread.select("bucket", "value").write.partitionBy("bucket").text(root)
        files = file_manifest(spark, root, glob="*.txt", checksum="blocks", block_bytes=4096)
        # The writer gives its files names of their own; a folder holds one file.
        sides.append(files.withColumn("path", F.substring_index("path", "/", 1)))
    plan = sync_plan(*sides)
    return plan.select(F.col("path").alias("folder"), "action", F.col("size").alias("bytes"))
