"""Contiguous shards of near-equal bytes, by a global prefix sum over per-partition totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import staged, text_of

LAW = "bytes"


def byte_shards(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Cut the documents, in order of their id, into ``shards`` runs of near-equal bytes.

    A document's size is the UTF-8 length of its text plus one. Rows are range-partitioned by
    id, sizes are summed up within each partition, and the totals of the partitions before it
    are added: one row per partition meets in one task, never the documents. A document belongs
    to the shard in whose equal share of all bytes its middle lies, so no cut is further from
    its target than half a document.

    Returns ``<id>, size, text_crc32, law, shard, slot, grown_shard``; ``slot`` counts from 0
    within a shard, in order of id. ``grown_shard`` is null, since cuts by bytes all move when
    a shard is added.

    A null text has size 1 and checksum 0, as an empty one. Rows of equal or null id are ordered
    by checksum and size and each gets a slot of its own. An empty table gives no rows. Of the
    input only the two named columns are read, so others may have any name.
    """
    sized = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text_of(text_col)) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text_of(text_col).cast("binary")).alias("text_crc32"),
    )
    order = ["doc_id", "text_crc32", "size"]
    ranged = sized.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = staged(ranged, "shard-sizes")

    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    totals = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte_base"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("row_base"),
        F.sum("bytes").over(whole).alias("total"),
    )

    within = Window.partitionBy("part").orderBy(*order)
    placed = ranged.withColumns({
        "upto": F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)),
        "nth": F.row_number().over(within),
    }).join(totals, "part")
    middle = F.expr(f"(2 * (byte_base + upto) - size) * {int(shards)} div (2 * total)")
    placed = placed.select(
        "doc_id", "size", "text_crc32",
        F.least(middle, F.lit(shards - 1)).cast("int").alias("shard"),
        (F.col("row_base") + F.col("nth") - 1).alias("row"),
    )
    placed = staged(placed, "shard-rows")
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(first, "shard").select(
        F.col("doc_id").alias(id_col), "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("row") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
