"""What the operators share: intermediate tables, input columns, components of a graph."""

from __future__ import annotations

import os
import pathlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_ROUNDS = 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_package(spark: SparkSession) -> SparkSession:
    """The session, whose Python workers find this package where the driver has found it.

    On a cluster the package has to be installed or sent along; a path that is not there does no harm.
    """
    root = str(pathlib.Path(__file__).resolve().parents[2])
    settings = spark.sparkContext.environment
    paths = [p for p in settings.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        settings["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts lineage: what follows survives lost executors without running ``df`` again, and
    two readers see the same rows.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """The cluster's number of shuffle partitions, for a ``repartition`` by key."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


BLOOM_BITS = 1 << 23


def bloom_words(ids: DataFrame, id_col: str) -> np.ndarray:
    """A filter of fixed size over the ids: one bit each of ``BLOOM_BITS``, as 64-bit words.

    The bits are set by a partial aggregate; at most ``BLOOM_BITS / 64`` words come to the driver.
    """
    bit = F.pmod(F.xxhash64(id_col), F.lit(BLOOM_BITS))
    words = ids.select(bit.alias("bit")).select(
        (F.col("bit") / 64).cast("int").alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int")).alias("mask"),
    ).groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(BLOOM_BITS // 64, dtype=np.int64)
    out[words["word"].to_numpy()] = words["mask"].to_numpy()
    return out


def may_be_in(words: np.ndarray, frame: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``frame`` whose id may be in the filter, before they are shuffled for a join.

    It lets through all rows with an id in it, and others by chance: few as long as the ids
    are far fewer than the bits, more beyond that. What it lets through by chance the join drops.
    """
    def run(batches):
        for batch in batches:
            bit = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            kept = (words[bit >> 6] >> (bit & 63)) & 1 == 1
            if kept.any():
                yield batch.filter(pa.array(kept)).select(range(batch.num_columns - 1))

    bits = frame.withColumn("_bit", F.pmod(F.xxhash64(id_col), F.lit(BLOOM_BITS)))
    return bits.mapInArrow(run, frame.schema)


def text_slices(batch: pa.RecordBatch, column: int, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``limit`` bytes of a text column, or one row that is longer."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes + 64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of undirected ``edges`` (``a``, ``b``) as ``node``, ``component``.

    The component is the smallest node that can be reached. Alternates two steps until nothing
    changes: every larger neighbour of a node is tied to the least one around it, then every
    node and its smaller neighbours are. The rounds grow with the logarithm of the longest
    path. Minima are partial aggregates and hot nodes are one row on their side of the join,
    so a node with very many edges is neither gathered nor paired with itself.
    Loops and repeated edges do no harm; nodes without an edge to another one are left out.
    """
    now = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    now = staged(now, label)
    seen = _mark(now)
    for _ in range(MAX_ROUNDS):
        if seen[0] == 0:
            break
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = staged(small.unionAll(low.select("a", F.col("m").alias("b"))).distinct(), label)
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components: no end after {MAX_ROUNDS} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def _mark(edges: DataFrame) -> tuple:
    """Tells one set of edges from another: their number and two sums of hashes."""
    row = edges.agg(
        F.count("*"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        F.sum(F.hash("b", "a").cast("long")),
    ).first()
    return tuple(row)
