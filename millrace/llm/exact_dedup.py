"""Exact deduplication through a sharded index of live digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import shuffle_width, staged
from millrace.llm.cuckoo import CuckooIndex

DIGESTS = "doc_id long, digest binary"
ENTRIES = "digest binary, keep_id long, live_rows long"


def normal_digest(text: str | None) -> bytes:
    """SHA-256 of the text in UTF-8 with A-Z lower-cased; null counts as empty."""
    return hashlib.sha256((text or "").encode().lower()).digest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [normal_digest(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "digest"]
        )


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest`` of every row."""
    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(_digests, DIGESTS)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One shard: each digest goes through the index; ``live_rows`` below 0 takes rows out."""
    index = CuckooIndex()
    for batch in batches:
        columns = (batch.column(i).to_pylist() for i in range(3))
        for digest, keep, rows in zip(*columns, strict=True):
            known = index.get(digest)
            if known is not None:
                keep = known[0] if keep is None else keep if known[0] is None else max(keep, known[0])
                rows += known[1]
            if rows:
                index.put(digest, (keep, rows))
            else:
                index.remove(digest)
    out = [(d, *v) for bucket in index.keys.values() for d, v in bucket.items()]
    for at in range(0, len(out), 50_000):
        part = list(zip(*out[at:at + 50_000], strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[0], pa.binary()), pa.array(part[1], pa.int64()), pa.array(part[2], pa.int64())],
            names=["digest", "keep_id", "live_rows"],
        )


def _per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of equal digest in a batch become one entry, so a hot digest is not moved as rows."""
    for batch in batches:
        t = pa.Table.from_batches([batch]).group_by("digest").aggregate(
            [("keep_id", "max"), ("live_rows", "sum")]
        )
        t = t.rename_columns({"keep_id_max": "keep_id", "live_rows_sum": "live_rows"})
        yield from t.select(["digest", "keep_id", "live_rows"]).to_batches()


def build_index(found: DataFrame) -> DataFrame:
    """Index of all digests: ``digest, keep_id, live_rows``, one row per live digest.

    A shard is what a hash of the digest sends to one task; the task holds a
    :class:`CuckooIndex` of the shard's distinct digests, so its memory is that of the number of
    distinct digests over the number of shuffle partitions.
    """
    entries = found.select("digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("live_rows"))
    return _sharded(entries.mapInArrow(_per_task, ENTRIES))


def add_to_index(index: DataFrame, found: DataFrame) -> DataFrame:
    """The index after the rows of ``found`` were added."""
    return _sharded(index.unionAll(build_index(found)))


def remove_from_index(index: DataFrame, found: DataFrame) -> DataFrame:
    """The index after rows were taken out; a digest without rows is no longer live.

    ``keep_id`` stays as it was where other rows of the digest remain.
    """
    gone = build_index(found).select("digest", F.lit(None).cast("long").alias("keep_id"), (-F.col("live_rows")).alias("live_rows"))
    return _sharded(index.unionAll(gone))


def _sharded(entries: DataFrame) -> DataFrame:
    width = shuffle_width(entries.sparkSession)
    return entries.repartition(width, F.xxhash64("digest")).mapInArrow(_fold, ENTRIES)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Which row of each group of equal texts stays: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are after lower-casing A-Z; a null text is an empty one. The row
    with the largest id stays; of several rows with that id all are marked as kept, and a null
    id stays only where its group has no other (``keep_id`` is null then). Every input row gives one row, an
    empty table none. Only the two named columns are read.

    A hot text is reduced to one entry per batch before the shuffle; the join that brings
    the groups back to the rows has one row per digest on its right side and can be split.
    """
    found = staged(digests(docs, id_col, text_col), "digests")
    index = build_index(found)
    return found.join(index, "digest").select(
        F.col("doc_id").alias(id_col), "keep_id", F.col("live_rows").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
