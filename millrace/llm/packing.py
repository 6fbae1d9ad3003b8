"""Best-fit decreasing packing of token sequences into fixed-size bins."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import staged, text_of
from millrace.llm.tokens import ByteBpe

CAPACITY = 1024
END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
PLACES = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class SegmentTree:
    """Counts of open bins by remaining capacity; finds the tightest that fits in log time."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1
        while self.leaves <= capacity:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)

    def add(self, remaining: int, bins: int) -> None:
        at = remaining + self.leaves
        while at:
            self.count[at] += bins
            at //= 2

    def tightest(self, need: int) -> int:
        """The least remaining capacity of at least ``need`` that an open bin has, or -1."""
        at = need + self.leaves
        if self.count[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return -1


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Place ``counts[length]`` items of each length, longest first, each into the tightest bin.

    Items of one length are alike, and so are bins of one remaining capacity; a run of items
    therefore goes to a run of bins in one step, which gives the bins that placing item by item gives.
    Returns steps ``(length, first item, first bin, items, offset)``: the items of that length
    from ``first item`` on lie in the bins from ``first bin`` on, at ``offset``. The number of
    steps is bounded through ``capacity``, whatever the number of items.
    """
    tree = SegmentTree(capacity)
    runs: dict[int, deque] = {}
    steps, bins = [], 0

    def open_run(remaining: int, first: int, n: int) -> None:
        if remaining:
            runs.setdefault(remaining, deque()).append((first, n))
            tree.add(remaining, n)

    for length in sorted(counts, reverse=True):
        item, left = 0, counts[length]
        while left:
            remaining = tree.tightest(length)
            if remaining < 0:
                remaining, first, n = capacity, bins, left  # as many new bins as it takes
            else:
                first, n = runs[remaining].popleft()
                tree.add(remaining, -n)
            # A bin that has just taken an item is tighter than its like, so it takes what it can.
            each = remaining // length
            placed = min(left, n * each)
            full, rest = divmod(placed, each)
            used = full + (rest > 0)
            for k in range(min(each, placed)):
                on = full + (k < rest)
                steps.append((length, item, first, on, capacity - remaining + k * length))
                item += on
            if full:
                open_run(remaining - each * length, first, full)
            if rest:
                open_run(remaining - rest * length, first + full, 1)
            if first == bins:
                bins += used
            elif used < n:
                runs[remaining].appendleft((first + used, n - used))
                tree.add(remaining, n - used)
            left -= placed
    return steps


def _pieces(tokenizer_file: str, capacity: int, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        bpe, seen = ByteBpe(tokenizer_file), [0] * (capacity + 1)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), bpe.encode(texts), strict=True):
                ids += end
                total = len(ids) // 4
                start, length = 0, total if total <= capacity else total % capacity or capacity
                piece = 0
                while start < total:
                    crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                    rows.append((doc_id, piece, start, length, crc, part, seen[length]))
                    seen[length] += 1
                    start, length, piece = start + length, capacity, piece + 1
            yield pa.RecordBatch.from_pylist(
                [dict(zip(PIECE_SCHEMA.names, r, strict=True)) for r in rows], schema=PIECE_SCHEMA
            )

    return run


PIECE_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64()),
])


def _place(steps: np.ndarray) -> Callable:
    """Look each piece up among the steps, by its length and its rank in that length."""
    key = steps[:, 0] << 48 | steps[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(key, length << 48 | rank, side="right") - 1
            found = steps[at]
            columns = [batch.column(i) for i in range(5)]
            columns += [pa.array(found[:, 2] + rank - found[:, 1]), pa.array(found[:, 4])]
            yield pa.RecordBatch.from_arrays(columns, names=PLACE_NAMES)

    return run


PLACE_NAMES = [c.split()[0] for c in PLACES.split(", ")]


def pack(
    docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens, best fit decreasing.

    A document's tokens are the ids of its text and then ``end_id``; one longer than the
    capacity is cut so that its first piece may be shorter and all others are full. Returns
    ``<id>, piece, start, length, ids_crc32, sequence_id, offset``, a row per piece.

    Texts are encoded once and only the pieces' lengths are kept. The plan needs no more than
    the number of pieces of each length: at most ``capacity`` rows come to the driver, where a
    segment tree over remaining capacities finds the tightest bins for runs of equal pieces.
    A piece finds its place through its rank among the pieces of its length, which is its rank
    within the task plus the counts of the tasks before it. The plan's size is bounded through
    ``capacity`` too.

    A null or empty text is the one token ``end_id``. Repeated rows and ids are separate
    documents, null ids included. An empty table gives no rows. Only the two named columns are
    read.
    """
    pieces = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    pieces = staged(pieces.mapInArrow(_pieces(tokenizer_file, capacity, end_id), PIECES), "pieces")
    by_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = sorted(best_fit_decreasing(counts, capacity))
    plan = np.array(steps, dtype=np.int64).reshape(-1, 5)

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank")
    )
    placed = ranked.mapInArrow(_place(plan), PLACES)
    return placed.withColumnRenamed("doc_id", id_col)
