"""Which rows share a 64-bit key with another row, without moving the others as rows."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import shuffle_width

ENTRY = np.dtype([("key", "<u8"), ("id", "<i8"), ("pos", "<i4"), ("shown", "u1")])
BUCKETS_PER_TASK = 8
CHUNK = 50_000
PACKED = "bucket int, kind int, body binary"
MEMBERS = "key long, id long, pos int"
PACKED_SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("body", pa.binary())])


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal keys in sorted ``keys``."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return starts, np.diff(np.append(starts, len(keys)))


def _shared(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First rows of the runs of a key, and which rows belong to keys of several ids."""
    starts, lengths = _runs(rows["key"])
    least, most = (f.reduceat(rows["id"], starts) for f in (np.minimum, np.maximum))
    return starts, np.repeat(least != most, lengths)


ASKED = 2  # a mark beside that of rows that have left: some row of the batch with this key asks


def _pack(emit: Callable, buckets: int, asked: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = None
        for batch in batches:
            task = task or emit()
            for keys, ids, places in task(batch):
                if not len(keys):
                    continue
                order = np.lexsort((ids, keys)) if asked else np.argsort(keys, kind="stable")
                rows = np.zeros(len(keys), dtype=ENTRY)
                rows["key"], rows["id"], rows["pos"] = keys[order], ids[order], places[order]
                starts, several = _shared(rows)
                rows["shown"] = several
                out = []
                # Rows whose key is shared within the batch need no one else to say so.
                found = rows[several & (rows["pos"] & 1 == 1)] if asked else rows[several]
                for i, at in enumerate(range(0, len(found), CHUNK)):
                    out.append((int(found[at]["id"] + i) % buckets, 1, found[at:at + CHUNK].tobytes()))
                # One row of these per key, and all others, ask for the key in other batches.
                asks = ~several
                asks[starts] = True
                if asked:
                    rows["shown"][starts] |= ASKED * np.bitwise_or.reduceat(rows["pos"] & 1, starts).astype(np.uint8)
                one = rows[asks]
                bucket = ((one["key"] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                cuts, sizes = _runs(bucket)
                for at, n in zip(cuts.tolist(), sizes.tolist(), strict=True):
                    out.append((int(bucket[at]), 0, one[at:at + n].tobytes()))
                for at in range(0, len(out), 256):
                    b, k, body = zip(*out[at:at + 256], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(b, pa.int32()), pa.array(k, pa.int32()), pa.array(body, pa.binary())],
                        schema=PACKED_SCHEMA,
                    )

    return run


def _members(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), CHUNK):
        some = rows[at:at + CHUNK]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(some["key"]).view(np.int64)), pa.array(some["id"].copy()), pa.array(some["pos"].copy())],
            names=["key", "id", "pos"],
        )


def _asked(rows: np.ndarray) -> np.ndarray:
    """Of the keys of several ids that some row asks for: the row of least id, and the asking ones that have not left."""
    rows = rows[np.lexsort((rows["id"], rows["key"]))]
    starts, several = _shared(rows)
    _, lengths = _runs(rows["key"])
    marks = np.repeat(np.bitwise_or.reduceat(rows["shown"], starts), lengths)
    kept = (rows["shown"] & 1 == 0) & (rows["pos"] & 1 == 1)
    kept[starts] = True
    return rows[kept & (several | (marks & 1 == 1)) & (marks & ASKED > 0)]


def _meet(batches: Iterator[pa.RecordBatch], asked: bool) -> Iterator[pa.RecordBatch]:
    held = []
    for batch in batches:
        for kind, body in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            rows = np.frombuffer(body, dtype=ENTRY)
            if kind:
                yield from _members(rows)
            else:
                held.append(rows)
    if held:
        rows = np.concatenate(held)
        del held
        if asked:
            yield from _members(_asked(rows))
            return
        rows = rows[np.argsort(rows["key"], kind="stable")]
        _, several = _shared(rows)
        yield from _members(rows[several & (rows["shown"] == 0)])


def colliding(frame: DataFrame, emit: Callable, scan_tasks: int, asked: bool = False) -> DataFrame:
    """Rows ``key, id, pos`` of all keys that emitted rows of at least two ids have.

    ``emit()`` gives, once per task, a function from a record batch to arrays ``keys`` (64-bit unsigned),
    ``ids`` and ``places``. Keys travel as packed arrays by ranges of the key. Of a key that ids
    of a batch share, one entry travels, so a hot key makes one entry per batch, and its rows
    leave the batch at once, dealt out evenly. A task holds 21 bytes per entry of its range; the number of ranges grows with
    the input (``scan_tasks``) and with the cluster's number of shuffle partitions.

    With ``asked`` an odd place asks for its key. Keys that no row asks for are left out; of the others come the rows
    that ask and one of the least id, which may come twice.
    """
    tasks = max(shuffle_width(frame.sparkSession), 2 * scan_tasks)
    packed = frame.mapInArrow(_pack(emit, BUCKETS_PER_TASK * tasks, asked), PACKED)
    return packed.repartition(tasks, "bucket").mapInArrow(functools.partial(_meet, asked=asked), MEMBERS)


def scan_tasks(frame: DataFrame) -> int:
    """Number of tasks that read ``frame``, which has to be a plain scan."""
    return frame.rdd.getNumPartitions()
