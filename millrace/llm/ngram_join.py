"""Documents of similar word shingles, by a join of parity sketches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.colliding import colliding, scan_tasks
from millrace.llm.common import bloom_words, may_be_in, shuffle_width, staged, text_slices
from millrace.llm.linking import link_by_keys, parity_sketch
from millrace.llm.shingles import WordHashes, mix, shingle_set

PERCENT = 75
GROWTH = 4  # sizes of a band lie between a power of this and the next
LEAST_BLOCKS = 64
LOCAL_HOT, HOT, MAX_HOT = 3, 32, 1 << 17
EMIT_BYTES = 6 << 20  # of text whose keys a task holds at a time
AT_HAND = 4000  # documents whose sets a task holds at a time
PROFILE = "doc_id long, n long, mark1 long, mark2 long, kind int, sketch binary"
MEMBERS_AT_ONCE = 256  # texts compared with one other by a task
BROADCAST_IDS = 1 << 20  # so many ids are sent to the tasks that scan the documents; more are joined


def _node(found: np.ndarray) -> int:
    """Fingerprint of a set, its node in the graph of links."""
    return int((mix(found).sum(dtype=np.uint64) ^ np.uint64(len(found))).view(np.int64))


def _marks(found: np.ndarray) -> tuple[int, int]:
    """The node and a second fingerprint."""
    two = int(np.bitwise_xor.reduce(mix(found + np.uint64(1))).view(np.int64)) if len(found) else 0
    return _node(found), two


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: size, fingerprints and sketch of each set. Kind 1: shingles of several sets at hand."""
    hashes = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, AT_HAND):
            yield from _profiled(batch.slice(at, AT_HAND), hashes)


def _profiled(rows: pa.RecordBatch, hashes: WordHashes) -> Iterator[pa.RecordBatch]:
    n, marks, sketches, sets = [], [], [], {}
    for text in rows.column(1).to_pylist():
        found = shingle_set(hashes.of(text))
        n.append(len(found))
        marks.append(_marks(found))
        sketches.append(parity_sketch(found))
        sets[marks[-1]] = found
    yield _profile_rows(rows.column(0), n, *zip(*marks, strict=True), 0, sketches)
    values, counts = np.unique(np.concatenate([*sets.values()]), return_counts=True)
    hot = counts >= LOCAL_HOT
    if hot.any():
        values, counts = values[hot].view(np.int64), counts[hot]
        none, zero = pa.nulls(len(values), pa.int64()), np.zeros(len(values), np.int64)
        yield _profile_rows(none, counts, values, zero, 1, [None] * len(values))


def _profile_rows(ids: pa.Array, n, one, two, kind: int, sketches: list) -> pa.RecordBatch:
    numbers = [pa.array(np.asarray(x, dtype=np.int64)) for x in (n, one, two)]
    columns = [ids, *numbers, pa.array(np.full(len(ids), kind, np.int32)), pa.array(sketches, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "mark1", "mark2", "kind", "sketch"])


def differences(n: int, m: int, percent: int = PERCENT) -> int:
    """The most elements in which linked sets of these sizes can differ, both sides together."""
    return (n + m) * (100 - percent) // (100 + percent)


def signature(found: np.ndarray, hot: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of a set such that any two sets that link have one in common.

    In a band of sizes every set is a sketch of as many words as the band's largest set has
    elements: the elements are dealt to the words by hash and XORed into them. Sets that differ in d elements
    differ in at most d words (each word is a parity of its elements), so of their words, put into
    any common order, the first d + 1 of either have a word in common. The order puts rare words
    first: those with an element that is not ``hot``, then others, then empty ones. A partner may lie in
    the band above, so d is not bounded by the band's own sizes.
    """
    n = len(found)
    if not n:
        return found
    band = 0
    while GROWTH ** (band + 1) <= n:
        band += 1
    keys = [_band_keys(found, hot, band, differences(n, n * 100 // percent, percent))]
    low = GROWTH ** band
    if band and (low - 1) * 100 >= n * percent:  # a partner may lie in the band below
        keys.append(_band_keys(found, hot, band - 1, differences(n, low - 1, percent)))
    return np.concatenate(keys)


def _band_keys(found: np.ndarray, hot: np.ndarray, band: int, most: int) -> np.ndarray:
    blocks = max(LEAST_BLOCKS, GROWTH ** (band + 1))
    seed = np.uint64(band + 1)
    place = mix(found ^ mix(np.full(1, seed))) % np.uint64(blocks)
    # Numbers of 16 bits are sorted digit by digit.
    order = np.argsort(place.astype(np.uint16) if blocks <= 1 << 16 else place, kind="stable")
    place = place[order]
    starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    parity = np.bitwise_xor.reduceat(found[order], starts)
    common = np.logical_and.reduceat(hot[order], starts)
    keys = mix(parity + mix(place[starts] * np.uint64(257) + seed))
    rare, known = keys[~common], keys[common]
    need = most + 1
    if len(rare) >= need:
        return rare if len(rare) == need else np.partition(rare, need - 1)[:need]
    need -= len(rare)
    if len(known) > need:
        known = np.partition(known, need - 1)[:need]
    need -= len(known)
    if need <= 0:
        return np.concatenate([rare, known])
    free = np.setdiff1d(np.arange(blocks, dtype=np.uint64), place[starts])
    empty = np.sort(mix(mix(free * np.uint64(257) + seed)))[:need]
    return np.concatenate([rare, known, empty])


def _emit(hot_values: np.ndarray) -> Callable:
    """Keys of every set, once per batch for sets that are equal."""

    def start() -> Callable:
        hashes = WordHashes()

        def run(batch: pa.RecordBatch):
            seen: set[int] = set()
            for piece in text_slices(batch, 1, EMIT_BYTES):
                keys, nodes = [np.empty(0, np.uint64)], []
                for text in piece.column(1).to_pylist():
                    found = shingle_set(hashes.of(text))
                    node = _node(found)
                    if node in seen:
                        continue
                    seen.add(node)
                    if len(hot_values):
                        near = np.searchsorted(hot_values, found)
                        near[near == len(hot_values)] = 0
                        hot = hot_values[near] == found
                    else:
                        hot = np.zeros(len(found), bool)
                    keys.append(signature(found, hot))
                    nodes.append(node)
                of = np.repeat(np.array(nodes, dtype=np.int64), [len(k) for k in keys[1:]])
                yield np.concatenate(keys), of, np.zeros(len(of), np.int32)

        return run

    return start


def _verified(percent: int) -> Callable:
    """Groups of a text and those it may link with, the one first. Each set is made once per group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, one = WordHashes(), None, np.empty(0, np.uint64)
        for batch in batches:
            a, b = [], []
            for rows in text_slices(batch, 4):
                for hub, part, kind, node, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    found = shingle_set(hashes.of(text))
                    if _node(found) != node:  # another text of an id that stands twice
                        continue
                    if kind == 0:
                        last, one = (hub, part), found
                    elif last == (hub, part):
                        shared = len(np.intersect1d(one, found, assume_unique=True))
                        if 100 * shared >= percent * (len(one) + len(found) - shared):
                            a.append(hub)
                            b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _texts_of(docs: DataFrame, first: DataFrame) -> DataFrame:
    """``node, text`` of the documents in ``first`` (``doc_id, node``)."""
    if first.count() <= BROADCAST_IDS:
        return docs.join(F.broadcast(first), "doc_id").select("node", "text")
    return may_be_in(bloom_words(first, "doc_id"), docs, "doc_id").join(first, "doc_id").select("node", "text")


def linked(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (``a``, ``b``) whose whole sets link.

    The text of ``b`` moves to its pair's ``a``; the text of ``a`` moves once for ``MEMBERS_AT_ONCE`` of these. Texts move,
    which are smaller than sets.
    """
    counts = pairs.groupBy("a").agg(F.expr(f"cast(count(1) div {MEMBERS_AT_ONCE} as int) + 1").alias("parts"))
    dealt = pairs.join(counts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    members = dealt.select("a", "part", F.lit(1).alias("kind"), F.col("b").alias("node"))
    hubs = dealt.select("a", "part").distinct().select("a", "part", F.lit(0).alias("kind"), F.col("a").alias("node"))
    rows = members.unionAll(hubs).join(texts, "node").select("a", "part", "kind", "node", "text")
    rows = rows.repartition(shuffle_width(pairs.sparkSession), "a", "part").sortWithinPartitions("a", "part", "kind")
    return rows.mapInArrow(_verified(percent), "a long, b long").distinct()


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents by shingle similarity: ``<id>, n_shingles, component_id``.

    A document's set is that of its runs of five words (a shorter text is one run), A-Z
    lower-cased; two documents link when 100 times the common runs are at least 75 times all
    runs of the two. ``component_id`` is the smallest id that links lead to.

    Sets that are equal are one node, named by a 64-bit fingerprint. The others are joined by parity sketches within bands of size
    (:func:`signature`), which loses no link. Of the documents that share a key, each is first compared with one other, in some rounds;
    the pairs of a key that still lie in different components are compared then (:func:`link_by_keys`).
    So a large group of copies costs a comparison per copy and round, not per pair.

    Null, empty and blank texts have no shingles and link with nothing. Rows of one id are one
    node; a null id gets the component of the texts that equal its own, or null. An empty table
    gives no rows. Only the two named columns are read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tasks = scan_tasks(docs)
    profile = staged(docs.mapInArrow(_profiles, PROFILE), "profiles")
    rows = profile.where("kind = 0")
    groups = staged(
        rows.where("n > 0").groupBy("n", "mark1", "mark2").agg(F.min("doc_id").alias("first_id")), "sets-groups"
    )
    heavy = profile.where("kind = 1").groupBy("mark1").agg(F.sum("n").alias("docs"))
    heavy = heavy.where(F.col("docs") >= HOT).orderBy(F.desc("docs"), "mark1").limit(MAX_HOT).collect()
    hot = np.sort(np.array([r["mark1"] for r in heavy], dtype=np.int64).view(np.uint64))

    members = staged(colliding(docs, _emit(hot), tasks).select("key", F.col("id").alias("node")), "colliding")
    ids = members.select("node").distinct()
    known = groups.select(F.col("mark1").alias("node"), "first_id").join(ids, "node")
    own = rows.select(F.col("doc_id").alias("first_id"), F.col("mark1").alias("node"), "n", "sketch")
    known = known.join(own, ["first_id", "node"]).dropDuplicates(["node"])
    known = staged(known.select("node", "first_id", "n", "sketch"), "sketches")

    def verify(pairs: DataFrame) -> DataFrame:
        """Whole sets are made anew from the texts, for the documents of the pairs that are left."""
        left = staged(pairs, "near")
        nodes = left.select(F.col("a").alias("node")).unionAll(left.select("b")).distinct()
        first = staged(known.join(nodes, "node").select(F.col("first_id").alias("doc_id"), "node"), "firsts")
        return linked(left, _texts_of(docs, first))

    ends = link_by_keys(members, verify, known.drop("first_id"), PERCENT)
    least = groups.withColumnRenamed("mark1", "node").join(ends, "node").groupBy("component").agg(F.min("first_id").alias("component_id"))
    ends = ends.join(least, "component").select("node", "component_id")

    return rows.drop("sketch").join(groups, ["n", "mark1", "mark2"], "left").join(
        ends, F.col("mark1") == F.col("node"), "left"
    ).select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "first_id", "doc_id").alias("component_id"),
    )
