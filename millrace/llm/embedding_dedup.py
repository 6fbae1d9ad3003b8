"""Near-duplicate vectors: rotated binary codes, multi-index Hamming tables, exact reranking."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.colliding import colliding, scan_tasks
from millrace.llm.common import components, shuffle_width, staged
from millrace.llm.shingles import mix

COSINE = 0.9
SAMPLE = 8192  # vectors that the rotations are learned from; all vectors are indexed
RECALL = 0.97
LEARNED = 400  # tables of learned rotations; any beyond these are of random directions
MOST_BITS = 64
BLOCK = 1024  # vectors of a bucket that one task compares with as many others
FOUND = "node long, links long, root long"


def learn_rotation(x: np.ndarray, bits: int, seed: int, rounds: int = 30) -> np.ndarray:
    """Projection to ``bits`` balanced bits: principal axes, turned to lie near the code's corners.

    Alternates between the codes nearest to the turned sample and the rotation that brings the
    sample nearest to the codes.
    """
    rng = np.random.default_rng(seed)
    _, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1][:, :bits]
    v = x @ axes
    turn, _ = np.linalg.qr(rng.standard_normal((v.shape[1], v.shape[1])))
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(v @ turn >= 0, 1.0, -1.0).T @ v)
        turn = (left @ right).T
    return axes @ turn


@dataclass
class HammingTables:
    """``tables`` substrings of ``width`` bits each of the codes of unit vectors."""

    size: int
    mean: np.ndarray
    axes: np.ndarray
    cuts: np.ndarray
    width: int
    tables: int

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """The substring of every vector in every table."""
        used = self.tables * self.width
        bits = ((unit - self.mean) @ self.axes[:, :used]) >= self.cuts[:used]
        worth = np.uint64(1) << np.arange(self.width, dtype=np.uint64)
        return (bits.reshape(len(unit), self.tables, self.width) * worth).sum(axis=2, dtype=np.uint64)


def unit_rows(vectors: list, size: int) -> np.ndarray:
    """Vectors as rows of length one, filled up with zeros to ``size`` components."""
    out = np.zeros((len(vectors), size))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    with np.errstate(over="ignore"):
        out /= np.abs(out).max(axis=1, keepdims=True)  # keeps squares within range
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def at_cosine(probe: np.ndarray, noise: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and partners at this cosine to them, in the direction of ``noise``; without those it gives no direction."""
    noise = noise - (noise * probe).sum(axis=1, keepdims=True) * probe
    norm = np.linalg.norm(noise, axis=1)
    some = norm > 1e-6
    return probe[some], cosine * probe[some] + math.sqrt(1 - cosine**2) * noise[some] / norm[some, None]


def fit_tables(sample: np.ndarray, vectors: int, cosine: float = COSINE, recall: float = RECALL) -> HammingTables:
    """Learn rotations on a sample of unit vectors, and choose the number of tables.

    A substring has two bits more than it takes to number all ``vectors``, so chance fills a bucket with
    a quarter of another vector. As many tables are taken as it needs for pairs of just the wanted
    cosine, made from the sample, to share a bucket with probability ``recall``. Pairs are of two kinds, and each
    has to reach it: those that differ in any direction, and those that differ as the vectors themselves do.
    Rotations learned from data of a few directions may come out alike; random directions, which any
    pair at that angle shares a table of sooner or later, end the search then. There is no largest number of tables.
    """
    size = sample.shape[1]
    width = min(48, max(6, math.ceil(math.log2(max(2, vectors))) + 2))
    mean = sample.mean(axis=0)
    x = sample - mean
    bits = min(MOST_BITS, size)
    rng = np.random.default_rng(1)
    probe = sample[:2000]
    noise = rng.standard_normal(probe.shape), sample[rng.integers(0, len(sample), len(probe))] - probe
    pairs = [at_cosine(probe, kind, cosine) for kind in noise]
    pairs = [p for p in pairs if len(p[0])] or [(probe, probe)]
    tables = 0
    met = 0.0
    fitted = HammingTables(size, mean, np.empty((size, 0)), np.empty(0), width, 0)
    while met < recall:
        seed = fitted.axes.shape[1]
        if seed >= LEARNED * width:
            axes = np.random.default_rng(seed).standard_normal((size, max(bits, width)))
            cuts = np.zeros(axes.shape[1])
        elif seed // bits % 2:
            # Every other rotation is about the origin, where an angle turns over as many bits in any data.
            axes = learn_rotation(sample, bits, seed)
            cuts = -(mean @ axes)
        else:
            axes = learn_rotation(x, bits, seed)
            cuts = np.median(x @ axes, axis=0)  # balanced: half of the sample on either side
        fitted.axes, fitted.cuts = np.hstack([fitted.axes, axes]), np.append(fitted.cuts, cuts)
        tables = fitted.tables = fitted.axes.shape[1] // width
        if tables:
            met = min((fitted.keys(one) == fitted.keys(two)).any(axis=1).mean() for one, two in pairs)
    return fitted


def _emit(model: HammingTables) -> Callable:
    def start() -> Callable:
        def run(batch: pa.RecordBatch):
            nodes, vectors = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            table = np.arange(model.tables, dtype=np.uint64)
            for at in range(0, len(vectors), 2000):
                some = vectors[at:at + 2000]
                sizes = np.array([len(v) for v in some], dtype=np.uint64)
                keys = model.keys(unit_rows(some, model.size))
                keys = mix(keys ^ mix(table[None, :] + sizes[:, None] * np.uint64(1 << 20)))
                yield keys.ravel(), np.repeat(nodes[at:at + 2000], model.tables), np.tile(table.astype(np.int32), len(some))

        return run

    return start


def _local_roots(link: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Least node that each one reaches within a block."""
    root = nodes.copy()
    while True:
        least = np.where(link, root[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(root, least)
        if (new == root).all():
            return root
        root = new


def _compare(model: HammingTables, cosine: float) -> Callable:
    """Rerank the vectors of each bucket block by their cosines; rows are sorted by block.

    A pair counts in the first of the tables it shares, so once. Gives for each vector with a link how many
    vectors it links with here, and the least node that links lead to here.
    """

    def block(rows: dict) -> tuple | None:
        nodes, uses, side, unit, keys = (rows[c] for c in ("node", "uses", "side", "unit", "keys"))
        table = int(rows["pos"][0])
        link = unit @ unit.T >= cosine
        np.fill_diagonal(link, False)
        link &= nodes[:, None] != nodes[None, :]
        if rows["lo"][0] != rows["hi"][0]:
            link &= side[:, None] != side[None, :]
        if not link.any():
            return None
        a, b = np.nonzero(link)
        if table:
            again = (keys[a, :table] == keys[b, :table]).any(axis=1)
            link[a[again], b[again]] = False
        # A pair that has shared an earlier table is tied there already.
        if not link.any():
            return None
        counts = link @ uses
        on = link.any(axis=1)
        return nodes[on], counts[on], _local_roots(link, nodes)[on]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "lo", "hi", "pos", "node", "uses", "side")
        held: dict | None = None

        def done(rows: dict, cut: int):
            starts = np.flatnonzero(np.concatenate([[True], np.any(
                [rows[c][1:cut] != rows[c][:cut - 1] for c in ("key", "lo", "hi")], axis=0
            )])) if cut else np.empty(0, np.int64)
            out = []
            for first, last in zip(starts.tolist(), [*starts[1:].tolist(), cut], strict=True):
                if last - first > 1 and (found := block({c: v[first:last] for c, v in rows.items()})):
                    out.append(found)
            if out:
                node, links, root = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(links.astype(np.int64)), pa.array(root)], names=["node", "links", "root"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names}
            rows["unit"] = unit_rows(batch.column(batch.schema.get_field_index("vector")).to_pylist(), model.size)
            rows["keys"] = model.keys(rows["unit"])
            if held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
            last = np.flatnonzero(np.any([rows[c] != rows[c][-1] for c in ("key", "lo", "hi")], axis=0))
            cut = int(last[-1]) + 1 if len(last) else 0
            yield from done(rows, cut)
            held = {c: v[cut:] for c, v in rows.items()}
        if held is not None:
            yield from done(held, len(held["key"]))

    return run


def usable(vector: Column) -> Column:
    """Vectors that can link: not null or empty, all components finite, one of them not zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """Links between vectors by cosine: ``<id>, n_links, component_id, kept``.

    Equal vectors are one node with a number of uses. Rotations are learned on about ``SAMPLE`` nodes, taken by the hash of their id; all nodes are indexed by several substrings of their codes, and those in one bucket are
    compared by the cosine of their original components in double precision. Large buckets are compared in
    blocks of ``BLOCK``, spread over tasks; a block gives a row per vector, not one per pair.

    ``n_links`` counts the other rows that were found to link directly, ``component_id`` is the smallest id that
    links lead to, ``kept`` tells whether that is the row's own. A null, empty or zero vector
    and one with a null or non-finite component links with nothing, and so do vectors with different numbers of
    components. Rows that repeat an id are taken to repeat the vector. An empty table gives no
    rows. Only the two named columns are read.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    tasks = scan_tasks(rows)
    # Zeros of either sign are one value.
    good = rows.where(usable(F.col("vector"))).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    groups = good.groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("uses"))
    nodes = staged(groups.where("node is not null"), "vectors")
    facts = nodes.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("size")).first()
    if facts["n"] == 0:
        return rows.select(
            F.col("vec_id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
            F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"),
        )
    place = F.pmod(F.xxhash64("node"), F.lit(max(facts["n"], SAMPLE)))
    sample = nodes.where(place < SAMPLE).select("vector").toArrow()
    if not sample.num_rows:
        sample = nodes.limit(SAMPLE).select("vector").toArrow()
    model = fit_tables(unit_rows(sample.column(0).to_pylist(), facts["size"]), facts["n"], cosine)

    members = staged(colliding(nodes.select("node", "vector"), _emit(model), tasks), "buckets")
    sizes = members.groupBy("key").agg(F.expr(f"(count(*) + {BLOCK} - 1) div {BLOCK}").cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int")
    pairs = members.join(sizes, "key").withColumn("own", own).select(
        "key", "pos", F.col("id").alias("node"), "own",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    # Half of the block pairs are enough; a block meets itself once.
    pairs = pairs.select(
        "key", "pos", "node", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    )
    width = max(shuffle_width(rows.sparkSession), 2 * tasks)
    laid = pairs.join(nodes, "node").select("key", "lo", "hi", "pos", "node", "uses", "side", "vector")
    laid = laid.repartition(width, "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    found = staged(laid.mapInArrow(_compare(model, cosine), FOUND), "links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    ends = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = nodes.select("node", "uses", "vector").join(links, "node", "left").join(ends, "node", "left").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("uses") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    linked = good.join(named, "vector", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    rest = rows.where(~usable(F.col("vector"))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionAll(rest).select(
        F.col("vec_id").alias(id_col), "n_links", "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
