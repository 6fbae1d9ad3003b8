"""Components of nodes that share keys, where a check decides which of them link."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import components, shuffle_width, staged
from millrace.llm.shingles import mix

ROUNDS = 4  # of comparing each node with one other, while that ties a share of them
TIED_SHARE = 4  # one in so many
PARTNERS, PASSES = 8, 2  # a pass over the keys gives each node so many partners; the last pass gives all that are left
GROUP_ROWS = 100_000  # keys and members that are looked through together
KEY_MEMBERS = 16_384  # members of a key that are compared with one another at a time
PAIRS = 1 << 18  # pairs at hand at a time
LEAST_BITS = 256
PROFILE = "node long, n long, sketch binary"


def parity_sketch(found: np.ndarray) -> bytes:
    """The set's parity: each element turns one bit over. There are about twice as many bits as elements.

    Bits that differ between two sets are at most the elements that do. A sketch folds to half its bits by a
    parity of its halves, so sketches of different lengths can be compared.
    """
    bits = LEAST_BITS
    while bits < 2 * len(found):
        bits *= 2
    odd = np.bincount((found % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(sketch: np.ndarray, size: int) -> np.ndarray:
    while len(sketch) > size:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


class Nodes:
    """Sizes and sketches of some nodes, and which pairs of them these do not rule out."""

    def __init__(self, sizes: np.ndarray, sketches: list[bytes | None], percent: int) -> None:
        self.sizes, self.percent = sizes, percent
        own = [np.frombuffer(s or b"", dtype=np.uint64) for s in sketches]
        self.words = np.array([len(s) for s in own], dtype=np.int64)
        # A table for each length, which those of twice the length are folded to as well: sizes that link differ less.
        self.tables, self.row = {}, np.zeros((2, len(own)), dtype=np.int64)
        for size in {int(w) for w in self.words if w}:
            rows = []
            for i, s in enumerate(own):
                if size <= len(s) <= 2 * size:
                    self.row[int(len(s) > size), i] = len(rows)
                    rows.append(_folded(s, size))
            self.tables[size] = np.array(rows)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        small, large = np.minimum(self.sizes[a], self.sizes[b]), np.maximum(self.sizes[a], self.sizes[b])
        out = 100 * small >= self.percent * large
        most = (small + large) * (100 - self.percent) // (100 + self.percent)
        short = np.minimum(self.words[a], self.words[b])
        for size, table in self.tables.items():
            some = np.flatnonzero(out & (short == size))
            step = max(1, PAIRS // size)
            for at in range(0, len(some), step):
                i = some[at:at + step]
                one, two = (table[self.row[(self.words[x[i]] > size).astype(np.int64), x[i]]] for x in (a, b))
                out[i] = np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64) <= most[i]
        return out


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def ruled(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that size and sketch (``profiles``: ``node, n, sketch``) do not rule out."""
    sides = [profiles.select(*(F.col(c).alias(x if c == "node" else f"{c}_{x}") for c in profiles.columns)) for x in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                rows = batch.slice(at, 2000)
                n = np.concatenate([rows.column(i).to_numpy() for i in (2, 3)])
                nodes = Nodes(n, [*rows.column(4).to_pylist(), *rows.column(5).to_pylist()], percent)
                good = pa.array(nodes.near(np.arange(len(rows)), len(rows) + np.arange(len(rows))))
                yield rows.select([0, 1]).filter(good)

    return both.mapInArrow(run, "a long, b long")


def _few(nodes: np.ndarray, a: np.ndarray, b: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs are among the first ``PARTNERS`` of either node, in one order for all; and the nodes with more.

    A pair that is left out is one of two nodes with more partners.
    """
    one, two = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.lexsort((mix(nodes[two].view(np.uint64) ^ np.uint64(seed)), one))
    sorted_ = one[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    counts = np.diff(np.append(starts, len(sorted_)))
    rank = np.arange(len(sorted_)) - np.repeat(starts, counts)
    chosen = np.zeros(len(one), bool)
    chosen[order] = rank < PARTNERS
    return chosen[:len(a)] | chosen[len(a):], sorted_[starts[counts > PARTNERS]]


def _group_pairs(
    nodes: np.ndarray, component: np.ndarray, known: Nodes | None, keys: np.ndarray, members: np.ndarray, seed: int | None,
) -> Iterator[tuple]:
    """Pairs of nodes of different components that share a key, each once, those that sketches rule out left out.

    ``members`` are places in ``nodes``, sorted by ``keys``. With ``seed`` a node has some partners only; a node that
    has more comes once more, paired with itself.
    """
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    ends = np.append(starts[1:], len(keys))
    done, held, size = [], [], 0

    def flush() -> None:
        code = np.unique(np.concatenate(held))
        a, b = np.divmod(code, len(nodes))
        if known is not None:
            near = known.near(a, b)
            code = code[near]
        done.append(code)

    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        at = members[start:end]
        for first in range(0, len(at), max(1, PAIRS // len(at))):
            some = at[first:first + max(1, PAIRS // len(at))]
            a, b = np.repeat(some, len(at)), np.tile(at, len(some))
            fits = (a < b) & (component[a] != component[b])
            if known is not None:
                small, large = np.minimum(known.sizes[a], known.sizes[b]), np.maximum(known.sizes[a], known.sizes[b])
                fits &= 100 * small >= known.percent * large
            if fits.any():
                held.append(a[fits] * len(nodes) + b[fits])
                size += len(held[-1])
            if size > PAIRS:
                flush()
                held, size = [], 0
    if held:
        flush()
    if done:
        a, b = np.divmod(np.unique(np.concatenate(done)), len(nodes))
        if seed is not None and len(a):
            chosen, more = _few(nodes, a, b, seed)
            a, b = np.concatenate([a[chosen], more]), np.concatenate([b[chosen], more])
        yield np.minimum(nodes[a], nodes[b]), np.maximum(nodes[a], nodes[b])


def _cross(percent: int, seed: int | None):
    """Groups come sorted: first their nodes, with component, size and sketch, then their keys' members."""

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        kind = rows["kind"].to_numpy()
        heads = int((kind == 0).sum())
        own, rest = rows.slice(0, heads), rows.slice(heads)
        nodes = own["node"].to_numpy()
        order = np.argsort(nodes, kind="stable")
        nodes, component = nodes[order], own["component"].to_numpy()[order]
        sizes = own["n"].to_numpy(zero_copy_only=False)[order] if percent else None
        sketches = own["sketch"].to_pylist() if percent else None
        known = Nodes(sizes.astype(np.int64), [sketches[i] for i in order.tolist()], percent) if percent else None
        places = np.searchsorted(nodes, rest["node"].to_numpy())
        for a, b in _group_pairs(nodes, component, known, rest["key"].to_numpy(), places, seed):
            yield _pair_batch(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:]):
                piece = batch.slice(start, end - start)
                if held and held[0].column(0)[0] != piece.column(0)[0]:
                    yield from pairs(pa.Table.from_batches(held))
                    held = []
                held.append(piece)
        if held:
            yield from pairs(pa.Table.from_batches(held))

    return run


def cross_pairs(mixed: DataFrame, profiles: DataFrame | None = None, percent: int = 0, seed: int | None = None) -> DataFrame:
    """Pairs ``a, b`` of nodes of different components that share a key (``mixed``: ``key, node, component, c``).

    Keys are put into groups by the least component among their members (``c``), since those of similar nodes have much the same
    members: a pair that many keys have in common is looked at once, and a node and its profile are there once per group. A
    group too large is dealt out by key, and a key too large by blocks of its members, each pair of blocks a
    group. Sizes and sketches rule pairs out before they become rows. With ``seed`` a node of a group has ``PARTNERS``
    partners at most, and comes paired with itself if it has more.
    """
    count = F.count(F.lit(1))
    keys = mixed.groupBy("key").agg(F.min("c").alias("c"), count.alias("members"))
    keys = keys.withColumn("blocks", F.expr(f"cast((members + {KEY_MEMBERS - 1}) div {KEY_MEMBERS} as int)"))
    sizes = keys.groupBy("c").agg(F.expr(f"cast(sum(members) div {GROUP_ROWS} as int) + 1").alias("parts"))
    keys = keys.join(sizes, "c").select("key", "blocks", F.xxhash64("c", F.pmod("key", "parts")).alias("part"))
    rows = mixed.drop("c").join(keys, "key")
    small = rows.where("blocks = 1").select(F.col("part").alias("group"), "key", "node", "component")
    own = F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int")
    large = rows.where("blocks > 1").select("key", "node", "component", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    block = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    rows = staged(small.unionAll(large.select(block.alias("group"), "key", "node", "component")), "cross")
    heads = rows.select("group", "node", "component").distinct()
    if profiles is not None:
        heads = heads.join(profiles, "node")
    else:
        heads = heads.withColumns({"n": F.lit(0).cast("long"), "sketch": F.lit(None).cast("binary")})
    none = F.lit(None)
    both = heads.select("group", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("key"), "node", "component", "n", "sketch").unionAll(
        rows.select("group", F.lit(1), "key", "node", "component", none.cast("long"), none.cast("binary"))
    )
    both = both.repartition(shuffle_width(mixed.sparkSession), "group").sortWithinPartitions("group", "kind", "key")
    return both.mapInArrow(_cross(percent if profiles is not None else 0, seed), "a long, b long").distinct()


def link_by_keys(
    members: DataFrame, verify: Callable[[DataFrame], DataFrame], profiles: DataFrame | None = None, percent: int = 0,
) -> DataFrame:
    """``node, component`` of all nodes that link with another one.

    ``members`` has ``key`` and ``node``; ``verify`` keeps those of distinct pairs (``a``, ``b``)
    that link. ``profiles`` (``node, n, sketch``) rules pairs out beforehand.

    In each of some rounds a node is compared with one other: of its keys that lie in several components, the least node of the
    least component. Then the keys that still lie in several components are looked through by :func:`cross_pairs`, which gives
    each node some partners first, so that a large group of similar nodes costs a few comparisons per node and then
    lies in one component, and at last all pairs that are left. So no link is lost.
    """
    tied: DataFrame | None = None
    live = members
    for _ in range(ROUNDS):
        mixed = _mixed(live, tied)
        pairs = mixed.where("component <> c").groupBy(F.col("node").alias("b")).agg(F.min(F.struct("c", "hub")).alias("to"))
        pairs = pairs.select(F.col("to.hub").alias("a"), "b")
        if profiles is not None:
            pairs = ruled(pairs, profiles, percent)
        links = staged(verify(pairs), "links")
        tied = _grown(tied, links)
        live = mixed.select("key", "node")
        if TIED_SHARE * links.count() < live.select("node").distinct().count():
            break
    for seed in range(PASSES):
        mixed = _mixed(live, tied).select("key", "node", "component", "c")
        pairs = staged(cross_pairs(mixed, profiles, percent, seed), "cross-pairs")
        tied = _grown(tied, verify(pairs.where("a < b")))
        more = pairs.where("a = b").select(F.col("a").alias("node"))
        if more.isEmpty():
            return tied
        live = mixed.select("key", "node").join(more, "node", "left_semi")
    mixed = _mixed(live, tied).select("key", "node", "component", "c")
    return _grown(tied, verify(cross_pairs(mixed, profiles, percent)))


def _mixed(live: DataFrame, tied: DataFrame | None) -> DataFrame:
    """Members of keys that lie in several components, with the least component and its least node."""
    named = live.withColumn("component", F.col("node"))
    if tied is not None:
        named = live.join(tied, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    # The least node of a component is its name, but need not have the key: of those that do, the least.
    keys = named.groupBy("key").agg(F.min("component").alias("c"), F.max("component").alias("d"), F.min(F.struct("component", "node")).alias("first"))
    keys = keys.where("c < d").select("key", "c", F.col("first.node").alias("hub"))
    return staged(named.join(keys, "key"), "mixed")


def _grown(tied: DataFrame | None, links: DataFrame) -> DataFrame:
    links = links.select("a", "b")
    if tied is not None:
        links = links.unionAll(tied.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return staged(components(links), "tied")
