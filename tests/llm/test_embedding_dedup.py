import brute
import numpy as np
import pytest

from millrace.llm.embedding_dedup import fit_tables, near_duplicates, unit_rows

SCHEMA = "vec_id long, embedding array<float>, label int, node long, uses int, vector string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, "clash") for i, v in rows], SCHEMA)


def expected(rows, cosine=0.9):
    good = {
        i: np.array(v, float) for i, v in rows
        if v and None not in v and np.isfinite(np.array(v, np.float32)).all() and any(v)
    }
    ids = sorted(good)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = good[a], good[b]
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links.append((a, b))
    ends = brute.components([i for i, _ in rows], links)
    count = {i: sum(i in x for x in links) for i, _ in rows}
    return {i: (count[i], ends[i], ends[i] == i) for i, _ in rows}


def got(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicates(df).collect()}


def clustered(n, size, seed, spread):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 4, size))
    x = centres[rng.integers(0, n // 4, n)] + spread * rng.standard_normal((n, size))
    return [(i * 3, [float(c) for c in np.float32(v)]) for i, v in enumerate(x)]


@pytest.mark.parametrize(("size", "spread"), [(64, 0.2), (16, 0.3), (3, 0.1)])
def test_recall_and_precision(spark, saved, size, spread):
    rows = clustered(400, size, 7, spread)
    want, found = expected(rows), got(saved(frame(spark, rows)))
    assert sum(f[0] for f in found.values()) >= 0.9 * sum(w[0] for w in want.values())
    assert all(found[i][0] <= want[i][0] for i in want)


def test_driver_vectors(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding) if r.embedding is not None else None) for r in df.collect()]
    assert got(df) == expected(rows)


def test_many_copies_in_blocks(spark, saved, monkeypatch):
    import millrace.llm.embedding_dedup as module

    monkeypatch.setattr(module, "BLOCK", 16)
    rng = np.random.default_rng(1)
    base = rng.standard_normal(32)
    rows = [(i, [float(c) for c in np.float32(base + 0.02 * rng.standard_normal(32))]) for i in range(150)]
    rows += [(1000 + i, rows[0][1]) for i in range(50)]
    assert got(saved(frame(spark, rows))) == expected(rows)


def test_odd_vectors(spark, saved):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [-1.0, -0.0]),
        (12, [3e38, 1e-38]), (13, [1e-45, 0.0]), (14, [0.9, 0.4359]), (15, None),
    ]
    assert got(saved(frame(spark, rows))) == expected(rows)
    odd = near_duplicates(frame(spark, [(None, [1.0, 2.0]), (None, None), (5, [1.0, 2.0])])).collect()
    assert len(odd) == 3
    assert near_duplicates(frame(spark, [])).count() == 0
    assert got(frame(spark, [(1, None)])) == {1: (0, 1, True)}


def test_codes_are_balanced():
    x = unit_rows(list(np.random.default_rng(2).standard_normal((3000, 24)) + 0.5), 24)
    tables = fit_tables(x, 3000)
    keys = tables.keys(x)
    for bit in range(24):  # those of the first rotation
        table, place = divmod(bit, tables.width)
        share = ((keys[:, table] >> np.uint64(place)) & np.uint64(1)).mean()
        assert abs(share - 0.5) < 0.02


@pytest.mark.parametrize(("size", "rank"), [(256, 64), (768, 64), (384, 100)])
def test_recall_near_a_subspace(size, rank):
    """Vectors near a subspace: pairs that differ within it are found as well as others."""
    rng = np.random.default_rng(9)
    basis, _ = np.linalg.qr(rng.standard_normal((size, rank)))
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    x = unit(rng.standard_normal((4096, rank)) @ basis.T + 0.001 * rng.standard_normal((4096, size)))
    tables = fit_tables(x, 100_000)
    one = unit(rng.standard_normal((2000, rank)) @ basis.T)
    for turn in (rng.standard_normal((2000, rank)) @ basis.T, rng.standard_normal((2000, size))):
        turn -= (turn * one).sum(axis=1, keepdims=True) * one
        two = 0.9 * one + np.sqrt(1 - 0.9**2) * unit(turn)
        assert (tables.keys(one) == tables.keys(two)).any(axis=1).mean() >= 0.9
