import random

import brute
import numpy as np
import pytest
from compare import duck, duck_bag, spark_bag

from millrace.llm.ngram_join import differences, signature, similar_documents
from millrace.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("hot", [0.0, 0.5, 1.0])
def test_linked_sets_share_a_key(hot):
    """Exactness of the filter, at the very edge of what links, over sizes and band borders."""
    rng = np.random.default_rng(11)
    for n in [*range(1, 80), 200, 256, 257, 300, 1000, 1024, 1030]:
        for _ in range(3 if n < 100 else 1):
            a = rng.integers(0, 2**63, n).astype(np.uint64)
            for m in {n, -(-3 * n // 4), 4 * n // 3}:
                # as many common elements as it takes to link, no more
                shared = -(-75 * (n + m) // 175)
                if not 0 < shared <= min(n, m):
                    continue
                b = np.concatenate([a[:shared], rng.integers(0, 2**63, m - shared).astype(np.uint64)])
                assert n + m - 2 * shared <= differences(n, m)
                marks = [np.sort(x) for x in (a, b)]
                keys = [signature(x, x % np.uint64(1000) < np.uint64(1000 * hot)) for x in marks]
                assert np.intersect1d(*keys).size


@pytest.mark.parametrize(("n", "m", "times"), [(3, 4, 1000), (15, 16, 300), (15, 20, 300), (63, 64, 100), (63, 84, 100)])
def test_linked_sets_over_a_band_border_share_a_key(n, m, times):
    rng = np.random.default_rng(12)
    shared = -(-75 * (n + m) // 175)
    for _ in range(times):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate([a[:shared], rng.integers(0, 2**63, m - shared).astype(np.uint64)])
        keys = [signature(np.sort(x), np.zeros(len(x), bool)) for x in (a, b)]
        assert np.intersect1d(*keys).size


def near_texts(seed):
    """Texts around the limit: copies with some words changed, cut or repeated."""
    rng = random.Random(seed)
    docs, n = {}, 0
    for _ in range(25):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([3, 5, 9, 30, 80, 300]))]
        for _ in range(rng.randrange(1, 7)):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 25)):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(4000)}"
            copy = copy[: rng.randrange(3 * len(copy) // 4, len(copy)) + 1]
            docs[n] = rng.choice([" ", "\n", "\t "]).join(copy) if rng.random() < 0.8 else " ".join(copy).upper()
            n += 1
    shared = " ".join(f"common{i}" for i in range(60))
    for _ in range(20):
        docs[n] = f"{shared} " + " ".join(f"own{n}x{k}" for k in range(rng.randrange(5, 60)))
        n += 1
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, saved, seed):
    docs = near_texts(seed)
    df = saved(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3))
    sets, want = brute.similar(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_documents(df).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in docs}


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    sets, want = brute.similar({i: t for i, t in rows if i is not None})
    got = similar_documents(odd_docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id])
    assert {r.component_id for r in got if r.doc_id is None} == {None}
    assert similar_documents(no_docs).count() == 0


def test_sql(spark, sf):
    assert spark_bag(QUERIES["op3_ngram_join"](spark, sf)) == duck_bag(duck(sf), ORACLES["op3_ngram_join"])
