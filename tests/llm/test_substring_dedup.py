import random

import brute
import numpy as np

import pytest

from millrace.llm.linking import parity_sketch
from millrace.llm.shingles import WordHashes, shingle_set
from millrace.llm.substring_dedup import (
    GUARANTEE, PASSAGE_WORDS, anchors, passages, repeated_passages, tied_lines, tune_bands, without_repeats,
)


def planted(seed=3):
    rng = random.Random(seed)
    fresh = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    docs, shared = {}, [fresh(rng.randrange(GUARANTEE, 90)) for _ in range(6)]
    n = 0
    for p in shared:
        for _ in range(rng.randrange(2, 6)):
            w = [*fresh(rng.randrange(0, 200)), *p, *fresh(rng.randrange(0, 200))]
            docs[n] = "".join(x + rng.choice([" ", " ", " ", "\n"]) for x in w)
            n += 1
    short = fresh(20)
    for _ in range(40):
        w = fresh(rng.randrange(1, 300))
        docs[n] = " ".join(w + short) if rng.random() < 0.3 else " ".join(w)
        n += 1
    line = fresh(60)
    for k in range(3):  # a paragraph of its own, with a word changed
        docs[n] = " ".join(fresh(30)) + "\n" + " ".join([*line[:30], f"x{k}", *line[31:]]) + "\n" + " ".join(fresh(30))
        n += 1
    return docs


def test_equal_runs_share_a_paragraph():
    rng, hashes = random.Random(4), WordHashes()
    for _ in range(300):
        run = [f"r{rng.randrange(10**6)}" for _ in range(GUARANTEE)]
        texts = [" ".join([*(f"{s}{rng.randrange(10**6)}" for _ in range(rng.randrange(100))), *run, *(f"{s}{rng.randrange(10**6)}" for _ in range(rng.randrange(100)))]) for s in "ab"]
        keys = [passages(hashes.of(t))[0] for t in texts]
        assert np.intersect1d(*keys).size


def test_planted_passages(spark, saved):
    docs = planted()
    df = saved(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4))
    rows = repeated_passages(df).collect()
    got, sure = {r.doc_id for r in rows}, brute.repeated(docs, GUARANTEE)
    near = {i for i in docs if i >= len(docs) - 3}
    assert sure <= got and near <= got
    assert got - near <= brute.repeated(docs, 32)
    for r in rows:
        assert r.kept == (r.doc_id == r.keep_id) and r.keep_id <= r.doc_id and r.n_words >= 32
        assert r.start_word + r.n_words <= len(brute.words(docs[r.doc_id]))
    left = {r.doc_id: r.text for r in without_repeats(df).collect()}
    assert set(left) == set(docs)
    assert not brute.repeated(left, GUARANTEE)
    assert all(left[i] == docs[i] for i in docs if i not in got)
    assert all(left[r.keep_id] == docs[r.keep_id] for r in rows if r.kept and not any(x.doc_id == r.keep_id and not x.kept for x in rows))


def test_bands_reach_the_recall():
    for rows in (1, 2, 3):
        assert 1 - (1 - 0.75**rows) ** tune_bands(rows=rows) >= 0.97


@pytest.mark.parametrize("words", [100, 200, 400, 1000])
def test_couples_within_a_template(spark, saved, words):
    """Lines of one template, similar only in couples: every couple is tied, nothing else is."""
    rng, hashes = random.Random(6), WordHashes()
    base, lines = [f"t{i}" for i in range(words)], []
    for k in range(60):
        one = list(base)
        for i in range(8, words, 50):  # two such lines have a Jaccard of about 0.67
            one[i - 5:i] = [f"k{k}x{i}"] * 5
        two = list(one)
        two[rng.randrange(words)] = f"other{k}"
        lines += [one, two]
    rng.shuffle(lines)
    grams = [shingle_set(hashes.of(" ".join(x))) for x in lines]
    linked = {
        (i, j) for i in range(len(lines)) for j in range(i)
        if 4 * len(np.intersect1d(grams[i], grams[j])) >= 3 * len(np.union1d(grams[i], grams[j]))
    }
    rows = [(i, parity_sketch(g), g.view(np.int64).tolist()) for i, g in enumerate(grams)]
    contents = saved(spark.createDataFrame(rows, "node long, sketch binary, grams array<long>"))
    got = {(r.node, r.component) for r in tied_lines(contents.selectExpr("7L key", "node"), contents).collect()}
    assert len(linked) == 60 and {x for x in got if x[0] != x[1]} == linked


def test_anchors_are_the_least_of_each_window():
    rng = np.random.default_rng(5)
    for n in (1, 2, 18, 19, 20, 21, 64, 300):
        for top in (3, 2**60):  # with ties and without
            grams = rng.integers(0, top, n, dtype=np.uint64)
            wanted = {i + int(grams[i:i + 19].argmin()) for i in range(max(1, n - 18))}
            assert anchors(grams, 19).tolist() == sorted(wanted)


def test_cuts_reach_the_ends_of_equal_runs(spark, saved):
    """Every word in a run of ``GUARANTEE`` words that some earlier document holds is cut, whichever document that is."""
    rng = random.Random(9)
    fresh = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    passage, docs = fresh(150), {}
    for i in range(60):  # overlapping parts of one passage, so the longest run is seldom with the first holder
        a = rng.randrange(0, 90)
        part = passage[a:a + rng.randrange(GUARANTEE, 150)]
        docs[i] = [*fresh(rng.randrange(40)), *part, *fresh(rng.randrange(40))]  # a line per word: lines are too short to count
    df = saved(spark.createDataFrame([(i, "\n".join(w)) for i, w in docs.items()], "doc_id long, text string").repartition(5))
    cut = {i: set() for i in docs}
    for r in repeated_passages(df).where("not kept").collect():
        cut[r.doc_id].update(range(r.start_word, r.start_word + r.n_words))
    seen, short = set(), set()
    for i, words in docs.items():
        runs = {tuple(words[k:k + GUARANTEE]): k for k in range(len(words) - GUARANTEE + 1)}
        sure = {j for run, k in runs.items() if run in seen for j in range(k, k + GUARANTEE)}
        most = {j for k in range(len(words) - PASSAGE_WORDS + 1) if tuple(words[k:k + PASSAGE_WORDS]) in short for j in range(k, k + PASSAGE_WORDS)}
        assert sure <= cut[i] <= most
        seen.update(runs)
        short.update(tuple(words[k:k + PASSAGE_WORDS]) for k in range(len(words) - PASSAGE_WORDS + 1))


def test_couples_in_documents(spark, saved):
    rng, docs = random.Random(7), {}
    for k in range(100):
        own = [f"t{i}" if i % 50 > 4 else f"k{k}x{i}" for i in range(400)]
        for _ in range(2):
            own[rng.randrange(400)] = f"n{len(docs)}"
            docs[len(docs)] = " ".join(own)
    df = saved(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4))
    _, want = brute.similar(docs)
    lines = {(r.doc_id, r.keep_id) for r in repeated_passages(df).collect() if r.n_words == 400}
    assert {(2 * k + 1, 2 * k) for k in range(100) if want[2 * k + 1] == want[2 * k]} <= lines


def test_runs_go_whole(spark, saved):
    """No word of a run of ``GUARANTEE`` words that an earlier document holds stays, at any length and place."""
    rng, docs = random.Random(8), {}
    fresh = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    for n in [51, 52, 55, 60, 75, 100, 130, 200]:
        for _ in range(4):
            p = fresh(n)
            parts = [p[:rng.randrange(n)], p, p[rng.randrange(n):], p, p[rng.randrange(n // 2):]]
            for part in parts:
                w = [*fresh(rng.randrange(40)), *part, *fresh(rng.randrange(40))]
                docs[len(docs)] = "".join(x + rng.choice([" ", " ", "\n"]) for x in w)
    df = saved(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4))
    seen, want = set(), {}
    for i in sorted(docs):
        w = brute.words(docs[i])
        runs = [tuple(w[k:k + GUARANTEE]) for k in range(len(w) - GUARANTEE + 1)]
        want[i] = {k + x for k, run in enumerate(runs) if run in seen for x in range(GUARANTEE)}
        seen.update(runs)
    got = {i: set() for i in docs}
    rows = repeated_passages(df).collect()
    for r in rows:
        one, two = brute.words(docs[r.doc_id]), brute.words(docs[r.keep_id])
        run = one[r.start_word:r.start_word + r.n_words]
        assert any(two[k:k + 32] == run[:32] for k in range(len(two)))
        if not r.kept:
            got[r.doc_id] |= set(range(r.start_word, r.start_word + r.n_words))
    assert any(want.values()) and all(want[i] <= got[i] for i in docs)
    left = {r.doc_id: brute.words(r.text) for r in without_repeats(df).collect()}
    for i in docs:
        w = brute.words(docs[i])
        assert left[i] == [x for k, x in enumerate(w) if k not in got[i]]


def test_odd_rows(odd_docs, no_docs):
    rows = repeated_passages(odd_docs).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in rows} == {(4, 4, True), (5, 4, False), (8, 8, True), (9, 8, False)}
    left = without_repeats(odd_docs)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count()
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[1] is None and texts[2] == "" and texts[9] == "tail" or len(texts[9].split()) < 60
    assert repeated_passages(no_docs).count() == 0 and without_repeats(no_docs).count() == 0
