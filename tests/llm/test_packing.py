import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.packing import SegmentTree, best_fit_decreasing, pack
from millrace.llm.queries import tokenizer_file
from millrace.llm.tokens import ByteBpe

BPE = tokenizer_file("byte_bpe_50k.json")


def one_by_one(lengths, capacity):
    """Best fit decreasing item by item: the remaining capacities of all bins."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [(left, i) for i, left in enumerate(bins) if left >= n]
        if fits:
            bins[min(fits)[1]] -= n
        else:
            bins.append(capacity - n)
    return sorted(bins)


def laid(steps, capacity):
    """Bins as the steps fill them; checks that items and places meet exactly once."""
    bins, items = {}, {}
    for length, item, first, n, offset in steps:
        items.setdefault(length, []).append((item, item + n))
        for b in range(first, first + n):
            bins.setdefault(b, []).append((offset, length))
    for spans in items.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    for rows in bins.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(bins) == list(range(len(bins)))
    return sorted(capacity - sum(n for _, n in rows) for rows in bins.values())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=80))
def test_plan_is_best_fit_decreasing(lengths):
    counts = {n: lengths.count(n) for n in lengths}
    assert laid(best_fit_decreasing(counts, 32), 32) == one_by_one(lengths, 32)


def test_plan_size_is_bounded():
    rng = random.Random(1)
    counts = {n: rng.randrange(10**9, 10**10) for n in range(1, 1025)}
    assert len(best_fit_decreasing(counts)) < 50_000


def test_tree_finds_tightest():
    tree, rng, bins = SegmentTree(64), random.Random(2), []
    for _ in range(300):
        bins.append(rng.randrange(1, 65))
        tree.add(bins[-1], 1)
        need = rng.randrange(1, 65)
        assert tree.tightest(need) == min((b for b in bins if b >= need), default=-1)
        if rng.random() < 0.7:
            tree.add(bins.pop(rng.randrange(len(bins))), -1)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def same_ids(tokenizer, texts):
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(b, "<u4").tolist() for b in ByteBpe(BPE).encode(texts)]
    assert got == want


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet=" \n\tab'é \x1c\x85 ß9<|>endoftext日😀.", max_size=40), max_size=5))
def test_ids_are_the_tokenizers(tokenizer, texts):
    same_ids(tokenizer, texts)


def test_ids_of_documents(tokenizer, spark, sf):
    same_ids(tokenizer, [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])


def check(rows, docs, tokenizer):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    want = []
    for i, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        cut = len(ids) % 1024 or 1024
        edges = [0, *range(min(cut, len(ids)), len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            want.append((str(i), k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((str(r.doc_id), *r[1:5]) for r in rows) == sorted(want)
    assert len(bins) == len(one_by_one([r.length for r in rows], 1024))


def test_documents(spark, sf, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(3)
    check(pack(docs, BPE).collect(), [(r.doc_id, r.text) for r in docs.collect()], tokenizer)


def test_odd_rows(odd_docs, no_docs, tokenizer):
    check(pack(odd_docs, BPE).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()], tokenizer)
    assert pack(no_docs, BPE).count() == 0
