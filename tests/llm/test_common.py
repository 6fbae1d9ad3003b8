import random

import brute
import numpy as np
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.colliding import colliding
from millrace.llm.common import components
from millrace.llm.linking import link_by_keys
from millrace.llm.shingles import WordHashes, shingle_set


def found(spark, links):
    edges = spark.createDataFrame(links, "a long, b long")
    return {r.node: r.component for r in components(edges).collect()}


def expected(links):
    nodes = {n for a, b in links if a != b for n in (a, b)}
    return brute.components(nodes, [x for x in links if x[0] != x[1]])


def test_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(1000, 1400)]
    loose = [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    links = [*chain, *star, *loose, (5, 5), (7, 1000), (-3, 120)]
    rng.shuffle(links)
    assert found(spark, links) == expected(links)
    assert found(spark, []) == {}
    assert found(spark, [(1, 1)]) == {}


def test_colliding_rows(spark):
    rows = [(i, (i * 7) % 50 if i % 3 else i + 1000) for i in range(200)] + [(i, 77) for i in range(500, 900)]

    def emit():
        def run(batch):
            ids, keys = (batch.column(i).to_numpy() for i in (0, 1))
            yield keys.astype(np.uint64) << np.uint64(40), ids, (ids % 5).astype(np.int32)

        return run

    df = spark.createDataFrame(rows, "id long, k long").repartition(7)
    got = sorted((r.key >> 40, r.id, r.pos) for r in colliding(df, emit, 2).collect())
    count = {}
    for _, k in rows:
        count[k] = count.get(k, 0) + 1
    assert got == sorted((k, i, i % 5) for i, k in rows if count[k] > 1)


def test_links_by_keys_lose_none(spark):
    """Links hold only between numbers of one parity, so the least node of a key often fails."""
    rng = random.Random(8)
    rows = [(rng.randrange(12), n) for n in range(60) for _ in range(2)]
    members = spark.createDataFrame(rows, "key long, node long")
    close = "(a + b) % 2 = 0 and abs(a - b) <= 20"
    got = {r.node: r.component for r in link_by_keys(members, lambda p: p.where(close)).collect()}
    links = [
        (a, b) for k, a in rows for j, b in rows
        if k == j and a < b and (a + b) % 2 == 0 and b - a <= 20
    ]
    assert got == expected(links)


def test_links_among_many_partners(spark, monkeypatch):
    """One key that all nodes have, links between few of them: some partners first, then all that are left."""
    monkeypatch.setattr("millrace.llm.linking.ROUNDS", 1)
    rng = random.Random(9)
    odd = {n: rng.randrange(9) for n in range(150)}
    rows = [(k, n) for n in odd for k in (1, 2 + n % 3)]
    number = F.element_at(F.create_map(*[F.lit(x) for item in odd.items() for x in item]), F.col("a").cast("int"))
    other = F.element_at(F.create_map(*[F.lit(x) for item in odd.items() for x in item]), F.col("b").cast("int"))
    members = spark.createDataFrame(rows, "key long, node long")
    got = {r.node: r.component for r in link_by_keys(members, lambda p: p.where(number == other)).collect()}
    assert got == expected([(a, b) for a in odd for b in odd if a < b and odd[a] == odd[b]])


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAbBÄé \t\n\x0b\x1c\x85\xa0", max_size=60))
def test_shingles(text):
    assert len(shingle_set(WordHashes().of(text))) == len(brute.grams(text))
