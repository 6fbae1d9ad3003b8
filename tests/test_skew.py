"""Inputs in which one key holds a third of all rows, with every join shuffled."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.aggspec import agg_spec
from millrace.operators.report import join_on, min_pair_match
from millrace.sources.files import sync_plan
from millrace.sources.schemas import latest_schemas

N = 9000


@pytest.fixture
def shuffled(spark):
    """No broadcast, and adaptive execution splits partitions from a few kilobytes on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8kb",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return [
        (0 if rng.random() < 0.34 else rng.randrange(1, 400), rng.randrange(60), rng.randrange(60), i)
        for i in range(N)
    ]


@pytest.fixture
def frame(shuffled, rows):
    return shuffled.createDataFrame(rows, "k int, d int, p int, i int").repartition(8)


def test_min_pair_match(frame, rows):
    low = {}
    for k, d, p, _ in rows:
        a, b = low.get(k, (d, p))
        low[k] = (min(a, d), min(b, p))
    want = sorted(r for r in rows if (r[1], r[2]) == low[r[0]])
    assert sorted(tuple(r) for r in min_pair_match(frame, ["k"], "d", "p").collect()) == want
    assert any(r[0] == 0 for r in want)


def test_a_third_of_all_rows_tie(shuffled, rows):
    tied = [(0, 0, 0, i) if k == 0 else (k, d, p, i) for k, d, p, i in rows]
    frame = shuffled.createDataFrame(tied, "k int, d int, p int, i int").repartition(8)
    found = min_pair_match(frame, ["k"], "d", "p")
    names = shuffled.createDataFrame([(k, f"n{k}") for k in range(400)], "k int, name string")
    hot = join_on(found, names, "k").where("k = 0")
    assert hot.count() == sum(1 for r in tied if r[0] == 0)


def test_join_and_aggregate(shuffled, frame, rows):
    names = shuffled.createDataFrame([(k, f"n{k % 3}") for k in range(400)], "k int, name string")
    joined = join_on(frame, names, "k")
    assert joined.count() == N
    out = agg_spec(joined, "count(*)|sum(p)", alias="snake", group_by=["name"])
    want = {}
    for k, _, p, _ in rows:
        n, s = want.get(f"n{k % 3}", (0, 0))
        want[f"n{k % 3}"] = (n + 1, s + p)
    assert {r.name: (r.count_all, r.sum_p) for r in out.collect()} == want


def test_latest_schemas(frame, rows):
    registry = frame.select(
        F.format_string("%d-value", "k").alias("subject"), F.col("i").alias("version"),
        F.col("i").cast("string").alias("schema"),
    )
    newest = {f"{k}-value": str(max(i for x, _, _, i in rows if x == k)) for k in {r[0] for r in rows}}
    assert {r.subject: r.schema for r in latest_schemas(registry).collect()} == newest


def test_sync_plan_keeps_every_file(frame):
    source = frame.select(F.format_string("d%d/f%d", "k", "i").alias("path"), F.col("p").alias("size"))
    source = source.withColumn("checksum", F.sha2(F.col("path"), 256))
    target = source.where("size > 30")
    plan = sync_plan(source, target)
    assert plan.count() == N
    assert plan.where("action = 'delete_source'").count() == target.count()
