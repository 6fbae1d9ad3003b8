import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.sources.log import (
    fail_on_data_loss,
    offset_gaps,
    offset_ledger,
    read_messages,
    repeated_offsets,
    replay_log,
    select_offsets,
    select_ranges,
    select_topics,
    split_confluent_frame,
)


@pytest.fixture(scope="module")
def log(spark):
    rows = [
        (t, p, o) for t in ("orders", "orders-eu", "users") for p in (0, 1, 2) for o in range(10)
    ]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint").cache()


def picked(df):
    return {tuple(r) for r in df.select("topic", "partition", "offset").collect()}


def test_topics(log):
    assert {t for t, _, _ in picked(select_topics(log, "orders, users"))} == {"orders", "users"}
    assert {t for t, _, _ in picked(select_topics(log, ["users"]))} == {"users"}
    got = picked(select_topics(log, assign={"orders": [0, 2], "users": [1]}))
    assert {(t, p) for t, p, _ in got} == {("orders", 0), ("orders", 2), ("users", 1)}
    # The pattern has to match the whole name.
    assert {t for t, _, _ in picked(select_topics(log, pattern="orders"))} == {"orders"}
    assert {t for t, _, _ in picked(select_topics(log, pattern="orders.*|x"))} == {"orders", "orders-eu"}
    for bad in ({}, {"subscribe": "a", "pattern": "b"}, {"assign": {}}):
        with pytest.raises(ValueError):
            select_topics(log, **bad)


def test_offsets(log):
    assert picked(select_offsets(log)) == picked(log)
    got = picked(select_offsets(log, {"orders": {"0": 3, "1": -2}}, {"orders": {"0": 5, "1": -1}}))
    assert got == {("orders", 0, 3), ("orders", 0, 4)} | {("orders", 1, o) for o in range(10)}
    assert picked(select_offsets(log, "EARLIEST", {"users": {2: 1}})) == {("users", 2, 0)}
    assert picked(select_offsets(log, {"users": {2: 9}})) == {("users", 2, 9)}
    assert select_offsets(log, {}).count() == 0


@pytest.mark.parametrize(
    ("start", "end"),
    [
        ("latest", "latest"), ("earliest", "earliest"), ({"t": {0: -1}}, "latest"),
        ("earliest", {"t": {0: -2}}), ({"t": {0: -7}}, "latest"),
        ({"t": {0: 1}}, {"t": {1: 2}}),
    ],
)
def test_offsets_that_no_batch_read_can_have(log, start, end):
    with pytest.raises(ValueError):
        select_offsets(log, start, end)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(
    st.tuples(st.sampled_from(["orders", "users", "none"]), st.integers(0, 3)),
    st.tuples(st.integers(-2, 11).filter(lambda x: x != -1), st.integers(-1, 11)),
    max_size=6,
))
def test_ranges_against_brute_force(log, ranges):
    start, end = {}, {}
    for (t, p), (a, b) in ranges.items():
        start.setdefault(t, {})[p] = a
        end.setdefault(t, {})[p] = b
    want = {
        (t, p, o) for t, p, o in picked(log)
        if (t, p) in ranges and o >= ranges[t, p][0] and (ranges[t, p][1] == -1 or o < ranges[t, p][1])
    }
    assert picked(select_offsets(log, start, end)) == want


def test_offsets_reach_the_scan(spark, log, tmp_path):
    path = str(tmp_path / "log")
    log.write.parquet(path)
    df = select_offsets(spark.read.parquet(path), {"orders": {0: 3}}, {"orders": {0: 5}})
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(offset,3)" in pushed and "LessThan(offset,5)" in pushed
    assert "EqualTo(partition,0)" in pushed


def test_replay_of_a_stored_log(spark, log, tmp_path):
    path = str(tmp_path / "log")
    log.write.partitionBy("topic").parquet(path)
    got = replay_log(spark, path, subscribe="orders", ending={"orders": {0: 2, 1: 1}})
    assert picked(got) == {("orders", 0, 0), ("orders", 0, 1), ("orders", 1, 0)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan
    assert replay_log(spark, path, pattern="orders.*").count() == 60
    with pytest.raises(ValueError, match="exactly one"):
        replay_log(spark, path)


def test_payload_formats(spark):
    df = spark.createDataFrame(
        [(b"k", b"\x01", "AVRO"), (b"k", b"t", "json"), (None, b"u", None), (b"k", None, "avro")],
        "key binary, value binary, f string",
    )
    rows = [tuple(r) for r in read_messages(df, F.col("f")).collect()]
    assert rows == [
        ("k", b"\x01", None, "avro", "AVRO"), ("k", None, "t", "string", "json"),
        (None, None, "u", "string", None), ("k", None, None, "avro", "avro"),
    ]
    assert {r.format for r in read_messages(df, " Avro ").collect()} == {"avro"}


def test_confluent_frame(spark):
    df = spark.createDataFrame(
        [(b"\x00\x00\x00\x01\x02abc",), (b"\x00\xff\xff\xff\xff",), (b"\x01\x00\x00\x00\x01x",), (b"\x00\x01",), (None,)],
        "value binary",
    )
    rows = [(r.schema_id, r.payload) for r in split_confluent_frame(df).collect()]
    assert rows == [(258, b"abc"), (4294967295, b""), (None, None), (None, None), (None, None)]


def test_ledger(log):
    rows = {tuple(r) for r in offset_ledger(log.where("offset between 4 and 7")).collect()}
    assert ("orders", 0, 4, 8) in rows and len(rows) == 9


def spans(*rows):
    return [(t, 0, o) for t, first, last in rows for o in range(first, last)]


def test_gaps_across_pieces_and_stretches(spark):
    step = 1 << 24
    rows = spans(("a", 10, 20), ("a", 4090, 4100), ("a", step - 2, step + 2), ("a", 3 * step, 3 * step + 1), ("b", 5, 6), ("c", 0, 9000))
    log = spark.createDataFrame(rows + rows[:12], "topic string, partition int, offset bigint").repartition(5)
    got = sorted(tuple(r)[:4] for r in offset_gaps(log).collect())
    assert got == [("a", 0, 20, 4090), ("a", 0, 4100, step - 2), ("a", 0, step + 2, 3 * step)]
    since = spark.createDataFrame([("a", 0, 15), ("b", 0, 3), ("c", 0, 9000), ("d", 0, 7)], "topic string, partition int, until_offset bigint")
    late = log.where("topic <> 'c'")
    assert ("b", 0, 3, 5) in {tuple(r)[:4] for r in offset_gaps(late, since).collect()}
    assert {r["offset"] for r in repeated_offsets(log).collect()} == {*range(10, 20), 4090, 4091}
    whole = log.where("topic = 'c'")
    assert fail_on_data_loss(whole).count() == 9000
    with pytest.raises(Exception, match="lacks offsets: "):
        fail_on_data_loss(log).collect()
    assert offset_gaps(log.limit(0)).count() == 0


def test_ranges_of_a_table(spark):
    log = spark.createDataFrame([("a", i % 2, i) for i in range(1000)], "topic string, partition int, offset bigint").repartition(3)
    ranges = [("a", 0, 10, 20, "x"), ("a", 0, 15, 30, "y"), ("a", 1, None, 5, "z"), ("a", 1, 990, None, "w"), ("a", 0, 50, 50, "e"), ("b", 0, 0, 9, "n"), ("a", 0, 600, 5, "r")]
    table = spark.createDataFrame(ranges, "topic string, partition int, from_offset bigint, until_offset bigint, name string")
    inside = lambda o, f, u: (f is None or o >= f) and (u is None or o < u)
    want = sorted((t, i % 2, i, n) for i in range(1000) for t, p, f, u, n in ranges if t == "a" and p == i % 2 and inside(i, f, u))
    for width in (1, 7, 4096):
        got = select_ranges(log, table, width=width, keep=["name"])
        assert sorted(map(tuple, got.collect())) == want
        assert sorted(map(tuple, select_ranges(log, table, width=width).collect())) == sorted({w[:3] for w in want})
