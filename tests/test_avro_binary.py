import datetime
import decimal
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.streaming.avro import decode_avro
from millrace.streaming.avro_binary import (
    Unresolvable, _write, decode_avro_bytes, decode_column, encode_avro_bytes, read_schema, resolve,
)
from millrace.streaming.registry import decode_by_schema_id


def record(*fields, **more):
    return json.dumps({"type": "record", "name": "R", "fields": [{"name": n, "type": t, **(x[0] if x else {})} for n, t, *x in fields], **more})


def written(schema, *values):
    node, out = read_schema(schema), []
    for value in values:
        body = bytearray()
        _write(node, value, body)
        out.append(bytes(body))
    return out


def read(writer, reader, payloads):
    found, ok = decode_column(pa.array(payloads, pa.binary()), resolve(read_schema(writer), read_schema(reader)))
    return found.to_pylist(), ok.tolist()


EVERYTHING = record(
    ("b", "boolean"), ("i", "int"), ("l", "long"), ("f", "float"), ("d", "double"), ("s", "string"), ("y", "bytes"),
    ("e", {"type": "enum", "name": "E", "symbols": ["A", "B", "C"]}), ("x", {"type": "fixed", "name": "X", "size": 3}),
    ("u", ["string", "null"]), ("a", {"type": "array", "items": ["null", "long"]}), ("m", {"type": "map", "values": {"type": "array", "items": "string"}}),
    ("r", {"type": "record", "name": "In", "fields": [{"name": "n", "type": "int"}, {"name": "again", "type": "E"}]}),
    ("c", {"type": "bytes", "logicalType": "decimal", "precision": 30, "scale": 4}),
    ("z", {"type": "fixed", "name": "Z", "size": 5, "logicalType": "decimal", "precision": 9, "scale": 2}),
)


def some_value(rng):
    text = lambda: "".join(rng.choice("aé€𝄞 ") for _ in range(rng.choice([0, 1, 5, 200])))
    return {
        "b": rng.random() < 0.5, "i": rng.choice([0, -1, 1, 63, 64, -65, (1 << 31) - 1, -(1 << 31)]),
        "l": rng.choice([0, -1, 1 << 40, -(1 << 62), (1 << 63) - 1, -(1 << 63)]), "f": rng.choice([0.5, -2.25, float("inf")]),
        "d": rng.choice([0.1, -1e300]), "s": text(), "y": text().encode(), "e": rng.choice("ABC"), "x": bytes(rng.randrange(256) for _ in range(3)),
        "u": rng.choice([None, text()]), "a": [rng.choice([None, 5, -(1 << 50)]) for _ in range(rng.choice([0, 1, 3, 70]))],
        "m": {f"k{i}": [text() for _ in range(rng.randrange(3))] for i in range(rng.randrange(3))},
        "r": {"n": rng.randrange(99), "again": rng.choice("ABC")},
        "c": decimal.Decimal(rng.choice([0, -1, 10**25, -10**29, 255, -32768])).scaleb(-4), "z": decimal.Decimal(rng.choice([0, -1, 999999999])).scaleb(-2),
    }


def plain(value):
    return {**value, "m": sorted(value["m"].items() if isinstance(value["m"], dict) else value["m"])}


def test_round_trip_of_all_types():
    rng = random.Random(1)
    values = [some_value(rng) for _ in range(400)]
    got, ok = read(EVERYTHING, EVERYTHING, written(EVERYTHING, *values))
    assert all(ok)
    assert [plain(g) for g in got] == [plain(v) for v in values]


def test_bytes_that_do_not_fit_are_flagged():
    rng = random.Random(2)
    good = written(EVERYTHING, *(some_value(rng) for _ in range(60)))
    cut = [p[:rng.randrange(len(p))] for p in good]
    longer = [p + b"\0" for p in good]
    mixed = [x for three in zip(good, cut, longer) for x in three] + [None]
    got, ok = read(EVERYTHING, EVERYTHING, mixed)
    assert ok == [True, False, False] * 60 + [True]
    assert [g is not None for g in got] == [True, False, False] * 60 + [False]


def test_noise_neither_crashes_nor_spills():
    rng = random.Random(3)
    noise = [bytes(rng.randrange(256) for _ in range(rng.randrange(90))) for _ in range(3000)]
    good = written(EVERYTHING, some_value(rng))
    got, ok = read(EVERYTHING, EVERYTHING, [x for n in noise for x in (n, good[0])])
    assert all(ok[1::2]) and not any(ok[0::2])
    assert all(g == got[1] for g in got[1::2])


def test_known_bytes():
    schema = record(("a", "long"), ("b", "string"))
    assert read(schema, schema, [b"\x36\x06foo", b"\x01\x00"])[0] == [{"a": 27, "b": "foo"}, {"a": -1, "b": ""}]
    items = record(("v", {"type": "array", "items": "long"}))
    blocks = b"\x04\x06\x36\x03\x04\x02\x04\x00"  # two items, then two in a block that tells its size
    assert read(items, items, [blocks, b"\x00"]) == ([{"v": [3, 27, 1, 2]}, {"v": []}], [True, True])


@pytest.mark.parametrize("writer, reader, value, want", [
    ("int", "long", 5, 5), ("int", "double", 5, 5.0), ("long", "float", 3, 3.0), ("float", "double", 0.5, 0.5),
    ("string", "bytes", "é", "é".encode()), ("bytes", "string", b"x", "x"), (["null", "int"], "long", 7, 7),
    ("int", ["null", "long"], 7, 7), (["null", "int"], ["null", "double"], None, None), (["int", "string"], ["long", "string"], 3, None),
    ({"type": "enum", "name": "E", "symbols": ["A", "B"]}, {"type": "enum", "name": "E", "symbols": ["A"], "default": "A"}, "B", "A"),
    ({"type": "int", "logicalType": "date"}, {"type": "int", "logicalType": "date"}, 1, datetime.date(1970, 1, 2)),
    ({"type": "long", "logicalType": "timestamp-millis"}, {"type": "long", "logicalType": "timestamp-micros"}, 1, None),
])
def test_resolution(writer, reader, value, want):
    got, ok = read(record(("v", writer)), record(("v", reader)), written(record(("v", writer)), {"v": value}))
    assert ok == [True]
    if isinstance(reader, list) and "string" in reader:
        assert got[0]["v"] == {"member0": 3, "member1": None}
    elif want is not None or value is None:
        assert got[0]["v"] == want


def test_fields_by_name_alias_and_default():
    writer = record(("gone", {"type": "array", "items": "string"}), ("old", "int"), ("kept", "string"))
    reader = record(
        ("kept", "string"), ("new", "long", {"aliases": ["older", "old"]}), ("added", ["null", "int"], {"default": None}),
        ("list", {"type": "array", "items": "int"}, {"default": [1, 2]}), ("money", {"type": "bytes", "logicalType": "decimal", "precision": 5, "scale": 1}, {"default": "\u0001\u0000"}),
    )
    got, _ = read(writer, reader, written(writer, {"gone": ["a", "b"], "old": 9, "kept": "k"}))
    assert got == [{"kept": "k", "new": 9, "added": None, "list": [1, 2], "money": decimal.Decimal("25.6")}]


@pytest.mark.parametrize("writer, reader", [
    (record(("a", "string")), record(("a", "int"))), (record(("a", "long")), record(("a", "int"))),
    (record(("a", "int")), record(("a", "int"), ("b", "int"))), (record(("a", "null")), record(("a", "int"))),
])
def test_what_cannot_be_resolved(writer, reader):
    with pytest.raises(Unresolvable):
        resolve(read_schema(writer), read_schema(reader))


def test_branches_the_reader_lacks_fail_their_rows():
    writer, reader = record(("v", ["null", "int", "string"])), record(("v", "int"))
    got, ok = read(writer, reader, [b"\x02\x04", b"\x00", b"\x04\x02x", b"\x08"])
    assert ok == [True, False, False, False] and got[0] == {"v": 2}


def test_recursive_schema_is_refused():
    with pytest.raises(ValueError, match="holds itself"):
        read_schema('{"type":"record","name":"N","fields":[{"name":"next","type":["null","N"]}]}')


def test_frames(spark):
    schema = record(("at", {"type": "long", "logicalType": "timestamp-millis"}), ("n", ["null", "int"]))
    df = spark.range(50).select(F.col("id").alias("key"), F.timestamp_millis(F.col("id") * 1000 + 7).alias("at"), F.when(F.col("id") % 2 == 0, F.col("id").cast("int")).alias("n"))
    sent = encode_avro_bytes(df, schema, keep=("key",))
    back = decode_avro(sent, schema, star=True)
    assert back.columns == ["key", "at", "n"]
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    broken = sent.withColumn("value", F.when(F.col("key") == 3, F.lit(b"\xff")).otherwise(F.col("value")))
    assert decode_avro(broken, schema, options={"mode": "PERMISSIVE"}).where("avroData is null").count() == 1
    with pytest.raises(Exception, match="do not fit"):
        decode_avro(broken, schema).collect()
    assert decode_avro_bytes(sent.limit(0), schema).count() == 0


def test_schema_ids_without_registry_rows(spark):
    registry = spark.createDataFrame([], "schema_id int, schema string")
    log = spark.createDataFrame([(bytearray(b"\0\0\0\0\x07{}"),), (None,), (bytearray(b"{}"),)], "value binary")
    for payload in ("json", "avro"):
        got = decode_by_schema_id(log, registry, record(("k", "int")), payload=payload).collect()
        assert sorted(str(r["problem"]) for r in got) == ["None", "frame", "schema"]
        assert all(r["data"] is None for r in got)


def test_json_values_by_their_own_schema(spark):
    registry = spark.createDataFrame([
        (1, record(("a b", "int"), ("s", ["null", "string"]))), (2, record(("a b", "string"))), (3, "no schema"),
        (4, record(("a b", {"type": "int", "logicalType": "date"}), ("s", "string"))),
    ], "schema_id int, schema string")
    reader = record(("a b", "int"), ("s", ["null", "string"], {"default": None}))
    rows = [
        (1, '{"a b": 1, "s": "x"}', None, 1), (1, '{"a b": "1"}', "field a b", None), (1, '{"a b": 5000000000}', "field a b", None),
        (1, '{"a b": 2}', None, 2), (1, '{"s": null}', "field a b", None), (1, "[1]", "json", None), (1, '{"a b": 1', "json", None),
        (1, '{"a b": 1, "s": 3}', "field s", None), (2, '{"a b": "1"}', "field a b", None), (3, '{"a b": 1}', "field a b", None),
        (4, '{"a b": 3, "s": "x"}', "field a b", None), (9, "{}", "schema", None),
    ]
    log = spark.createDataFrame([(i, bytearray(b"\0\0\0\0" + bytes([n]) + text.encode())) for i, (n, text, _, _) in enumerate(rows)], "i int, value binary")
    got = {r["i"]: r for r in decode_by_schema_id(log, registry, reader).collect()}
    for i, (_, text, problem, value) in enumerate(rows):
        assert got[i]["problem"] == problem, text
        assert (got[i]["data"] and got[i]["data"]["a b"]) == value, text
