"""Queries of Avro payloads and of messages of many schema versions."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from millrace.plans.event_log import as_log, utc
from millrace.plans.registry import query, table
from millrace.streaming.avro_binary import decode_avro_bytes, encode_avro_bytes
from millrace.streaming.registry import decode_by_schema_id


def _record(*fields, name="Event") -> str:
    return json.dumps({"type": "record", "name": name, "namespace": "log", "fields": [
        {"name": n, "type": t, **(more[0] if more else {})} for n, t, *more in fields
    ]})


AMOUNT = {"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 2}
AT = {"type": "long", "logicalType": "timestamp-micros"}
WRITER = _record(
    ("offset", "long"), ("user_id", "int"), ("size", {"type": "enum", "name": "Size", "symbols": ["small", "large"]}),
    ("measure", "double"), ("amount", AMOUNT), ("at", AT), ("note", ["null", "string"]),
    ("tags", {"type": "array", "items": "string"}), ("counts", {"type": "map", "values": "long"}), ("k", "int"),
)
READER = _record(
    ("offset", "long"), ("customer", "long", {"aliases": ["user_id"]}), ("size", "string"), ("measure", "double"),
    ("amount", AMOUNT), ("at", AT), ("note", ["null", "string"]), ("tags", {"type": "array", "items": "string"}),
    ("counts", {"type": "map", "values": "long"}), ("k", "double"), ("channel", "string", {"default": "web"}),
)


def _event_records(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_id").alias("offset"), F.col("user_id").cast("int").alias("user_id"),
        F.when(F.col("value") < 50, "small").otherwise("large").alias("size"), F.col("value").alias("measure"),
        F.col("value").cast("decimal(12,2)").alias("amount"), utc("ts").alias("at"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("note"),
        F.filter(F.array(F.col("event_type"), F.when(F.col("value") >= 20, "mid"), F.when(F.col("value") >= 60, "high")), F.isnotnull).alias("tags"),
        F.create_map(F.col("event_type"), F.col("user_id") - 50).alias("counts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


@query("avro_decode", """
SELECT event_id AS "offset", value < 100 AS ok, CASE WHEN value < 100 THEN TRUE END AS same, CASE WHEN value < 100 THEN user_id END AS customer,
       CASE WHEN value < 50 THEN 'small' WHEN value < 100 THEN 'large' END AS size,
       CASE WHEN value < 100 THEN value END AS measure, CASE WHEN value < 100 THEN CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
       CASE WHEN value < 100 THEN epoch_us(ts) END AS at_us,
       CASE WHEN value < 100 AND event_id % 3 <> 0 THEN event_type END AS note,
       CASE WHEN value < 20 THEN event_type WHEN value < 60 THEN event_type || ',mid' WHEN value < 100 THEN event_type || ',mid,high' END AS tags,
       CASE WHEN value < 100 THEN user_id - 50 END AS counted,
       CASE WHEN value < 100 THEN CAST(json_extract(props, '$.k') AS DOUBLE) END AS k,
       CASE WHEN value < 100 THEN 'web' END AS channel
FROM events
""")
def _avro_decode(spark, sf):
    """Events as Avro bytes, some of them cut short, read by a newer schema than they were written by."""
    sent = encode_avro_bytes(_event_records(spark, sf), WRITER, keep=("offset", "measure", "note"))
    cut = F.expr("substring(value, 1, length(value) - 1)")
    log = sent.select(F.col("offset").alias("id"), F.when(F.col("measure") >= 100, cut).otherwise(F.col("value")).alias("value"))
    got = decode_avro_bytes(log, WRITER, READER, name="data", ok_col="ok")
    return got.select("id", "ok", "data.*").select(
        F.col("id").alias("offset"), "ok", (F.col("offset") == F.col("id")).alias("same"), "customer", "size", "measure", F.col("amount").cast("string").alias("amount"),
        F.unix_micros("at").alias("at_us"), "note", F.array_join("tags", ",").alias("tags"),
        F.map_values("counts")[0].alias("counted"), "k", "channel",
    )


# Three versions of one record: a field gets wider, changes its name, is added and made optional.
VERSIONS = {
    1: _record(("k", "int"), ("measure", "double")),
    2: _record(("k", "long"), ("value", "float"), ("user", ["null", {"type": "record", "name": "User", "fields": [{"name": "id", "type": "int"}]}])),
    3: _record(("measure", "double"), ("user", {"type": "record", "name": "User", "fields": [{"name": "id", "type": "long"}, {"name": "kind", "type": "string"}]})),
}
LATEST = _record(
    ("k", ["null", "long"], {"default": None}), ("measure", "double", {"aliases": ["value"]}),
    ("user", ["null", {"type": "record", "name": "User", "fields": [
        {"name": "id", "type": "long"}, {"name": "kind", "type": "string", "default": "none"},
    ]}], {"default": None}),
)
SCHEMA_ID_SQL = """
WITH m AS (
    SELECT event_id AS "offset", event_id % 5 AS version, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           value, user_id, event_type,
           CASE WHEN event_id % 5 = 4 THEN 'frame' WHEN event_id % 5 = 0 THEN 'schema'
                WHEN value >= 100 THEN {trouble} END AS problem
    FROM events)
SELECT "offset", CASE WHEN version < 4 THEN version END AS schema_id, problem,
       CASE WHEN problem IS NULL AND version IN (1, 2) THEN k END AS k,
       CASE WHEN problem IS NULL THEN CASE WHEN version = 2 THEN {float} ELSE value END END AS measure,
       CASE WHEN problem IS NULL AND (version = 3 OR version = 2 AND user_id % 2 = 0) THEN user_id END AS user_id,
       CASE WHEN problem IS NULL AND version = 3 THEN event_type
            WHEN problem IS NULL AND version = 2 AND user_id % 2 = 0 THEN 'none' END AS user_kind
FROM m
"""


def _registry(spark, sf):
    """The registry's rows, one per schema version; derived from the events so that every id is used."""
    texts = F.create_map(*[F.lit(x) for i, text in VERSIONS.items() for x in (i, text)])
    ids = table(spark, sf, "events").select((F.col("event_id") % 5).cast("int").alias("schema_id")).distinct()
    return ids.select("schema_id", texts[F.col("schema_id")].alias("schema")).where("schema is not null")


def _framed(events, payload):
    version = F.col("event_id") % 5
    head = F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(version), 8, "0")))
    return as_log(events, F.when(version == 4, payload).otherwise(F.concat(head, payload))).select("offset", "value")


def _opened(decoded):
    return decoded.select("offset", "schema_id", "problem", F.col("data.k").alias("k"), F.col("data.measure").alias("measure"),
                          F.col("data.user.id").alias("user_id"), F.col("data.user.kind").alias("user_kind"))


@query("decode_by_schema_id", SCHEMA_ID_SQL.format(
    float="value",
    trouble="CASE event_id % 5 WHEN 1 THEN 'field k' WHEN 2 THEN 'json' ELSE 'field measure' END",
))
def _decode_by_schema_id(spark, sf):
    """JSON messages of three schema versions and of unknown ones, some not fitting their own schema."""
    events = table(spark, sf, "events")
    number, far, version = F.get_json_object("props", "$.k").cast("bigint"), F.col("value") >= 100, F.col("event_id") % 5
    user = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind"))
    whole = F.when(far, number + (1 << 40)).otherwise(number)
    one = F.to_json(F.struct(whole.alias("k"), F.col("value").alias("measure")))
    even = F.when(F.col("user_id") % 2 == 0, F.struct(F.col("user_id").alias("id")))
    two = F.to_json(F.struct(number.alias("k"), "value", even.alias("user")))
    two = F.when(far, F.concat(two, F.lit(" {}"))).otherwise(two)
    three = F.to_json(F.struct(F.when(~far, F.col("value")).alias("measure"), user.alias("user")))
    text = F.when(version == 1, one).when(version == 2, two).otherwise(three)
    framed = _framed(events, F.encode(text, "UTF-8"))
    return _opened(decode_by_schema_id(framed, _registry(spark, sf), LATEST))


@query("decode_avro_by_schema_id", SCHEMA_ID_SQL.format(float="CAST(CAST(value AS FLOAT) AS DOUBLE)", trouble="'avro'"))
def _decode_avro_by_schema_id(spark, sf):
    """Avro messages of three schema versions and of unknown ones, some with bytes behind their end."""
    events = table(spark, sf, "events")
    number, user_id = F.get_json_object("props", "$.k").cast("bigint"), F.col("user_id")
    records = {
        1: events.select("*", number.cast("int").alias("k"), F.col("value").alias("measure")),
        2: events.select("*", number.alias("k"), F.when(user_id % 2 == 0, F.struct(user_id.cast("int").alias("id"))).alias("user")),
        3: events.select("*", F.col("value").alias("measure"), F.struct(user_id.alias("id"), F.col("event_type").alias("kind")).alias("user")),
    }
    keep = ("event_id", "user_id", "event_type", "ts", "far")
    parts = []
    for version, frame in records.items():
        rest = (F.col("event_id") % 5).isin([version] if version < 3 else [3, 4, 0])
        frame = frame.where(rest).withColumn("far", F.col("value") >= 100)
        parts.append(encode_avro_bytes(frame, VERSIONS[version], "payload", keep=keep))
    sent = parts[0].unionAll(parts[1]).unionAll(parts[2])
    payload = F.when(F.col("far"), F.concat("payload", F.lit(b"\x00"))).otherwise(F.col("payload"))
    # A message without a frame must not begin like one.
    framed = _framed(sent, F.when(F.col("event_id") % 5 == 4, F.concat(F.lit(b"\x01"), payload)).otherwise(payload))
    return _opened(decode_by_schema_id(framed, _registry(spark, sf), LATEST, payload="avro"))
