import datetime
import json
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.streaming.avro import decode_avro
from millrace.streaming.messages import (
    CORRUPT,
    ENVELOPE,
    bad_messages,
    create_time,
    enrich_json,
    enrich_xml,
    envelope_rejects,
    good_messages,
    kafka_envelope,
    parse_messages,
    valid_messages,
    write_bad_records,
)

LOG = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, "
    "timestampType int"
)
AT = datetime.datetime(2021, 9, 30, 17, 27, 0, 5000, tzinfo=datetime.timezone.utc)
MILLIS = 1633022820005


def log_of(spark, *values, topic="test-topic", partition=0, first=100):
    rows = [
        (b"key", v if v is None or isinstance(v, bytes) else v.encode(), topic, partition, first + i, AT, 1)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, LOG)


FIELDS = T.StructType([
    T.StructField("field1", T.StringType()), T.StructField("field2", T.IntegerType())
])


def test_envelope(spark):
    out = kafka_envelope(log_of(spark, '{"field1":"value1"}', None))
    assert out.columns == ENVELOPE.fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in ENVELOPE]
    rows = [tuple(r) for r in out.collect()]
    assert rows[0] == ("key", '{"field1":"value1"}', "test-topic", 0, 100, MILLIS, 1)
    assert rows[1][1] is None
    assert out.select(F.unix_millis(create_time())).first()[0] == MILLIS
    no_zone = log_of(spark, "{}").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    assert kafka_envelope(no_zone).first().Kafka_CreateTime == MILLIS


def test_strict_envelope(spark):
    log = log_of(spark, "{}", None)
    strict = kafka_envelope(log, strict=True)
    assert strict.schema == ENVELOPE
    assert strict.count() == 1
    rejects = envelope_rejects(log)
    assert [r.Kafka_offset for r in rejects.collect()] == [101]
    assert rejects.where(F.col(CORRUPT).isNotNull()).count() == 1


VALUES = [
    '{"field1": "value1", "field2": 100}', "corrupt_value", '{"field1": "v", "field2": "abc"}',
    "{}", None, '{"field1": {"a": 1}, "field2": 3}', '["x"]', "", "   ", '{"field2":1} trailing',
    '{"field2":1}{"field2":2}',
]


def test_good_and_bad(spark):
    env = kafka_envelope(log_of(spark, *VALUES))
    parsed = parse_messages(env, FIELDS)
    good = good_messages(parsed, FIELDS, consumer_group="g", region="us-west-1")
    bad = bad_messages(parsed)
    assert good.columns == [
        "field1", "field2", "key", *ENVELOPE.fieldNames()[2:], "consumerGroupId", "data_center_region"
    ]
    got = {r.Kafka_offset: (r.field1, r.field2) for r in good.collect()}
    assert got[100] == ("value1", 100) and got[103] == (None, None) and got[104] == (None, None)
    assert got[105] == ('{"a":1}', 3)
    assert {r.consumerGroupId for r in good.collect()} == {"g"}
    assert {r.Kafka_offset: r[CORRUPT] for r in bad.collect()}[101] == "corrupt_value"
    assert {102, 107, 108, 109, 110}.issubset({r.Kafka_offset for r in bad.collect()})
    assert good.count() + bad.count() == len(VALUES)


def test_corrupt_rows_are_found_when_only_they_are_selected(spark):
    parsed = parse_messages(kafka_envelope(log_of(spark, '{"field2": "abc"}')), FIELDS)
    assert parsed.select(CORRUPT).where(F.col(CORRUPT).isNotNull()).count() == 1


def test_every_value_is_parsed_once(spark):
    env = kafka_envelope(log_of(spark, *VALUES))
    good = valid_messages(env, FIELDS, consumer_group="g", region="r")
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_required_fields(spark):
    env = kafka_envelope(log_of(spark, *VALUES))
    parsed = parse_messages(env, FIELDS, required=("field1",))
    assert 103 in {r.Kafka_offset for r in bad_messages(parsed).collect()}
    assert 104 not in {r.Kafka_offset for r in bad_messages(parsed).collect()}


def test_whole_message_and_no_schema_and_empty(spark):
    env = kafka_envelope(log_of(spark, *VALUES))
    args = {"consumer_group": "g", "region": "r"}
    whole = valid_messages(env, FIELDS, load_whole=True, **args)
    assert whole.where("Kafka_offset = 100").first().value == VALUES[0]
    assert valid_messages(env, None, **args).columns == ENVELOPE.fieldNames()
    none = valid_messages(env.where("false"), FIELDS, **args)
    assert none.count() == 0 and none.columns == valid_messages(env, FIELDS, **args).columns


def test_field_names_of_the_envelope_are_refused(spark):
    env = kafka_envelope(log_of(spark, "{}"))
    with pytest.raises(ValueError, match="Value"):
        parse_messages(env, T.StructType([T.StructField("Value", T.StringType())]))


def test_bad_record_sink(spark, tmp_path):
    env = kafka_envelope(log_of(spark, *VALUES))
    path = str(tmp_path / "bad")
    good = valid_messages(env, FIELDS, consumer_group="g", region="r", bad_path=path)
    assert spark.read.json(path).count() == len(VALUES) - good.count()
    write_bad_records(parse_messages(env, FIELDS), path)
    assert spark.read.json(path).count() == 2 * (len(VALUES) - good.count())
    write_bad_records(parse_messages(env, FIELDS), None)
    for _ in range(2):
        write_bad_records(parse_messages(env, FIELDS), f"{path}-once", run="7")
    assert spark.read.json(f"{path}-once").count() == len(VALUES) - good.count()


def test_enrich_json_text(spark):
    row = enrich_json(log_of(spark, '{"field": "value"}')).first()
    assert row.enriched == (
        '{"field": "value", "Kafka_topic":"test-topic","Kafka_offset":100,"Kafka_partitionId":0,'
        f'"Kafka_CreateTime":{MILLIS},"Json":"{{\\"field\\": \\"value\\"}}"}}'
    )


def test_enrich_json_with_headers(spark):
    headers = F.array(
        F.struct(F.lit("headerKey").alias("key"), F.lit(b"old").alias("value")),
        F.struct(F.lit("headerKey").alias("key"), F.lit(b"headerValue").alias("value")),
    )
    log = log_of(spark, '{"field": 1.50}').withColumn("headers", headers)
    out = enrich_json(log, header=True)
    text = out.first().enriched
    assert text.startswith('{"field": 1.50, ')
    assert list(json.loads(text)) == [
        "field", "Kafka_topic", "Kafka_offset", "Kafka_partitionId", "Kafka_CreateTime",
        "Kafka_header", "Json",
    ]
    assert json.loads(text)["Kafka_header"] == {"headerKey": "headerValue"}
    assert out.columns == [*log.columns, "enriched", "enriched_ok"]


@pytest.mark.parametrize(
    ("value", "want"),
    [
        (None, ""), ("{}", {}), (" \n{ } ", {}), ('{"a": "}"}\n', {"a": "}"}), ("[1]", None),
        ("x{}", None), ('{"a": 1', None), ("3", None), ("", None), ('{"k":1} trailing', None),
        ('{"a":1} }', None), ('{"Kafka_topic": "mine"}', None),
    ],
)
def test_enrich_json_shapes(spark, value, want):
    row = enrich_json(log_of(spark, value), whole=False).first()
    text = row.enriched
    assert row.enriched_ok == (text is not None)
    if isinstance(want, dict):
        got = json.loads(text)
        assert {k: v for k, v in got.items() if not k.startswith("Kafka_")} == want
        assert got["Kafka_offset"] == 100
    else:
        assert text == want


def test_enrich_xml(spark):
    log = log_of(
        spark, "<root><row>data</row><row>$1</row></root>", "<root><data>x</data></root>", None,
        topic="a&b$1", partition=1, first=123,
    )
    rows = enrich_xml(log, "row").orderBy("offset").collect()
    assert rows[0].enriched == (
        "<root><row>data</row><row>$1<Kafka_topic>a&amp;b$1</Kafka_topic><Kafka_offset>123"
        "</Kafka_offset><Kafka_partitionId>1</Kafka_partitionId><Kafka_CreateTime>"
        f"{MILLIS}</Kafka_CreateTime></row></root>"
    )
    assert ET.fromstring(rows[0].enriched).findall("row")[1].find("Kafka_topic").text == "a&b$1"
    assert [(r.enriched, r.enriched_ok) for r in rows[1:]] == [(None, False), ("", True)]


def test_enrich_xml_headers(spark):
    headers = F.array(*[
        F.struct(F.lit(k).alias("key"), F.lit(v).cast("binary").alias("value")) for k, v in (('a"<', "x&y"), ("b", None))
    ])
    log = log_of(spark, "<row/></row>").withColumn("headers", headers)
    text = enrich_xml(log, "row", header=True).first().enriched
    found = ET.fromstring(text.removeprefix("<row/>").join(["<row>", ""])).find("Kafka_header")
    assert [(h.get("key"), h.text) for h in found] == [('a"<', "x&y"), ("b", None)]


def test_avro_is_decoded_without_connector(spark):
    schema = json.dumps({"type": "record", "name": "C", "fields": [{"name": "id", "type": "int"}]})
    got = decode_avro(log_of(spark, b"\x02"), schema, star=True)
    assert got.columns == ["key", "id"] and got.first()["id"] == 1
