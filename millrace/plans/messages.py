"""Queries of the message-log, validation, enrichment and stream operators."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.jobs import load_job_status
from millrace.plans.event_log import LOG_SQL, as_log, event_log, faulty_value, plain_value
from millrace.plans.registry import query, table
from millrace.session import scratch_path
from millrace.sources.log import (
    offset_gaps,
    offset_ledger,
    read_messages,
    select_offsets,
    select_ranges,
    select_topics,
    split_confluent_frame,
)
from millrace.sources.readers import stream_source
from millrace.sources.schemas import latest_schemas
from millrace.streaming.ingest import (
    read_committed,
    run_to_end,
    split_schemas,
    split_writer,
    start_sink,
    start_split,
)
from millrace.streaming.messages import (
    bad_messages,
    enrich_json,
    enrich_xml,
    kafka_envelope,
    parse_messages,
    valid_messages,
)

PAYLOAD = T.StructType([T.StructField("k", T.IntegerType())])
GROUP, REGION = "ingest-group", "region-1"
OUT_SQL = 'topic, "partition", "offset", "key", message AS value'


def _out(df):
    return df.select(
        "topic", "partition", "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


@query("log_scan", f"WITH {LOG_SQL} SELECT {OUT_SQL} FROM log")
def _log_scan(spark, sf):
    return _out(event_log(spark, sf))


@query("log_subscribe", f"""
WITH {LOG_SQL} SELECT {OUT_SQL} FROM log WHERE topic IN ('click', 'view')
""")
def _log_subscribe(spark, sf):
    return _out(select_topics(event_log(spark, sf), subscribe="click, view"))


@query("log_assign", f"""
WITH {LOG_SQL} SELECT {OUT_SQL} FROM log
WHERE topic = 'click' AND "partition" IN (0, 2) OR topic = 'error' AND "partition" = 1
""")
def _log_assign(spark, sf):
    return _out(select_topics(event_log(spark, sf), assign={"click": [0, 2], "error": [1]}))


@query("log_subscribe_pattern", f"""
WITH {LOG_SQL} SELECT {OUT_SQL} FROM log WHERE regexp_full_match(topic, 's.*p|.*rror')
""")
def _log_subscribe_pattern(spark, sf):
    return _out(select_topics(event_log(spark, sf), pattern="s.*p|.*rror"))


@query("log_offset_range", f"""
WITH {LOG_SQL} SELECT {OUT_SQL} FROM log
WHERE topic = 'click' AND "partition" = 0 AND "offset" >= 200 AND "offset" < 700
   OR topic = 'view' AND "partition" = 3 AND "offset" < 500
   OR topic = 'error' AND "partition" = 1 AND "offset" >= 300
""")
def _log_offset_range(spark, sf):
    return _out(
        select_offsets(
            event_log(spark, sf),
            starting={"click": {"0": 200}, "view": {"3": -2}, "error": {"1": 300}},
            ending={"click": {"0": 700}, "view": {"3": 500}, "error": {"1": -1}},
        )
    )


@query("log_format_switch", f"""
WITH {LOG_SQL}
SELECT topic, CASE WHEN topic IN ('click', 'view') THEN 'avro' ELSE 'string' END AS format,
       count(*) FILTER (topic IN ('click', 'view')) AS n_raw,
       count(*) FILTER (topic NOT IN ('click', 'view')) AS n_string
FROM log GROUP BY ALL
""")
def _log_format_switch(spark, sf):
    word = F.when(F.col("topic").isin("click", "view"), "AVRO").otherwise("json")
    return (
        read_messages(event_log(spark, sf), word)
        .groupBy("topic", "format")
        .agg(F.count("value_raw").alias("n_raw"), F.count("value_string").alias("n_string"))
    )


@query("kafka_envelope", f"""
WITH {LOG_SQL}
SELECT "key", message AS value, topic AS "Kafka_topic", "partition" AS "Kafka_partitionId",
       "offset" AS "Kafka_offset", ms AS "Kafka_CreateTime",
       CAST(0 AS INTEGER) AS "timestampType"
FROM log
""")
def _kafka_envelope(spark, sf):
    return kafka_envelope(event_log(spark, sf))


GOOD_SQL = f"""
WITH {LOG_SQL}
SELECT CASE WHEN faulty IS NOT NULL THEN k END AS k, "key", topic AS "Kafka_topic",
       "partition" AS "Kafka_partitionId", "offset" AS "Kafka_offset",
       ms AS "Kafka_CreateTime", CAST(0 AS INTEGER) AS "timestampType",
       '{GROUP}' AS "consumerGroupId", '{REGION}' AS data_center_region
FROM log WHERE measure < 100
"""


@query("valid_messages", GOOD_SQL)
def _valid_messages(spark, sf):
    envelope = kafka_envelope(event_log(spark, sf, faulty=True))
    return valid_messages(envelope, PAYLOAD, consumer_group=GROUP, region=REGION)


@query("valid_messages_no_schema", f"""
WITH {LOG_SQL}
SELECT "key", faulty AS value, topic AS "Kafka_topic", "partition" AS "Kafka_partitionId",
       "offset" AS "Kafka_offset", ms AS "Kafka_CreateTime",
       CAST(0 AS INTEGER) AS "timestampType"
FROM log
""")
def _valid_messages_no_schema(spark, sf):
    envelope = kafka_envelope(event_log(spark, sf, faulty=True))
    return valid_messages(envelope, None, consumer_group=GROUP, region=REGION)


@query("valid_messages_empty", f"""
WITH {LOG_SQL}, good AS (SELECT * FROM log WHERE measure < 100 AND topic = 'no-such-topic')
SELECT topic, count(*) FILTER (topic IN (SELECT topic FROM good)) AS n FROM log GROUP BY topic
""")
def _valid_messages_empty(spark, sf):
    """Valid messages by topic, of a topic that the log does not hold."""
    log = event_log(spark, sf, faulty=True)
    none = select_topics(log, subscribe="no-such-topic")
    good = valid_messages(kafka_envelope(none), PAYLOAD, consumer_group=GROUP, region=REGION)
    counts = good.groupBy(F.col("Kafka_topic").alias("topic")).agg(F.count(F.lit(1)).alias("n"))
    topics = log.groupBy("topic").agg(F.lit(0).cast("bigint").alias("none"))
    return topics.join(counts, "topic", "left").select("topic", F.coalesce("n", "none").alias("n"))


@query("bad_records", f"""
WITH {LOG_SQL}
SELECT topic AS "Kafka_topic", "partition" AS "Kafka_partitionId", "offset" AS "Kafka_offset",
       faulty AS _corrupt_record
FROM log WHERE measure >= 100
""")
def _bad_records(spark, sf):
    parsed = parse_messages(kafka_envelope(event_log(spark, sf, faulty=True)), PAYLOAD)
    return bad_messages(parsed).select(
        "Kafka_topic", "Kafka_partitionId", "Kafka_offset", "_corrupt_record"
    )


ENRICHED = (
    "k int, Kafka_topic string, Kafka_offset bigint, Kafka_partitionId int, "
    "Kafka_CreateTime bigint, Kafka_header map<string,string>, Json string"
)


@query("enrich_json", f"""
WITH {LOG_SQL}
SELECT "offset", CASE WHEN faulty IS NULL THEN 'empty' WHEN measure >= 100 THEN 'null'
                 ELSE 'object' END AS kind,
       CASE WHEN good THEN k END AS k, CASE WHEN good THEN topic END AS "Kafka_topic",
       CASE WHEN good THEN "offset" END AS "Kafka_offset",
       CASE WHEN good THEN "partition" END AS "Kafka_partitionId",
       CASE WHEN good THEN ms END AS "Kafka_CreateTime", CASE WHEN good THEN faulty END AS "Json"
FROM (SELECT *, faulty IS NOT NULL AND measure < 100 AS good FROM log)
""")
def _enrich_json(spark, sf):
    enriched = enrich_json(event_log(spark, sf, faulty=True))
    text = F.col("enriched")
    kind = F.when(text.isNull(), "null").when(text == "", "empty").otherwise("object")
    back = F.from_json(text, ENRICHED, {"mode": "PERMISSIVE"})
    opened = enriched.select("offset", kind.alias("kind"), F.inline(F.array(back)))
    return opened.drop("Kafka_header")


@query("enrich_json_headers", f"""
WITH {LOG_SQL}
SELECT "offset", k, topic AS "Kafka_topic", "key" AS header_user, topic AS header_type FROM log
""")
def _enrich_json_headers(spark, sf):
    log = event_log(spark, sf).withColumn(
        "headers",
        F.array(
            F.struct(F.lit("user").alias("key"), F.col("key").alias("value")),
            F.struct(F.lit("type").alias("key"), F.encode("topic", "UTF-8").alias("value")),
        ),
    )
    back = F.from_json("enriched", ENRICHED, {"mode": "FAILFAST"})
    return (
        enrich_json(log, header=True, whole=False)
        .select("offset", F.inline(F.array(back)))
        .select(
            "offset",
            "k",
            "Kafka_topic",
            F.col("Kafka_header")["user"].alias("header_user"),
            F.col("Kafka_header")["type"].alias("header_type"),
        )
    )


@query("enrich_xml", f"""
WITH {LOG_SQL}
SELECT "offset", k, topic AS "Kafka_topic", "partition" AS "Kafka_partitionId",
       "offset" AS "Kafka_offset", ms AS "Kafka_CreateTime", "key" AS header_user,
       TRUE AS enriched_ok
FROM log
""")
def _enrich_xml(spark, sf):
    events = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    xml = F.concat(F.lit("<root><row><k>"), k, F.lit("</k></row></root>"))
    log = as_log(events, F.encode(xml, "UTF-8"))
    user = F.struct(F.lit("user").alias("key"), F.col("key").alias("value"))
    enriched = enrich_xml(log.withColumn("headers", F.array(user)), "row", header=True)
    form = (
        "row struct<k: int, Kafka_topic: string, Kafka_partitionId: int, Kafka_offset: bigint, "
        "Kafka_CreateTime: bigint, Kafka_header: struct<header: struct<_VALUE: string, _key: string>>>"
    )
    back = F.from_xml("enriched", form, {"mode": "FAILFAST"})
    return (
        enriched.select("offset", "enriched_ok", F.inline(F.array(back)))
        .select("offset", "enriched_ok", "row.*")
        .withColumn("header_user", F.when(F.col("Kafka_header.header._key") == "user", F.col("Kafka_header.header._VALUE")))
        .drop("Kafka_header")
    )


@query("confluent_frame", f"""
WITH {LOG_SQL} SELECT "offset", user_id AS schema_id, message AS payload FROM log
""")
def _confluent_frame(spark, sf):
    events = table(spark, sf, "events")
    head = F.unhex(F.concat(F.lit("00"), F.lpad(F.hex("user_id"), 8, "0")))
    framed = as_log(events, F.concat(head, F.encode("props", "UTF-8")))
    return split_confluent_frame(framed).select(
        "offset", "schema_id", F.col("payload").cast("string").alias("payload")
    )


@query("offset_ledger", f"""
WITH {LOG_SQL}
SELECT topic, "partition", min("offset") AS from_offset, max("offset") + 1 AS until_offset
FROM log GROUP BY ALL
""")
def _offset_ledger(spark, sf):
    return offset_ledger(event_log(spark, sf))


@query("log_range_join", f"""
WITH {LOG_SQL}, r AS (
  SELECT topic, "partition", "offset" AS f, CASE WHEN user_id % 50 <> 7 THEN "offset" + user_id % 40 END AS u
  FROM log WHERE "offset" % 9 = 0 AND user_id % 50 < 8)
SELECT {OUT_SQL} FROM log AS l
WHERE EXISTS (SELECT 1 FROM r WHERE r.topic = l.topic AND r."partition" = l."partition" AND l."offset" >= f
              AND (u IS NULL OR l."offset" < u) AND (u IS NOT NULL OR topic = 'click'))
""")
def _log_range_join(spark, sf):
    """Messages in as many ranges as there are events of a kind; some overlap, are empty or have no end."""
    log = event_log(spark, sf)
    user = F.col("key").cast("string").cast("bigint")
    until = F.when(user % 50 != 7, F.col("offset") + user % 40)
    ranges = log.where((F.col("offset") % 9 == 0) & (user % 50 < 8)).where(until.isNotNull() | (F.col("topic") == "click"))
    ranges = ranges.select("topic", "partition", F.col("offset").alias("from_offset"), until.alias("until_offset"))
    return _out(select_ranges(log, ranges, width=256))


GAPS_SQL = """
WITH o AS (
  SELECT DISTINCT 't' || event_id // 5000 AS topic, CAST(event_id % 2 AS INTEGER) AS "partition", event_id // 2 AS "offset"
  FROM events WHERE value < 60 AND event_id // 700 % 5 <> 3),
n AS (SELECT *, lead("offset") OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS after FROM o)
SELECT topic, "partition", "offset" + 1 AS from_offset, after AS until_offset, after - "offset" - 1 AS missing
FROM n WHERE after > "offset" + 1
"""


@query("offset_gaps", GAPS_SQL)
def _offset_gaps(spark, sf):
    """Gaps in a log that has lost single messages and long stretches, and holds some messages twice."""
    events = table(spark, sf, "events")
    kept = events.where((F.col("value") < 60) & (F.expr("event_id div 700") % 5 != 3))
    kept = kept.unionAll(kept.where("value < 5"))
    log = kept.select(
        F.concat(F.lit("t"), F.expr("event_id div 5000")).alias("topic"), (F.col("event_id") % 2).cast("int").alias("partition"),
        F.expr("event_id div 2").alias("offset"),
    )
    return offset_gaps(log)


@query("registry_latest_schema", """
WITH r AS (
  SELECT 'user' || user_id || '-value' AS subject, event_id AS version,
         '{"type":"record","name":"' || event_type || '","fields":[{"name":"k","type":"int"}]}'
           AS schema
  FROM events)
SELECT 'user' || c_custkey AS topic, subject, max(version) AS version,
       arg_max(schema, version) AS schema
FROM customer JOIN r ON subject = 'user' || c_custkey || '-value' GROUP BY ALL
""")
def _registry_latest_schema(spark, sf):
    text = '{"type":"record","name":"%s","fields":[{"name":"k","type":"int"}]}'
    registry = table(spark, sf, "events").select(
        F.format_string("user%d-value", "user_id").alias("subject"),
        F.col("event_id").alias("version"),
        F.format_string(text, "event_type").alias("schema"),
    )
    topics = table(spark, sf, "customer").select(
        F.format_string("user%d", "c_custkey").alias("topic")
    )
    return latest_schemas(registry, topics)


@query("load_job_status", """
WITH jobs AS (
  SELECT 'tbl_' || user_id AS destination, ts,
         CASE WHEN event_type = 'error' THEN props END AS error
  FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 36 HOUR),
newest AS (
  SELECT destination, count(*) AS n, arg_max(coalesce(error, 'none'), ts) AS last_error
  FROM jobs GROUP BY 1)
SELECT 'tbl_' || c_custkey AS destination,
       CASE WHEN n IS NULL THEN 'unmatched' WHEN last_error = 'none' THEN 'ok'
            ELSE 'failed' END AS status,
       CASE WHEN last_error <> 'none' THEN last_error END AS reason,
       coalesce(n, 0) AS jobs
FROM customer LEFT JOIN newest ON destination = 'tbl_' || c_custkey
""")
def _load_job_status(spark, sf):
    jobs = table(spark, sf, "events").select(
        F.format_string("tbl_%d", "user_id").alias("destination"),
        F.col("ts").alias("created"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error"),
    )
    targets = table(spark, sf, "customer").select(
        F.format_string("tbl_%d", "c_custkey").alias("destination")
    )
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return load_job_status(targets, jobs, now=now, window=timedelta(hours=36))


@query("stream_ingest", f"""
WITH {LOG_SQL} SELECT topic, "partition", "offset", "key", k FROM log
""")
def _stream_ingest(spark, sf):
    """Stream to a Parquet sink, run to its end; the result is the sink's content."""
    root = scratch_path(spark, "stream-ingest")
    events = table(spark, sf, "events")
    stream = stream_source(spark, "parquet", f"{sf.rstrip('/')}/events.parquet", events.schema)
    decoded = _out(as_log(stream, plain_value())).select(
        "topic", "partition", "offset", "key",
        F.from_json("value", PAYLOAD, {"mode": "PERMISSIVE"}).alias("data"),
    ).select("topic", "partition", "offset", "key", "data.*")
    query_ = start_sink(
        decoded, "parquet", f"{root}/checkpoint", path=f"{root}/out", available_now=True
    )
    run_to_end(query_)
    return spark.read.schema(decoded.schema).parquet(f"{root}/out")


@query("stream_valid_split", f"""
WITH {LOG_SQL}
SELECT topic, "offset", measure < 100 AS good,
       CASE WHEN measure < 100 AND faulty IS NOT NULL THEN k END AS k,
       CASE WHEN measure >= 100 THEN faulty END AS raw
FROM log
""")
def _stream_valid_split(spark, sf):
    """Stream with a split sink, run to its end; the result is both sinks' content."""
    root = scratch_path(spark, "stream-split")
    events = table(spark, sf, "events")
    stream = stream_source(spark, "parquet", f"{sf.rstrip('/')}/events.parquet", events.schema)
    write = split_writer(
        PAYLOAD, f"{root}/good", f"{root}/bad", consumer_group=GROUP, region=REGION,
        ledger_path=f"{root}/ledger", commit_path=f"{root}/commits",
    )
    run_to_end(
        start_split(as_log(stream, faulty_value()), write, f"{root}/checkpoint", available_now=True)
    )
    good_schema, bad_schema = split_schemas(PAYLOAD)
    good = read_committed(spark, f"{root}/good", f"{root}/commits", "good", good_schema).select(
        F.col("Kafka_topic").alias("topic"), F.col("Kafka_offset").alias("offset"),
        F.lit(True).alias("good"), "k", F.lit(None).cast("string").alias("raw"),
    )
    bad = read_committed(spark, f"{root}/bad", f"{root}/commits", "bad", bad_schema).select(
        F.col("Kafka_topic").alias("topic"), F.col("Kafka_offset").alias("offset"),
        F.lit(False).alias("good"), F.lit(None).cast("int").alias("k"),
        F.col("_corrupt_record").alias("raw"),
    )
    return good.unionByName(bad)
