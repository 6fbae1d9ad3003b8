"""The message log that the queries read, derived from ``events`` by projection alone.

``topic`` is the event type, ``partition`` the user id modulo four, and ``offset`` the event
id: offsets of a log grow within a topic-partition but need not be dense, so none has to be
counted out. The log with faults has its values damaged by a rule on the measured ``value``:
below 1 the message is null, from 100 up it is not one JSON value: something stands before it or
behind it, it comes twice, or there are only blanks. Of the others some hold their key twice, which is
no fault: the last one counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.registry import table

LOG_SQL = """
log AS (
  SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
         event_id AS "offset", epoch_us(ts) // 1000 AS ms, CAST(user_id AS VARCHAR) AS "key",
         props AS message, value AS measure,
         CASE WHEN value < 1 THEN NULL
              WHEN value < 100 THEN CASE WHEN event_id % 7 = 3 THEN '{"k": -1, ' || substring(props, 2) ELSE props END
              ELSE CASE event_id % 5 WHEN 0 THEN 'x' || props WHEN 1 THEN '  '
                   WHEN 2 THEN props || ' trailing' WHEN 3 THEN props || props ELSE '' END
              END AS faulty,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k, user_id
  FROM events)
"""


def utc(col: str) -> Column:
    """A time without zone, read as UTC whatever the session's zone is."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), col).cast("timestamp")


def as_log(events: DataFrame, value: Column) -> DataFrame:
    """``events`` (batch or stream) in the columns of the message-log source."""
    return events.select(
        F.encode(F.col("user_id").cast("string"), "UTF-8").alias("key"),
        value.alias("value"),
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        utc("ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def plain_value() -> Column:
    return F.encode("props", "UTF-8")


def faulty_value() -> Column:
    measure = F.col("value")
    kind = F.col("event_id") % 5
    broken = (
        F.when(kind == 0, F.concat(F.lit("x"), "props")).when(kind == 1, "  ")
        .when(kind == 2, F.concat("props", F.lit(" trailing")))
        .when(kind == 3, F.concat("props", "props")).otherwise("")
    )
    twice = F.concat(F.lit('{"k": -1, '), F.expr("substring(props, 2)"))
    text = F.when(measure >= 100, broken).when(F.col("event_id") % 7 == 3, twice).otherwise(F.col("props"))
    return F.when(measure >= 1, F.encode(text, "UTF-8"))


def event_log(spark: SparkSession, sf_dir: str, *, faulty: bool = False) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return as_log(events, faulty_value() if faulty else plain_value())
