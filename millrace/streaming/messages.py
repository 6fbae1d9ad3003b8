"""Message envelope, schema check with corrupt-record split, metadata enrichment.

All functions take batch and streaming frames alike: each is a projection or a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import is_json, xml_escape
from millrace.operators.shapes import quoted

# The names and types of the envelope.
ENVELOPE = T.StructType([
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.StringType(), False),
    T.StructField("Kafka_topic", T.StringType(), False),
    T.StructField("Kafka_partitionId", T.IntegerType(), False),
    T.StructField("Kafka_offset", T.LongType(), False),
    T.StructField("Kafka_CreateTime", T.LongType(), False),
    T.StructField("timestampType", T.IntegerType(), False),
])
CORRUPT = "_corrupt_record"
# Fixed value: the blanks JSON allows around a value.
JSON_BLANKS = " \t\r\n"


def _millis(col: str = "timestamp") -> Column:
    """Epoch milliseconds; a stored log may hold its times without zone."""
    return F.unix_millis(F.col(col).cast("timestamp"))


def _envelope_columns() -> dict[str, Column]:
    return {
        "key": F.col("key").cast("string"),
        "value": F.col("value").cast("string"),
        "Kafka_topic": F.col("topic"),
        "Kafka_partitionId": F.col("partition"),
        "Kafka_offset": F.col("offset"),
        "Kafka_CreateTime": _millis(),
        "timestampType": F.col("timestampType"),
    }


def create_time(col: Column | str = "Kafka_CreateTime") -> Column:
    """The envelope's create time, which is epoch milliseconds, as a timestamp."""
    return F.timestamp_millis(F.col(col) if isinstance(col, str) else col)


def _complete() -> Column:
    return F.forall(
        F.array(*[F.col(n).isNull() for n in ENVELOPE.fieldNames()]), lambda missing: ~missing
    )


def kafka_envelope(df: DataFrame, *, strict: bool = False) -> DataFrame:
    """The message-log columns as the envelope.

    A null value (tombstone) stays a row. With ``strict`` every column is declared NOT NULL and
    rows with a null leave; :func:`envelope_rejects` gives those.
    """
    out = df.select(*[c.alias(n) for n, c in _envelope_columns().items()])
    if not strict:
        return out
    zero = {T.StringType(): "", T.IntegerType(): 0, T.LongType(): 0}
    return out.where(_complete()).select(
        *[
            F.coalesce(F.col(f.name), F.lit(zero[f.dataType]).cast(f.dataType)).alias(f.name)
            for f in ENVELOPE.fields
        ]
    )


def envelope_rejects(df: DataFrame) -> DataFrame:
    """The rows that a strict envelope leaves out, as a nullable envelope with the raw value
    under the corrupt-record name as well, for the bad-record sink."""
    rows = kafka_envelope(df).where(~_complete())
    return rows.withColumn(CORRUPT, F.coalesce(F.col("value"), F.lit("")))


def parse_messages(
    envelope: DataFrame, schema: T.StructType, *, required: tuple[str, ...] = ()
) -> DataFrame:
    """Envelope plus the fields of ``schema`` plus ``_corrupt_record``.

    The record column holds the raw text of a value that is not one JSON value (blank texts and
    ones with anything behind the value are not) or does not fit the schema. ``required`` fields that are missing or null also make a (non-null) value corrupt.
    The struct is opened by a generator rather than by field access, because a later filter on
    the corrupt column would otherwise be pushed below and parse every value a second time.
    """
    taken = {n.lower() for n in (*envelope.columns, CORRUPT)}
    clash = [n for n in schema.fieldNames() if n.lower() in taken]
    if clash:
        raise ValueError(f"schema fields named like envelope columns: {', '.join(clash)}")
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col("value"), full, options)
    out = envelope.select("*", F.inline(F.array(parsed)))
    bad = ~is_json("value")
    for name in required:
        bad = bad | F.col(quoted(name)).isNull()
    return out.withColumn(CORRUPT, F.coalesce(F.col(CORRUPT), F.when(bad, F.col("value"))))


def good_messages(
    parsed: DataFrame,
    schema: T.StructType,
    *,
    consumer_group: str,
    region: str,
    load_whole: bool = False,
) -> DataFrame:
    """The good rows of :func:`parse_messages`: schema fields, envelope, two constants.

    The raw value is kept only with ``load_whole``.
    """
    head = [n for n in ENVELOPE.fieldNames() if n != "value" or load_whole]
    return parsed.where(F.col(CORRUPT).isNull()).select(
        *[F.col(quoted(n)) for n in schema.fieldNames()],
        *head,
        F.lit(consumer_group).alias("consumerGroupId"),
        F.lit(region).alias("data_center_region"),
    )


def bad_messages(parsed: DataFrame) -> DataFrame:
    """The bad rows of :func:`parse_messages`: envelope and the raw text."""
    return parsed.where(F.col(CORRUPT).isNotNull()).select(*ENVELOPE.fieldNames(), CORRUPT)


def valid_messages(
    envelope: DataFrame,
    schema: T.StructType | None,
    *,
    consumer_group: str,
    region: str,
    load_whole: bool = False,
    required: tuple[str, ...] = (),
    bad_path: str | None = None,
    run: str | None = None,
) -> DataFrame:
    """Valid messages of an envelope with a schema; the envelope unparsed without one.

    With ``bad_path`` the bad rows are written there now, in a job of its own (see
    :func:`write_bad_records` for ``run``); persist the envelope first if its source is costly
    to read twice.
    """
    if schema is None:
        return envelope
    parsed = parse_messages(envelope, schema, required=required)
    write_bad_records(bad_messages(parsed), bad_path, run=run)
    return good_messages(
        parsed, schema, consumer_group=consumer_group, region=region, load_whole=load_whole
    )


def write_bad_records(
    df: DataFrame, path: str | None, fmt: str = "json", *, run: str | None = None
) -> None:
    """Add the rows with a corrupt record to ``path``; without a path nothing is done.

    With ``run`` they go to the folder ``run=<run>`` and replace what an earlier attempt of the
    same run has left there, so that a repeated job writes no row twice.
    """
    if path:
        bad = df.where(F.col(CORRUPT).isNotNull()).write.format(fmt)
        if run is None:
            bad.mode("append").save(path)
        else:
            bad.mode("overwrite").save(f"{path.rstrip('/')}/run={run}")


def _text_headers(headers: Column) -> Column:
    """Headers ``array<struct<key, value binary>>`` as a map of text; the last of a repeated
    key stands."""
    keys, values = headers["key"], headers["value"].cast("array<string>")
    distinct = F.array_distinct(keys)
    last = F.transform(
        distinct, lambda k: F.element_at(F.filter(headers, lambda h: h["key"] == k), -1)["value"]
    ).cast("array<string>")
    unique = F.size(distinct) == F.size(keys)
    return F.when(unique, F.map_from_arrays(keys, values)).when(
        ~unique, F.map_from_arrays(distinct, last)
    )


def enrich_json(
    df: DataFrame, *, header: bool = False, whole: bool = True, name: str = "enriched"
) -> DataFrame:
    """The JSON object of each message with its metadata appended, as text in ``name``.

    Added in this order: Kafka_topic, Kafka_offset, Kafka_partitionId, Kafka_CreateTime,
    Kafka_header (with ``header``) and Json, the whole message as a string (with ``whole``).
    The message's own fields keep their text. A null message gives an empty text. One that is
    not a JSON object, or has a field named like an added one, gives null with ``<name>_ok``
    false.
    """
    raw = F.col("value").cast("string")
    added = [
        F.col("topic").alias("Kafka_topic"),
        F.col("offset").alias("Kafka_offset"),
        F.col("partition").alias("Kafka_partitionId"),
        _millis().alias("Kafka_CreateTime"),
    ]
    if header:
        added.append(_text_headers(F.col("headers")).alias("Kafka_header"))
    if whole:
        added.append(raw.alias("Json"))
    # Three projections, each used more than once by the next, so none is worked out twice.
    message = F.trim(raw, F.lit(JSON_BLANKS))
    staged = df.withColumns({"_message": message, "_tail": F.to_json(F.struct(*added))})
    inner = F.substring("_message", F.lit(1), F.length("_message") - 1)
    staged = staged.withColumn("_body", F.rtrim(inner, F.lit(JSON_BLANKS)))
    names = F.array(*[F.lit(n) for n in df.select(*added).columns])
    own = F.coalesce(F.json_object_keys("_message"), F.array().cast("array<string>"))
    staged = staged.withColumn(
        "_object",
        F.startswith("_message", F.lit("{")) & is_json("_message") & ~F.arrays_overlap(own, names),
    )
    text = F.concat(
        "_body",
        F.when(F.col("_body") == "{", "").otherwise(", "),
        F.substring("_tail", F.lit(2), F.length("_tail")),
    )
    enriched = F.when(raw.isNull(), "").when(F.col("_object"), text)
    return staged.select(
        *[F.col(quoted(c)) for c in df.columns], enriched.alias(name),
        F.coalesce("_object", F.lit(True)).alias(f"{name}_ok"),
    )


def enrich_xml(
    df: DataFrame, row_tag: str, name: str = "enriched", *, header: bool = False
) -> DataFrame:
    """The XML text of each message with its metadata before the last closing ``row_tag``.

    With ``header`` an element ``Kafka_header`` holds one ``header`` element with attribute
    ``key`` per header, in their order. A null message gives an empty text; one without the tag gives null, with
    ``<name>_ok`` false.
    """
    raw = F.col("value").cast("string")
    close = f"</{row_tag}>"
    tail = F.substring_index(raw, close, -1)
    head = F.substring(raw, F.lit(1), F.length(raw) - F.length(tail) - len(close))
    pieces = []
    for tag, col in (
        ("Kafka_topic", xml_escape("topic")),
        ("Kafka_offset", F.col("offset").cast("string")),
        ("Kafka_partitionId", F.col("partition").cast("string")),
        ("Kafka_CreateTime", _millis().cast("string")),
    ):
        pieces += [F.lit(f"<{tag}>"), F.coalesce(col, F.lit("")), F.lit(f"</{tag}>")]
    if header:
        one = lambda h: F.concat(
            F.lit('<header key="'), F.replace(xml_escape(h["key"]), F.lit('"'), F.lit("&quot;")),
            F.lit('">'), F.coalesce(xml_escape(h["value"]), F.lit("")), F.lit("</header>"),
        )
        inner = F.array_join(F.transform(F.coalesce("headers", F.array()), one), "")
        pieces += [F.lit("<Kafka_header>"), inner, F.lit("</Kafka_header>")]
    text = F.concat(head, *pieces, F.lit(close), tail)
    has_tag = F.contains(raw, F.lit(close))
    return df.withColumns({
        name: F.when(raw.isNull(), "").when(has_tag, text),
        f"{name}_ok": F.coalesce(has_tag, F.lit(True)),
    })
