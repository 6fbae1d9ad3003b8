"""Selection on a message log: a DataFrame of the columns the Kafka source gives.

``key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp,
timestampType int`` (and ``headers`` when asked for). The selections are plain predicates, so
on a stored log they reach the file scan and skip row groups.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The offset words of the log protocol, and their numbers.
LATEST, EARLIEST = -1, -2
BOUNDS = "array<struct<b_topic: string, b_partition: int, b_from: bigint, b_until: bigint>>"


def select_topics(
    df: DataFrame,
    subscribe: str | Sequence[str] | None = None,
    assign: Mapping[str, Sequence[int]] | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Rows of the subscribed topics, the assigned topic-partitions, or the topics whose whole
    name matches ``pattern``. Exactly one of the three is given."""
    if sum(x is not None for x in (subscribe, assign, pattern)) != 1:
        raise ValueError("give exactly one of subscribe, assign, pattern")
    if subscribe is not None:
        names = subscribe.split(",") if isinstance(subscribe, str) else subscribe
        return df.where(F.col("topic").isin([n.strip() for n in names]))
    if assign is not None:
        if not assign:
            raise ValueError("assign names no topic")
        wanted = [
            (F.col("topic") == t) & F.col("partition").isin([int(p) for p in parts])
            for t, parts in assign.items()
        ]
        return df.where(reduce(or_, wanted))
    return df.where(F.col("topic").rlike(f"^(?:{pattern})$"))


def _bounds(value, *, word: int, banned: int, what: str) -> dict | None:
    """``{(topic, partition): offset}`` of one side, or ``None`` for the open word."""
    names = {"earliest": EARLIEST, "latest": LATEST}
    if isinstance(value, str):
        number = names.get(value.strip().lower())
        if number != word:
            raise ValueError(f"{what} offsets cannot be {value!r} in a batch read")
        return None
    out = {
        (t, int(p)): int(o) for t, parts in value.items() for p, o in parts.items()
    }
    for where, offset in out.items():
        if offset == banned or offset < EARLIEST:
            raise ValueError(f"{what} offset {offset} of {where} is not allowed")
    return out


def select_offsets(
    df: DataFrame,
    starting: str | Mapping[str, Mapping] = "earliest",
    ending: str | Mapping[str, Mapping] = "latest",
) -> DataFrame:
    """Rows with ``from <= offset < until`` per topic-partition.

    A side is its open word or ``{topic: {partition: offset}}`` with -2 for earliest and -1
    for latest. Topic-partitions that a mapping leaves out are not read; two mappings must name
    the same ones. The bounds are one text in the plan, joined as a table, and what they imply
    for topic, partition and offset is a plain filter, which reaches a file scan.
    """
    start = _bounds(starting, word=EARLIEST, banned=LATEST, what="starting")
    until = _bounds(ending, word=LATEST, banned=EARLIEST, what="ending")
    if start is None and until is None:
        return df
    if start is not None and until is not None and start.keys() != until.keys():
        raise ValueError("starting and ending offsets name different topic-partitions")
    keys = (start if start is not None else until).keys()
    ranges = [
        (t, p, (start or {}).get((t, p), EARLIEST), (until or {}).get((t, p), LATEST))
        for t, p in keys
    ]
    if not ranges:
        return df.where(F.lit(False))
    # Implied by the ranges, and simple enough for a file scan to skip row groups by.
    df = df.where(F.col("topic").isin(sorted({r[0] for r in ranges})))
    df = df.where(F.col("partition").isin(sorted({r[1] for r in ranges})))
    low, high = min(r[2] for r in ranges), [r[3] for r in ranges]
    if low != EARLIEST:
        df = df.where(F.col("offset") >= low)
    if LATEST not in high:
        df = df.where(F.col("offset") < max(high))
    # A join without hint: the optimizer ships the bounds while they are small.
    text = json.dumps([dict(zip(("b_topic", "b_partition", "b_from", "b_until"), r, strict=True)) for r in ranges])
    bounds = df.sparkSession.range(1).select(F.inline(F.from_json(F.lit(text), BOUNDS)))
    inside = (
        (F.col("topic") == F.col("b_topic"))
        & (F.col("partition") == F.col("b_partition"))
        & ((F.col("b_from") == EARLIEST) | (F.col("offset") >= F.col("b_from")))
        & ((F.col("b_until") == LATEST) | (F.col("offset") < F.col("b_until")))
    )
    return df.join(bounds, inside, "left_semi")


def select_ranges(
    df: DataFrame, ranges: DataFrame, *, width: int = 4096, keep: Sequence[str] = (),
) -> DataFrame:
    """Rows that lie in a range of a table: ``topic``, ``partition``, ``from_offset``, ``until_offset``.

    Any number of ranges per topic-partition may be given, also overlapping ones; a null bound is an open one. A row
    comes once, however many ranges it lies in; with ``keep`` it comes once per range, with these columns of the range.

    Ranges are cut at multiples of ``width`` offsets and joined by topic, partition and piece; the exact bounds are
    checked within that. So a row meets only the ranges of its own stretch of offsets, and a hot partition is many
    join keys. Open ranges are closed by the bounds of what the log holds, which is one partial aggregate.
    """
    held = offset_ledger(df).select(
        F.col("topic").alias("b_topic"), F.col("partition").alias("b_partition"), F.col("from_offset").alias("_low"),
        F.col("until_offset").alias("_high"),
    )
    bounds = ranges.select(
        F.col("topic").alias("b_topic"), F.col("partition").alias("b_partition"), F.col("from_offset").alias("_from"),
        F.col("until_offset").alias("_until"), *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)],
    ).join(held, ["b_topic", "b_partition"])
    low = F.greatest(F.coalesce("_from", "_low"), F.col("_low"))
    high = F.least(F.coalesce("_until", "_high"), F.col("_high"))
    bounds = bounds.withColumns({"_from": low, "_until": high}).where("_from < _until")
    pieces = F.sequence(F.floor(F.col("_from") / width), F.floor((F.col("_until") - 1) / width))
    bounds = bounds.drop("_low", "_high").withColumn("_piece", F.explode(pieces))
    rows = df.withColumn("_at", F.floor(F.col("offset") / width))
    inside = (
        (F.col("topic") == F.col("b_topic")) & (F.col("partition") == F.col("b_partition")) & (F.col("_at") == F.col("_piece"))
        & (F.col("offset") >= F.col("_from")) & (F.col("offset") < F.col("_until"))
    )
    own = [F.col(c) for c in df.columns]
    if not keep:
        return rows.join(bounds, inside, "left_semi").select(*own)
    return rows.join(bounds, inside).select(*own, *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)])


def replay_log(
    spark: SparkSession,
    path: str,
    *,
    subscribe: str | Sequence[str] | None = None,
    assign: Mapping[str, Sequence[int]] | None = None,
    pattern: str | None = None,
    starting: str | Mapping[str, Mapping] = "earliest",
    ending: str | Mapping[str, Mapping] = "latest",
) -> DataFrame:
    """Batch read of a log stored as Parquet, selected as a read from a broker would be."""
    log = select_topics(spark.read.parquet(path), subscribe, assign, pattern)
    return select_offsets(log, starting, ending)


def read_messages(df: DataFrame, payload_format: str | Column) -> DataFrame:
    """Tag each message by payload format: ``avro`` in any case, everything else is text.

    Avro payloads stay bytes in ``value_raw``; text is in ``value_string``. ``payload_format``
    is one word for the whole log or a column that holds it per row.
    """
    word = F.lit(payload_format) if isinstance(payload_format, str) else payload_format
    is_avro = F.coalesce(F.lower(F.trim(word)) == "avro", F.lit(False))
    done = ("key", "value")
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.when(is_avro, F.col("value")).alias("value_raw"),
        F.when(~is_avro, F.col("value").cast("string")).alias("value_string"),
        F.when(is_avro, "avro").otherwise("string").alias("format"),
        *[c for c in df.columns if c not in done],
    )


def split_confluent_frame(df: DataFrame, col: str = "value") -> DataFrame:
    """Registry frame (magic byte 0, four bytes of schema id, payload) as ``schema_id`` and
    ``payload``; both are null for a value without that head."""
    value = F.col(col)
    framed = (F.length(value) >= 5) & (F.substring(value, 1, 1) == F.lit(b"\x00"))
    schema_id = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")
    payload = F.substring(value, F.lit(6), F.length(value))
    return df.withColumns(
        {"schema_id": F.when(framed, schema_id), "payload": F.when(framed, payload)}
    )


def offset_ledger(df: DataFrame) -> DataFrame:
    """``from_offset`` and ``until_offset`` (the next one to read) per topic-partition."""
    return df.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"),
        (F.max("offset") + 1).alias("until_offset"),
    )


PIECE = 12  # a piece holds two to this power offsets, a stretch as many pieces


def offset_gaps(df: DataFrame, since: DataFrame | None = None) -> DataFrame:
    """Offsets that a log lacks, as ``topic, partition, from_offset, until_offset, missing``.

    A gap lies between two offsets that are there; with ``since`` (``topic``, ``partition``, ``until_offset``: where an
    earlier read has ended, as in :func:`offset_ledger`) also between that end and the first offset after it, and offsets before it do not count. Repeated
    offsets do no harm.

    Offsets are brought together by pieces of ``2 ** PIECE``, whose gaps are found in the piece; pieces by stretches of as many, with
    the gaps between pieces; and stretches by topic-partition. So no task sorts or holds a partition of the log: what is
    put together is of bounded size at the first two levels and shrinks by its square before the last.
    """
    rows = df.select("topic", "partition", "offset")
    if since is not None:
        ends = since.select("topic", "partition", F.col("until_offset").alias("_end"))
        rows = rows.join(ends, ["topic", "partition"], "left").where("_end is null or offset >= _end").drop("_end")
        rows = rows.unionAll(since.select("topic", "partition", F.col("until_offset") - 1))
    spans = rows.select("topic", "partition", F.col("offset").alias("first"), F.col("offset").alias("last"))
    gaps = []
    for shift in (PIECE, 2 * PIECE, None):
        place = F.lit(0).cast("long") if shift is None else F.shiftright("first", shift)
        held = F.collect_set if shift == PIECE else F.collect_list
        grouped = spans.groupBy("topic", "partition", place.alias("_place")).agg(
            F.array_sort(held(F.struct("first", "last"))).alias("spans")
        )
        spans = grouped.select("topic", "partition", F.col("spans")[0]["first"].alias("first"), F.get("spans", F.size("spans") - 1)["last"].alias("last"))
        pairs = F.arrays_zip(F.slice("spans", 1, F.size("spans") - 1).alias("a"), F.slice("spans", 2, F.size("spans")).alias("b"))
        found = F.filter(
            F.transform(pairs, lambda p: F.struct((p["a"]["last"] + 1).alias("from_offset"), p["b"]["first"].alias("until_offset"))),
            lambda g: g["from_offset"] < g["until_offset"],
        )
        gaps.append(grouped.select("topic", "partition", F.inline(found)))
    return reduce(DataFrame.unionAll, gaps).withColumn("missing", F.col("until_offset") - F.col("from_offset"))


def repeated_offsets(df: DataFrame) -> DataFrame:
    """Offsets that stand more than once in a topic-partition, with their number of rows as ``copies``."""
    return df.groupBy("topic", "partition", "offset").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def fail_on_data_loss(df: DataFrame, since: DataFrame | None = None) -> DataFrame:
    """``df``; a job over it ends with an error if the log lacks offsets (:func:`offset_gaps`)."""
    lost = offset_gaps(df, since).agg(F.coalesce(F.sum("missing"), F.lit(0)).alias("n")).scalar()
    stop = F.raise_error(F.concat(F.lit("the log lacks offsets: "), lost.cast("string"))).cast("boolean")
    return df.where(F.when(lost == 0, F.lit(True)).otherwise(stop))
