"""Streams: append sinks with checkpoint, and the split of good and bad messages."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.shapes import quoted
from millrace.sources.files import list_files
from millrace.sources.log import offset_ledger
from millrace.sources.readers import known_format
from millrace.streaming.messages import (
    CORRUPT,
    ENVELOPE,
    bad_messages,
    good_messages,
    kafka_envelope,
    parse_messages,
)

BATCH, ATTEMPT = "batch_id", "attempt"
# The error conditions of tables that are not there.
ABSENT = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")
MANIFEST = T.StructType([
    T.StructField("sink", T.StringType()),
    T.StructField(ATTEMPT, T.StringType()),
    T.StructField("files", T.ArrayType(T.StructType([
        T.StructField("full_path", T.StringType()), T.StructField("size", T.LongType()),
    ]))),
])


def start_sink(
    stream: DataFrame,
    fmt: str,
    checkpoint: str,
    *,
    path: str | None = None,
    options: dict | None = None,
    available_now: bool = False,
    interval: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start an append sink: ``console``, ``kafka``, ``delta``, ``parquet`` or another format.

    ``available_now`` takes what is there, in batches of the source's limit, and ends.
    ``jdbc`` has no streaming sink of its own and is written batch by batch, each row with its
    batch number in the column ``batch_id``. Before a batch is appended the table is asked for
    its number, and a batch that is there already is passed over, so a replay writes no row
    twice. (A batch that was cut off half-way, where the database does not write it in one
    transaction, has to be removed by its number first.)
    """
    settings = {k: str(v) for k, v in (options or {}).items()}
    if path:
        settings["path"] = path
    if fmt == "jdbc":
        writer = stream.writeStream.foreachBatch(jdbc_writer(settings))
    else:
        writer = stream.writeStream.format(fmt).options(**settings)
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    with known_format(fmt):
        return writer.start()


def jdbc_writer(
    settings: dict[str, str], fmt: str = "jdbc"
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends each batch to a table once.

    A table that is not there is made by the first batch where the format says that it is absent; by JDBC an absent table cannot be told
    from one that cannot be reached, so there it has to be made before, with a column for the batch number.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        from pyspark.errors import AnalysisException

        there = None
        try:
            there = batch.sparkSession.read.format(fmt).options(**settings).load()
        except AnalysisException as err:
            if err.getCondition() not in ABSENT:
                raise
        if there is not None:
            if BATCH not in there.columns:
                raise ValueError(f"the table has no column {BATCH}")
            if not there.where(F.col(BATCH) == batch_id).isEmpty():
                return
        numbered = batch.withColumn(BATCH, F.lit(batch_id).cast("long"))
        numbered.write.format(fmt).options(**settings).mode("append").save()

    return write


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an ``available_now`` query; its failure is raised here."""
    query.awaitTermination()


def overwrite_batch(df: DataFrame, path: str, batch: int, fmt: str = "parquet") -> None:
    """Write a micro-batch to its own folder, so that a repeated batch replaces itself."""
    df.write.mode("overwrite").format(fmt).save(f"{path}/{BATCH}={batch}")


def write_attempt(df: DataFrame, path: str, batch: int, attempt: str) -> None:
    """Write one attempt at a micro-batch to a folder that no other attempt writes to."""
    df.write.parquet(f"{path}/{BATCH}={batch}/{ATTEMPT}={attempt}")


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def is_committed(spark: SparkSession, commits: str, batch: int) -> bool:
    """Whether a batch has its manifest. One whose writing was cut short is none."""
    return not _read_or_empty(spark, f"{commits}/{BATCH}={batch}", MANIFEST).isEmpty()


def commit_batch(spark: SparkSession, commits: str, batch: int, attempt: str, sinks: Mapping[str, str]) -> None:
    """Write the manifest of a batch, the last thing to be written: the files of each of its sinks.

    It is one file, so it is there as a whole or not at all.
    """
    rows = []
    for sink, path in sinks.items():
        files = list_files(spark, f"{path}/{BATCH}={batch}/{ATTEMPT}={attempt}", recursive=False)
        named = F.collect_list(F.struct("full_path", "size")).alias("files")
        rows.append(files.agg(named).select(F.lit(sink).alias("sink"), F.lit(attempt).alias(ATTEMPT), "files"))
    manifest = reduce(DataFrame.unionAll, rows).coalesce(1)
    manifest.write.mode("overwrite").parquet(f"{commits}/{BATCH}={batch}")


def read_manifests(spark: SparkSession, commits: str) -> DataFrame:
    """``sink``, ``attempt``, ``files`` and ``batch_id`` of all committed batches."""
    return _read_or_empty(spark, commits, T.StructType([*MANIFEST.fields, T.StructField(BATCH, T.LongType())]))


def read_committed(spark: SparkSession, path: str, commits: str, sink: str, schema: T.StructType) -> DataFrame:
    """What the committed batches have written to a sink; all sinks of a batch appear together.

    Batches under way, failed ones and earlier attempts are not read: batch and attempt are partition columns, joined to the manifests.
    """
    done = read_manifests(spark, commits).where(F.col("sink") == sink).select(BATCH, ATTEMPT).distinct()
    where = [T.StructField(BATCH, T.LongType()), T.StructField(ATTEMPT, T.StringType())]
    rows = _read_or_empty(spark, path, T.StructType([*schema.fields, *where]))
    return rows.join(done, [BATCH, ATTEMPT], "left_semi").select(*[F.col(quoted(n)) for n in schema.fieldNames()])


def split_writer(
    schema: T.StructType,
    good_path: str,
    bad_path: str | None,
    *,
    consumer_group: str,
    region: str,
    load_whole: bool = False,
    required: tuple[str, ...] = (),
    ledger_path: str | None = None,
    commit_path: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: good messages, bad messages, offsets read.

    The batch is parsed once, kept over the writes in memory and on disk, and let go. Each
    write replaces the batch's own folder, so a replay after a failure leaves no duplicates.

    With ``commit_path`` the outputs of a batch appear together: each attempt writes to folders of its own and a
    manifest of their files is written last; :func:`read_committed` reads only what manifests name (sinks ``good``, ``bad`` and
    ``ledger``). A batch that has its manifest is not written again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if commit_path and is_committed(spark, commit_path, batch_id):
            return
        parsed = parse_messages(kafka_envelope(batch), schema, required=required)
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        attempt = f"a-{uuid.uuid4().hex}"
        sinks: dict[str, str] = {}

        def put(sink: str, df: DataFrame, path: str | None) -> None:
            if not path:
                return
            if commit_path:
                write_attempt(df, path, batch_id, attempt)
            else:
                overwrite_batch(df, path, batch_id)
            sinks[sink] = path

        try:
            put("good", good_messages(
                parsed, schema, consumer_group=consumer_group, region=region, load_whole=load_whole,
            ), good_path)
            put("bad", bad_messages(parsed), bad_path)
            read = parsed.select(
                F.col("Kafka_topic").alias("topic"),
                F.col("Kafka_partitionId").alias("partition"),
                F.col("Kafka_offset").alias("offset"),
            )
            put("ledger", offset_ledger(read), ledger_path)
            if commit_path:
                commit_batch(spark, commit_path, batch_id, attempt, sinks)
        finally:
            parsed.unpersist()

    return write


def start_split(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    available_now: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Start a stream of message-log rows into a :func:`split_writer`."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def read_batches(spark, path: str, schema: T.StructType | None = None) -> DataFrame:
    """What :func:`overwrite_batch` has written, without the batch number.

    With ``schema`` a sink that has seen no batch yet is an empty frame of it.
    """
    if schema is None:
        return spark.read.parquet(path).drop(BATCH)
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path).drop(BATCH)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def split_schemas(
    schema: T.StructType, *, load_whole: bool = False
) -> tuple[T.StructType, T.StructType]:
    """The columns that a :func:`split_writer` gives its good and its bad sink."""
    envelope = [T.StructField(f.name, f.dataType) for f in ENVELOPE.fields]
    kept = [f for f in envelope if f.name != "value" or load_whole]
    text = T.StringType()
    good = [T.StructField(f.name, f.dataType) for f in schema.fields] + kept
    good += [T.StructField("consumerGroupId", text), T.StructField("data_center_region", text)]
    return T.StructType(good), T.StructType([*envelope, T.StructField(CORRUPT, text)])
