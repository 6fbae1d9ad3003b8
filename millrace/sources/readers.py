"""Configured batch and stream readers."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from millrace.sources.options import OptionError, check_options, profile


MAX_FILES_PER_TRIGGER = 1000


class FormatUnavailable(RuntimeError):
    """The session has no data source of this name."""


@contextmanager
def known_format(fmt: str, package: str | None = None):
    """Turn the error for a data source that is not on the class path into a readable one."""
    try:
        yield
    except Exception as err:
        # Built-in external formats and unknown names fail with different error classes.
        if re.search(r"Failed to find (the )?data source", str(err)):
            need = f"the package {package}" if package else "its connector"
            raise FormatUnavailable(f"format {fmt!r} needs {need} on the class path") from err
        raise


def _load(reader, fmt: str, path, *, package: str | None) -> DataFrame:
    with known_format(fmt, package):
        return reader.load(path) if path is not None else reader.load()


def _configured(reader, fmt: str, path, schema, settings: Mapping[str, str]):
    prof = profile(fmt)
    if prof.needs_path and not path:
        raise OptionError(f"{prof.fmt}: a path is required")
    if not prof.needs_path and path:
        raise OptionError(f"{prof.fmt}: takes no path")
    reader = reader.format(prof.fmt).options(**settings)
    return reader.schema(schema) if schema is not None else reader


def read_source(
    spark: SparkSession,
    fmt: str,
    path: str | Sequence[str] | None = None,
    schema: StructType | str | None = None,
    options: Mapping | None = None,
    **kwargs,
) -> DataFrame:
    """Batch read of ``fmt`` with checked options.

    ``options`` is for names with dots; both it and ``kwargs`` may be given. Pass ``schema``
    for large inputs: inference costs an additional pass over the text formats.
    """
    prof = profile(fmt)
    settings = check_options(fmt, {**(options or {}), **kwargs})
    reader = _configured(spark.read, fmt, path, schema, settings)
    target = list(path) if path is not None and not isinstance(path, str) else path
    return _load(reader, prof.fmt, target, package=prof.package)


def stream_source(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: StructType | str | None = None,
    options: Mapping | None = None,
    *,
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
    **kwargs,
) -> DataFrame:
    """Streaming read of ``fmt`` with checked options.

    A file stream wants a directory or a glob; a path that names one file is turned into a
    glob for that same name. ``max_files_per_trigger`` bounds a file micro-batch, as
    ``maxOffsetsPerTrigger`` bounds one of the message log; without a bound the first batch of
    a large backlog would be all of it, and that is what ``None`` asks for.
    """
    prof = profile(fmt)
    settings = check_options(fmt, {**(options or {}), **kwargs}, stream=True)
    if prof.needs_path and path and not any(c in path for c in "*?[{"):
        head, _, name = path.rstrip("/").rpartition("/")
        path = f"{head}/[{name[0]}]{name[1:]}"
    reader = _configured(spark.readStream, fmt, path, schema, settings)
    if prof.needs_path and max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _load(reader, prof.fmt, path, package=prof.package)


def kafka_options(
    servers: str,
    *,
    subscribe: str | Sequence[str] | None = None,
    assign: Mapping[str, Sequence[int]] | None = None,
    pattern: str | None = None,
    starting: str | Mapping = "earliest",
    ending: str | Mapping | None = None,
    group_id: str | None = None,
    security: Mapping[str, str] | None = None,
    **more,
) -> dict:
    """Option names and values for a message-log read, from Python values.

    Offsets are a word or ``{topic: {partition: offset}}`` with -2 for earliest and -1 for
    latest. ``security`` entries are passed through below the ``kafka.`` prefix.
    """
    topics = subscribe if subscribe is None or isinstance(subscribe, str) else ",".join(subscribe)

    def offsets(value):
        if value is None or isinstance(value, str):
            return value
        return {t: {str(p): int(o) for p, o in parts.items()} for t, parts in value.items()}

    out = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "assign": {t: list(p) for t, p in assign.items()} if assign else None,
        "subscribePattern": pattern,
        "startingOffsets": offsets(starting),
        "endingOffsets": offsets(ending),
        "kafka.group.id": group_id,
    }
    for name, value in (security or {}).items():
        out[name if name.startswith("kafka.") else f"kafka.{name}"] = value
    return {k: v for k, v in (out | more).items() if v is not None}


def read_log(spark: SparkSession, servers: str, **kwargs) -> DataFrame:
    """Batch read of a message log from a broker."""
    return read_source(spark, "kafka", options=kafka_options(servers, **kwargs))


def stream_log(spark: SparkSession, servers: str, **kwargs) -> DataFrame:
    """Streaming read of a message log from a broker."""
    return stream_source(spark, "kafka", options=kafka_options(servers, **kwargs))


def branch_frame(
    spark: SparkSession,
    condition: bool,
    when_true: Callable[[], DataFrame] | tuple,
    when_false: Callable[[], DataFrame] | tuple,
) -> DataFrame:
    """One of two sources that may differ in schema; only the chosen one is built.

    A branch is a function that returns a DataFrame, or a ``(rows, schema)`` pair.
    """
    chosen = when_true if condition else when_false
    if callable(chosen):
        return chosen()
    rows, schema = chosen
    return spark.createDataFrame(rows, schema)
