"""Batch sinks: CSV, warehouse table, and writes whose row count is verified."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from millrace.operators.shapes import flatten
from millrace.sources.readers import known_format


class CountMismatch(RuntimeError):
    """The target holds another number of rows than were written."""


def write_csv(df: DataFrame, path: str, *, sep: str = "_", **options) -> None:
    """Overwrite ``path`` with CSV files with header; structs are flattened first."""
    writer = flatten(df, sep).write.mode("overwrite").option("header", True)
    writer.options(**options).csv(path)


# What both sides of a counted CSV write use: nulls and line breaks within values have to be
# told from empty lines and ends of rows.
CSV_BOTH = {"nullValue": "\\N", "multiLine": "true", "escape": '"'}


def write_table(df: DataFrame, target: str, fmt: str = "parquet", **options) -> None:
    """Overwrite a target: a path of a file format, a catalog table (``table``), or a warehouse
    table (``bigquery``)."""
    writer = df.write.mode("overwrite").options(**options)
    with known_format(fmt):
        if fmt == "table":
            writer.saveAsTable(target)
        elif fmt == "bigquery":
            writer.format(fmt).option("table", target).save()
        else:
            writer.format(fmt).save(target)


def _read_back(df: DataFrame, target: str, fmt: str, options: dict) -> DataFrame:
    if fmt == "table":
        return df.sparkSession.table(target)
    reader = df.sparkSession.read.format(fmt).options(**options)
    if fmt in ("csv", "json", "xml"):
        reader = reader.schema(df.schema)
    return reader.load(target)


def staging_name(prefix: str = "temp_table") -> str:
    """``prefix`` + epoch seconds + a UUID without dashes: a name nobody else uses."""
    return f"{prefix}_{int(time.time())}_{uuid.uuid4().hex}"


@dataclass(frozen=True)
class VerifiedWrite:
    """A write whose two counts agree."""

    target: str
    source_rows: int
    target_rows: int


def verified_write(
    df: DataFrame,
    root: str,
    *,
    prefix: str = "temp_table",
    fmt: str = "parquet",
    **options,
) -> VerifiedWrite:
    """Write to a fresh staging name below ``root`` and compare the counts.

    ``root`` is a folder, or the database or dataset for tables. The source rows are counted
    while they are written, so the lineage runs once and a source that is not deterministic is
    counted as written. A difference raises. CSV is written and read with :data:`CSV_BOTH`
    unless ``options`` say otherwise.
    """
    if fmt == "csv":
        options = CSV_BOTH | options
    sep = "." if fmt in ("table", "bigquery") else "/"
    target = f"{root.rstrip(sep)}{sep}{staging_name(prefix)}"
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), target, fmt, **options)
    source = int(seen.get["rows"])
    found = _read_back(df, target, fmt, options).count()
    if source != found:
        raise CountMismatch(f"{target}: wrote {source} rows, found {found}")
    return VerifiedWrite(target, source, found)
