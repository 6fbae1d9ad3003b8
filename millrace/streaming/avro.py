"""Avro payloads of messages, by Spark's separate Avro package or else by this library's decoder."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.streaming.avro_binary import decode_avro_bytes, failing


def decode_avro(
    df: DataFrame,
    schema: str,
    col: str = "value",
    name: str = "avroData",
    *,
    star: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Decode the Avro bytes of ``col`` to the struct ``name``; with ``star`` select its fields
    beside the key. For registry-framed values pass the ``payload`` column instead.

    Where the Avro package is not on the class path, :func:`decode_avro_bytes` decodes. Of the options ``mode`` counts there: bytes
    that do not fit end the job (``FAILFAST``, the default) or give nulls (``PERMISSIVE``).
    """
    from pyspark.sql.avro.functions import from_avro

    mode = {k.lower(): v for k, v in (options or {}).items()}.get("mode", "FAILFAST").upper()
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"unknown mode {mode!r}")
    try:
        out = df.withColumn(name, from_avro(F.col(col), schema, dict(options or {})))
    except (AnalysisException, TypeError):
        out = decode_avro_bytes(df, schema, col=col, name=name, ok_col="_avro_ok")
        if mode == "FAILFAST":
            out = failing(out, "_avro_ok", "Avro bytes that do not fit their schema")
        out = out.drop("_avro_ok")
    return out.select(*(["key"] if "key" in df.columns else []), f"{name}.*") if star else out
