"""Schemas from text, from files, from a registry table, and from the data itself."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Avro primitive names, and logical types by (type, logicalType).
AVRO_PRIMITIVES = {
    "null": T.NullType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}
AVRO_LOGICAL = {
    ("int", "date"): T.DateType(),
    ("long", "timestamp-millis"): T.TimestampType(),
    ("long", "timestamp-micros"): T.TimestampType(),
    ("long", "local-timestamp-millis"): T.TimestampNTZType(),
    ("long", "local-timestamp-micros"): T.TimestampNTZType(),
}


def _full_name(name: str, space: str) -> str:
    return name if "." in name or not space else f"{space}.{name}"


def _avro_type(node, named: dict, space: str = "") -> tuple[T.DataType, bool]:
    """Spark type and nullability of one Avro schema node.

    ``named`` holds the types by full name; ``space`` is the enclosing namespace.
    """
    if isinstance(node, list):
        rest = [n for n in node if n != "null"]
        nullable = len(rest) < len(node)
        if len(rest) == 1:
            return _avro_type(rest[0], named, space)[0], nullable
        if set(map(str, rest)) == {"int", "long"}:
            return T.LongType(), nullable
        if set(map(str, rest)) == {"float", "double"}:
            return T.DoubleType(), nullable
        members = [
            T.StructField(f"member{i}", _avro_type(n, named, space)[0], True)
            for i, n in enumerate(rest)
        ]
        return T.StructType(members), nullable
    if isinstance(node, str):
        if node in AVRO_PRIMITIVES:
            return AVRO_PRIMITIVES[node], node == "null"
        for name in (_full_name(node, space), node):
            if name in named:
                return named[name], False
        raise ValueError(f"unknown Avro type {node!r}")
    kind = node["type"]
    if isinstance(kind, (dict, list)):
        return _avro_type(kind, named, space)
    full = _full_name(node.get("name", ""), node.get("namespace", space))
    inner = full.rpartition(".")[0] or space
    if kind == "record":
        fields = []
        for f in node["fields"]:
            dtype, nullable = _avro_type(f["type"], named, inner)
            fields.append(T.StructField(f["name"], dtype, nullable))
        named[full] = T.StructType(fields)
        return named[full], False
    if kind == "array":
        dtype, nullable = _avro_type(node["items"], named, space)
        return T.ArrayType(dtype, nullable), False
    if kind == "map":
        dtype, nullable = _avro_type(node["values"], named, space)
        return T.MapType(T.StringType(), dtype, nullable), False
    logical = node.get("logicalType")
    if kind in ("bytes", "fixed") and logical == "decimal":
        dtype = T.DecimalType(int(node["precision"]), int(node.get("scale", 0)))
        if kind == "fixed":
            named[full] = dtype
        return dtype, False
    if kind in ("enum", "fixed"):
        dtype = T.StringType() if kind == "enum" else T.BinaryType()
        named[full] = dtype
        return dtype, False
    if (kind, logical) in AVRO_LOGICAL:
        return AVRO_LOGICAL[kind, logical], False
    return _avro_type(kind, named, space)


def avro_to_struct(text: str) -> T.StructType:
    """The ``StructType`` for an Avro record schema given as JSON text."""
    dtype, _ = _avro_type(json.loads(text), {})
    if not isinstance(dtype, T.StructType):
        raise ValueError("the Avro schema is not a record")
    return dtype


def avro_decimal_fields(text: str) -> dict[str, tuple[int, int]]:
    """``{field: (precision, scale)}`` of the top-level decimal fields, null unions included."""
    return {
        f.name: (f.dataType.precision, f.dataType.scale)
        for f in avro_to_struct(text).fields
        if isinstance(f.dataType, T.DecimalType)
    }


def parse_schema(text: str) -> T.StructType:
    """A ``StructType`` from Spark's schema JSON, an Avro record, or DDL text."""
    text = text.strip()
    if not text.startswith("{"):
        return T.StructType.fromDDL(text)
    node = json.loads(text)
    if node.get("type") == "struct":
        return T.StructType.fromJson(node)
    return avro_to_struct(text)


def schema_from_file(spark: SparkSession, path: str) -> T.StructType:
    """:func:`parse_schema` of one small file; the file holds nothing but the schema."""
    return parse_schema(spark.read.text(path, wholetext=True).first()[0])


def latest_schemas(
    registry: DataFrame,
    topics: DataFrame | None = None,
    *,
    topic_col: str = "topic",
    suffix: str = "-value",
) -> DataFrame:
    """Newest schema text per subject of a ``(subject, version, schema)`` table.

    The reduction is a partial aggregate per task, so a subject with very many versions costs
    no more than others. Carrying the text makes it a sort-based one, but it sorts within a
    task's split; looking the text up by a join would shuffle the whole registry instead. With ``topics`` the result has one row per distinct topic that is
    registered under ``topic + suffix``.
    """
    newest = registry.groupBy("subject").agg(
        F.max("version").alias("version"), F.max_by("schema", "version").alias("schema")
    )
    if topics is None:
        return newest
    wanted = (
        topics.select(topic_col)
        .distinct()
        .withColumn("subject", F.concat(F.col(topic_col), F.lit(suffix)))
    )
    return wanted.join(newest, "subject").select(topic_col, "subject", "version", "schema")


def variant_ddl(text: str) -> str:
    """Schema text of a variant aggregate as type text that ``from_json`` takes."""
    names = {"OBJECT": "STRUCT", "VOID": "STRING", "VARIANT": "STRING"}
    # Quoted names and words before a colon are field names, which stay.
    word = r"`(?:[^`]|``)*`|\b(?:OBJECT(?=<)|(?:VOID|VARIANT)\b(?!\s*:))"
    return re.sub(word, lambda m: names.get(m[0], m[0]), text)


def infer_json_schema(df: DataFrame, col: str) -> str:
    """Type text that covers every JSON value of ``col``.

    One distributed aggregate over all rows; the driver gets a single text. Texts that are
    not JSON are passed over, and kinds that disagree become strings.
    """
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(col)))).first()[0]
    if not found.startswith(("OBJECT<", "ARRAY<")):
        raise ValueError(f"the texts of {col} have no common structure: {found}")
    return variant_ddl(found)
