"""Messages of many schema versions in one column, decoded by the schema id in their frame."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import is_json
from millrace.sources.log import split_confluent_frame
from millrace.sources.schemas import avro_to_struct
from millrace.streaming.avro_binary import (
    NOTHING, PROMOTIONS, Decoder, Field, Node, Unresolvable, decode_column, nullable, read_schema, resolve,
)

FIELDS = "fields array<struct<name: string, type: string>>"
# The kinds of JSON numbers that a schema's types may be written as.
WHOLE = ("int", "long", "date", "timestamp-millis", "timestamp-micros", "local-timestamp-millis", "local-timestamp-micros")
NUMBERS = ("float", "double", "decimal")
TEXTS = ("string", "enum", "bytes", "uuid")


@dataclass
class Leaf:
    """A field of the reader that holds no fields itself: its path, and the names of each step."""

    path: tuple[str, ...]
    names: tuple[tuple[str, ...], ...]
    node: Node
    nullable: bool
    default: object


def _core(node: Node) -> tuple[Node, bool]:
    """A node without its null branch, and whether it had one."""
    if node.kind != "union":
        return node, node.kind == "null"
    rest = [p for p in node.parts if p.kind != "null"]
    if len(rest) != 1:
        raise ValueError("a reader's union may only add null to one type")
    return rest[0], len(rest) < len(node.parts)


def _leaves(fields: list[Field], path=(), names=(), loose=False) -> list[Leaf]:
    out = []
    for f in fields:
        node, null = _core(f.node)
        at, called = (*path, f.name), (*names, (f.name, *f.aliases))
        if node.kind == "record":
            out += _leaves(node.fields, at, called, loose or null or f.default is not NOTHING)
        else:
            out.append(Leaf(at, called, node, loose or null, f.default))
    return out


def _kind(node: Node) -> str:
    return node.logical or node.kind


def _readable(node: Node) -> list[str]:
    """Kinds of a writer's field that may be read as ``node``."""
    kind = _kind(node)
    same = {kind, "enum", "uuid", "string"} if kind in ("string", "enum") else {kind}
    return sorted(same | {w for w, r in PROMOTIONS.items() if kind in r})


def _named(name: str):
    return lambda f: f["name"] == name


def _writer_field(schema: Column, names: tuple[tuple[str, ...], ...]) -> Column:
    """``kind`` (null if absent), ``nullable`` and ``names`` of the field at a path, from a schema's text."""
    text, null, found = schema, F.lit(False), []
    kind = F.lit("record")
    for step in names:
        fields = F.from_json(text, FIELDS)["fields"]
        tried = [F.get(F.filter(fields, _named(n)), F.lit(0)) for n in step]
        field = F.coalesce(*tried)
        found.append(field["name"])
        given = F.trim(field["type"])
        branches = F.from_json(F.when(F.startswith(given, F.lit("[")), given), "array<string>")
        rest = F.filter(branches, lambda b: b != "null")
        null = null | F.coalesce(F.size(rest) < F.size(branches), F.lit(False)) | F.coalesce(given == "null", F.lit(False))
        text = F.when(branches.isNull(), given).when(F.size(rest) == 1, rest[0]).otherwise("union")
        parts = F.from_json(F.when(F.startswith(text, F.lit("{")), text), "type string, logicalType string")
        kind = F.when(parts.isNull(), text).otherwise(F.coalesce(parts["logicalType"], parts["type"]))
    return F.struct(kind.alias("kind"), F.coalesce(null, F.lit(False)).alias("nullable"), F.array(*found).alias("names"))


def _path(names: tuple[str, ...]) -> str:
    return "$" + "".join("['" + n.replace("'", "\\'") + "']" for n in names)


def _typed(value: Column, node: Node) -> Column:
    """A variant as the reader's type, or null where it is none."""
    kind, target = _kind(node), node.spark_type().simpleString()

    def get(name: str) -> Column:
        return F.try_variant_get(value, "$", name)

    if kind == "date":
        return F.date_from_unix_date(get("int"))
    if kind.endswith(("timestamp-millis", "timestamp-micros")):
        at = F.timestamp_millis(get("bigint")) if kind.endswith("millis") else F.timestamp_micros(get("bigint"))
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz")) if kind.startswith("local") else at
    if kind == "bytes":
        return F.encode(get("string"), "ISO-8859-1")
    return get(target)


def _fits(value: Column, shape: Column, kind: Column) -> Column:
    """Whether a variant of this shape is one that a writer of this kind writes."""
    small = ~kind.isin("int", "date") | F.try_variant_get(value, "$", "int").isNotNull()
    number = shape.isin("BIGINT", "DOUBLE", "FLOAT") | F.startswith(shape, F.lit("DECIMAL"))
    return (
        F.when(kind.isin(*WHOLE), (shape == "BIGINT") & small).when(kind.isin(*NUMBERS), number)
        .when(kind.isin(*TEXTS), shape == "STRING").when(kind == "boolean", shape == "BOOLEAN")
        .when(kind == "array", F.startswith(shape, F.lit("ARRAY"))).when(kind == "map", F.startswith(shape, F.lit("OBJECT")))
        .otherwise(F.lit(False))
    )


def _at(leaf: Leaf, i: int, steps: int) -> Column:
    """The message's variant at the first steps of a leaf's path, under the names its writer's schema has for them."""
    names = F.slice(F.col(f"_w{i}")["names"], 1, steps)
    out = None
    for called in _product(leaf.names[:steps]):
        used = names == F.array(*[F.lit(n) for n in called])
        value = F.try_variant_get("_doc", _path(called), "variant")
        out = F.when(used, value) if out is None else out.when(used, value)
    return out


def _decode_json(rows: DataFrame, reader: Node, name: str) -> DataFrame:
    """Each step is a projection of its own, so that no value is taken from the document twice."""
    leaves = _leaves(reader.fields)
    kept = [c for c in rows.columns if not c.startswith("_w") and c not in ("_schema", "_frame")]
    text = F.col("payload").cast("string")
    rows = rows.withColumn("_doc", F.when(is_json(text) & F.startswith(F.ltrim(text), F.lit("{")), F.try_parse_json(text)))
    records = {leaf.path[:n]: (i, leaf, n) for i, leaf in reversed([*enumerate(leaves)]) for n in range(1, len(leaf.path))}
    there = {path: f"_r{k}" for k, path in enumerate(records)}
    rows = rows.withColumns({
        **{f"_v{i}": _at(leaf, i, len(leaf.path)) for i, leaf in enumerate(leaves)},
        **{there[path]: _at(leaf, i, n) for path, (i, leaf, n) in records.items()},
    })
    rows = rows.withColumns({f"_s{i}": F.schema_of_variant(f"_v{i}") for i in range(len(leaves))})
    rows = rows.withColumns({f"_t{i}": _typed(F.col(f"_v{i}"), leaf.node) for i, leaf in enumerate(leaves)})
    values, troubles = {}, []
    for i, leaf in enumerate(leaves):
        writer, value, shape, typed = (F.col(f"_{c}{i}") for c in "wvst")
        written = ~F.exists(writer["names"], F.isnull)
        absent = value.isNull() | (shape == "VOID")
        fits = _fits(value, shape, writer["kind"]) & typed.isNotNull()
        kind = leaf.node.spark_type()
        default = F.lit(None if leaf.default is NOTHING else leaf.default).cast(kind)
        values[leaf.path] = F.when(written, F.when(~absent, typed)).otherwise(default)
        good = writer["kind"].isin(*_readable(leaf.node)) & F.when(absent, writer["nullable"] & F.lit(leaf.nullable)).otherwise(fits)
        good = F.when(written, good).otherwise(F.lit(leaf.nullable or leaf.default is not NOTHING))
        troubles.append(F.when(~F.coalesce(good, F.lit(False)), F.lit("field " + ".".join(leaf.path))))
    problem = (
        F.when(F.col("_frame").isNotNull(), F.col("_frame")).when(F.col("payload").isNull(), F.lit(None))
        .when(F.col("_doc").isNull(), F.lit("json")).otherwise(F.coalesce(*troubles, F.lit(None).cast("string")))
    )
    rows = rows.withColumn("problem", problem)
    data = _struct(reader.fields, values, there)
    good = F.col("problem").isNull() & F.col("_doc").isNotNull()
    return rows.select(*kept, F.when(good, data).alias(name), "problem")


def _product(names: tuple[tuple[str, ...], ...]) -> list[tuple[str, ...]]:
    return reduce(lambda done, step: [(*d, n) for d in done for n in step], names, [()])


def _struct(fields: list[Field], values: dict, there: dict, path: tuple[str, ...] = ()) -> Column:
    out = []
    for f in fields:
        at = (*path, f.name)
        node, _ = _core(f.node)
        if node.kind == "record":
            record = F.col(there[at])
            inner = _struct(node.fields, values, there, at)
            out.append(F.when(record.isNotNull() & ~F.is_variant_null(record), inner).alias(f.name))
        else:
            out.append(values[at].alias(f.name))
    return F.struct(*out)


def _decode_avro(rows: DataFrame, reader: Node, reader_text: str, name: str) -> DataFrame:
    kept = [c for c in rows.columns if c not in ("_schema", "_frame")]
    schema = T.StructType([
        *(rows.schema[c] for c in kept), T.StructField(name, avro_to_struct(reader_text)), T.StructField("problem", T.StringType()),
    ])
    frame, text, payload = (rows.columns.index(c) for c in ("_frame", "_schema", "payload"))
    places = [rows.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoders: dict[str | None, Decoder | None] = {None: None}
        empty = resolve(reader, reader)
        for batch in batches:
            groups = batch.column(text).dictionary_encode()
            of = groups.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            problem = np.array(batch.column(frame).to_pylist(), dtype=object)
            parts, order = [], []
            for i, writer in [(-1, None), *enumerate(groups.dictionary.to_pylist())]:
                mine = np.flatnonzero(of == i)
                if not len(mine):
                    continue
                if writer not in decoders:
                    try:
                        decoders[writer] = resolve(read_schema(writer), reader)
                    except (Unresolvable, ValueError, KeyError, TypeError):
                        decoders[writer] = None
                column = batch.column(payload).take(pa.array(mine))
                if decoders[writer] is None:
                    late = np.array([problem[k] is None and writer is not None for k in mine], bool)
                    problem[mine[late]] = "schema"
                    found, _ = decode_column(pa.nulls(len(mine), pa.binary()), empty)
                else:
                    found, ok = decode_column(column, decoders[writer])
                    problem[mine[~ok]] = "avro"
                parts.append(found)
                order.append(mine)
            if not parts:
                continue
            back = np.argsort(np.concatenate(order), kind="stable")
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in places), pa.concat_arrays(parts).take(pa.array(back)), pa.array(problem, pa.string())],
                names=[*kept, name, "problem"],
            )

    return rows.mapInArrow(run, nullable(schema))


def decode_by_schema_id(
    df: DataFrame, registry: DataFrame, reader: str, *, col: str = "value", payload: str = "json", name: str = "data",
) -> DataFrame:
    """Framed messages of any number of schema versions as one struct ``name`` of the reader's schema.

    ``registry`` has the Avro schema text (``schema``) of each ``schema_id``; ``reader`` is an Avro record's text.
    Adds ``schema_id``, ``payload``, ``name`` and ``problem``, which is null for good rows: ``frame`` (no registry frame),
    ``schema`` (the id is not in the registry, or its schema cannot be read as the reader's), ``json`` or ``avro`` (the payload is
    none), ``field x`` (the value of ``x`` is not what its writer's type says, or is absent where that has no null). A
    null value has neither data nor problem. Bad rows are those with a problem; no row is lost.

    JSON payloads are parsed once, to a variant; fields are taken from it by path and checked against the type
    that the row's own schema gives, which is worked out once per registry row, not per message. Avro payloads are decoded by batch
    and schema, with resolution to the reader. Either way, messages of all versions go in one pass, and the
    registry is joined by id: no schema is looked up on the driver.
    """
    tree = read_schema(reader)
    if tree.kind != "record":
        raise ValueError("the reader's schema is not a record")
    if payload not in ("json", "avro"):
        raise ValueError(f"unknown payload {payload!r}")
    taken = [c for c in (name, "schema_id", "payload", "problem") if c in df.columns]
    if taken:
        raise ValueError(f"columns are there already: {', '.join(taken)}")
    rows = split_confluent_frame(df, col)
    known = registry.groupBy(F.col("schema_id").cast("bigint").alias("schema_id")).agg(F.max("schema").alias("_schema"))
    if payload == "json":
        written = [_writer_field(F.col("_schema"), leaf.names).alias(f"_w{i}") for i, leaf in enumerate(_leaves(tree.fields))]
        known = known.select("schema_id", F.lit("known").alias("_schema"), *written)
    rows = rows.join(known, "schema_id", "left").select(*df.columns, "schema_id", "payload", *known.columns[1:])
    frame = F.when(F.col(col).isNotNull() & F.col("schema_id").isNull(), "frame").when(
        F.col("schema_id").isNotNull() & F.col("_schema").isNull(), "schema"
    )
    rows = rows.withColumn("_frame", frame)
    return _decode_json(rows, tree, name) if payload == "json" else _decode_avro(rows, tree, reader, name)
