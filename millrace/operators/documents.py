"""Document pipelines, as a document store takes them, as filters and projections over stored documents.

A stage is a plain ``where`` or ``select``, so conditions on stored fields reach the file scan and only the
fields that are asked for are read.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.shapes import quoted

COMPARE = {
    "$gt": lambda c, v: c > v, "$gte": lambda c, v: c >= v, "$lt": lambda c, v: c < v, "$lte": lambda c, v: c <= v,
}
TESTS = ("$eq", "$ne", "$in", "$nin", "$exists", "$not", "$regex", "$size", *COMPARE)


class PipelineError(ValueError):
    """A pipeline that is not understood."""


def _field(schema: T.StructType, path: str) -> tuple[Column | None, T.DataType | None]:
    """The column of a dotted path and its type; none where no stored document has it."""
    kind: T.DataType = schema
    for step in path.split("."):
        if not isinstance(kind, T.StructType) or step not in kind.fieldNames():
            return None, None
        kind = kind[step].dataType
    return F.col(".".join(quoted(s) for s in path.split("."))), kind


def _comparable(kind: T.DataType, value) -> bool:
    """Whether values of this JSON kind are stored in the column; others never compare."""
    if isinstance(value, bool) or isinstance(kind, T.BooleanType):
        return isinstance(value, bool) and isinstance(kind, T.BooleanType)
    if isinstance(value, str):
        return isinstance(kind, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))
    return isinstance(value, (int, float)) and isinstance(kind, T.NumericType)


def _literal(kind: T.DataType, value) -> Column:
    """A JSON value as the column's type, so that the comparison can be pushed to the scan."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(value).cast(kind)
    return F.lit(value)


def _any(column: Column, kind: T.DataType, test) -> Column:
    """A test of a value, or of any element of an array. Null is false."""
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.exists(column, lambda x: F.coalesce(test(x, kind.elementType), F.lit(False))), F.lit(False))
    return test(column, kind)


def _equals(column: Column | None, kind: T.DataType | None, value) -> Column:
    if column is None:
        return F.lit(value is None)
    if value is None:
        return column.isNull()
    return _any(column, kind, lambda c, k: (c == _literal(k, value)) if _comparable(k, value) else F.lit(False))


def _within(column: Column | None, kind: T.DataType | None, values: Sequence) -> Column:
    """Equal to one of the values; null stands for absent as well."""
    found = F.lit(False)
    if column is None:
        return F.lit(None in values)
    if not isinstance(kind, T.ArrayType):
        known = [_literal(kind, v) for v in values if v is not None and _comparable(kind, v)]
        found = column.isin(known) if known else found
    else:
        found = reduce(or_, [_equals(column, kind, v) for v in values if v is not None], found)
    return (found | column.isNull()) if None in values else found


def _no(test: Column) -> Column:
    """Not so, which what is absent fulfils."""
    return ~F.coalesce(test, F.lit(False))


def _condition(schema: T.StructType, path: str, name: str, value, options: str) -> Column:
    if name not in TESTS:
        raise PipelineError(f"unknown operator {name}")
    column, kind = _field(schema, path)
    if name == "$eq":
        return _equals(column, kind, value)
    if name == "$ne":
        if column is None or value is None or isinstance(kind, T.ArrayType) or not _comparable(kind, value):
            return _no(_equals(column, kind, value))
        return column.isNull() | (column != _literal(kind, value))  # a form that scans take
    if name in ("$in", "$nin"):
        if not isinstance(value, list):
            raise PipelineError(f"{name} takes a list")
        test = _within(column, kind, value)
        return test if name == "$in" else _no(test)
    if name == "$exists":
        there = F.lit(False) if column is None else column.isNotNull()
        return there if value else ~there
    if name == "$not":
        return _no(_field_test(schema, path, value))
    if column is None:
        return F.lit(False)
    if name in COMPARE:
        return _any(column, kind, lambda c, k: COMPARE[name](c, _literal(k, value)) if _comparable(k, value) else F.lit(False))
    if name == "$regex":
        wrong = set(options) - set("imsx")
        if wrong:
            raise PipelineError(f"unknown options of $regex: {''.join(sorted(wrong))}")
        form = f"(?{options}){value}" if options else value
        return _any(column, kind, lambda c, k: c.rlike(form) if isinstance(k, T.StringType) else F.lit(False))
    return F.coalesce(F.size(column) == value, F.lit(False)) if isinstance(kind, T.ArrayType) else F.lit(False)


def _field_test(schema: T.StructType, path: str, test) -> Column:
    if isinstance(test, Mapping) and test and all(k.startswith("$") for k in test):
        options = test.get("$options", "")
        parts = [_condition(schema, path, k, v, options) for k, v in test.items() if k != "$options"]
        if not parts:
            raise PipelineError("$options without $regex")
        return reduce(and_, parts)
    if isinstance(test, (Mapping, list)):
        raise PipelineError(f"{path}: whole documents and lists are not compared")
    return _condition(schema, path, "$eq", test, "")


def match(schema: T.StructType, query: Mapping) -> Column:
    """The condition of a ``$match`` over documents of a schema.

    ``$and $or $nor``, and by field ``$eq $ne $gt $gte $lt $lte $in $nin $exists $regex $not $size``. A field that a document
    lacks is null. Null equals null, and ``$ne``, ``$nin`` and ``$not`` hold for it; comparisons hold between values of one kind only.
    An array fulfils a test if one of its elements does.
    """
    parts = []
    for name, value in query.items():
        if name in ("$and", "$or", "$nor"):
            if not isinstance(value, list) or not value:
                raise PipelineError(f"{name} takes a list of conditions")
            tests = [match(schema, v) for v in value]
            parts.append(reduce(and_, tests) if name == "$and" else reduce(or_, tests) if name == "$or" else _no(reduce(or_, tests)))
        elif name.startswith("$"):
            raise PipelineError(f"unknown operator {name}")
        else:
            parts.append(_field_test(schema, name, value))
    return reduce(and_, parts) if parts else F.lit(True)


def _tree(paths: Sequence[str]) -> dict:
    out: dict = {}
    for path in paths:
        node = out
        for step in path.split(".")[:-1]:
            node = node.setdefault(step, {})
        node[path.split(".")[-1]] = None
    return out


def _kept(kind: T.StructType, tree: dict, prefix: str, include: bool) -> list[Column]:
    out = []
    for f in kind.fields:
        path = f"{prefix}.{quoted(f.name)}" if prefix else quoted(f.name)
        if f.name not in tree:
            if not include:
                out.append(F.col(path).alias(f.name))
        elif tree[f.name] is None:
            if include:
                out.append(F.col(path).alias(f.name))
        elif isinstance(f.dataType, T.StructType):
            inner = _kept(f.dataType, tree[f.name], path, include)
            if inner:
                out.append(F.when(F.col(path).isNotNull(), F.struct(*inner)).alias(f.name))
        elif not include:
            out.append(F.col(path).alias(f.name))
    return out


def project(df: DataFrame, spec: Mapping) -> DataFrame:
    """A ``$project``: fields kept (1) or left out (0) by dotted path, and new ones from others (``"$path"``).

    ``_id`` is kept unless it is left out. A new field from a path that no document has is null.
    """
    given = {k: v for k, v in spec.items() if isinstance(v, str)}
    flags = {k: bool(v) for k, v in spec.items() if not isinstance(v, str)}
    if any(not v.startswith("$") for v in given.values()):
        raise PipelineError("a new field is taken from a path with a dollar sign")
    rest = {k: v for k, v in flags.items() if k != "_id"}
    include = any(rest.values()) or bool(given)
    if include and not all(rest.values()):
        raise PipelineError("a projection either keeps fields or leaves them out")
    paths = [k for k, v in rest.items() if v == include]
    if "_id" in df.columns and flags.get("_id", True) == include:
        paths.insert(0, "_id")
    columns = _kept(df.schema, _tree(paths), "", include)
    for name, path in given.items():
        column, _ = _field(df.schema, path[1:])
        columns.append((F.lit(None).cast("string") if column is None else column).alias(name))
    return df.select(*columns)


def run_pipeline(df: DataFrame, pipeline: str | Sequence[Mapping]) -> DataFrame:
    """Stages ``$match``, ``$project`` and ``$limit`` in order; ``pipeline`` is a list or its JSON text."""
    stages = json.loads(pipeline) if isinstance(pipeline, str) else pipeline
    for stage in [stages] if isinstance(stages, Mapping) else stages:
        if len(stage) != 1:
            raise PipelineError("a stage has one operator")
        (name, spec), = stage.items()
        if name == "$match":
            df = df.where(match(df.schema, spec))
        elif name == "$project":
            df = project(df, spec)
        elif name == "$limit":
            df = df.limit(int(spec))
        else:
            raise PipelineError(f"unknown stage {name}")
    return df
