"""Changes of shape driven by the schema: rewrite by type, flatten, maps, constants."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def rewrite_by_type(
    df: DataFrame, rules: Mapping[type[T.DataType], Callable[[Column, T.DataType], Column]]
) -> DataFrame:
    """Apply a function to every top-level column of a given type, in one projection.

    ``rules`` maps a type class to ``f(column, data_type)``; names and order stay.
    """
    return df.select(
        *[
            rules[type(f.dataType)](F.col(quoted(f.name)), f.dataType).alias(f.name)
            if type(f.dataType) in rules
            else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )


def maps_to_json(df: DataFrame) -> DataFrame:
    """Every map column as JSON text."""
    return rewrite_by_type(df, {T.MapType: lambda c, _: F.to_json(c)})


def maps_to_entries(df: DataFrame) -> DataFrame:
    """Every map column as an array of ``struct<key, value>``."""
    return rewrite_by_type(df, {T.MapType: lambda c, _: F.map_entries(c)})


def _leaves(schema: T.StructType, sep: str, path: str = "", label: str = ""):
    for f in schema.fields:
        here = f"{path}.{quoted(f.name)}" if path else quoted(f.name)
        name = f"{label}{sep}{f.name}" if label else f.name
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            yield from _leaves(f.dataType, sep, here, name)
        else:
            yield here, name


def _has_struct_array(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)


def flatten(df: DataFrame, sep: str = "_", explode_arrays: bool = False) -> DataFrame:
    """All structs of any depth as flat columns ``outer<sep>inner``.

    With ``explode_arrays`` an array of structs becomes one row per element first (one row of
    nulls for an empty or missing array); several such arrays multiply, as nested data does.
    Names that would collide raise.
    """
    leaves = list(_leaves(df.schema, sep))
    twice = [n for n, k in Counter(n.lower() for _, n in leaves).items() if k > 1]
    if twice:
        raise ValueError(f"flatten would repeat column {', '.join(twice)}; use another sep")
    flat = df.select(*[F.col(path).alias(name) for path, name in leaves])
    if not explode_arrays:
        return flat
    for f in flat.schema.fields:
        if _has_struct_array(f.dataType):
            one = flat.select(
                *[
                    F.explode_outer(quoted(c)).alias(c) if c == f.name else F.col(quoted(c))
                    for c in flat.columns
                ]
            )
            return flatten(one, sep, explode_arrays=True)
    return flat


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant columns."""
    return df.withColumns({n: F.lit(v) for n, v in values.items()})


def cast_columns(
    df: DataFrame, types: Mapping[str, str | T.DataType], *, strict: bool = True
) -> DataFrame:
    """Cast named columns; without ``strict`` a value that does not fit becomes null."""
    how = {
        n: F.col(quoted(n)).cast(t) if strict else F.col(quoted(n)).try_cast(t)
        for n, t in types.items()
    }
    return df.withColumns(how)


def match_fields(df: DataFrame, **wanted) -> DataFrame:
    """Rows whose columns equal the given values: the ``$match`` form of a filter."""
    for name, value in wanted.items():
        df = df.where(
            F.col(name).isin(list(value)) if isinstance(value, (list, tuple, set))
            else F.col(name) == value
        )
    return df


def entries_to_rows(df: DataFrame, col: str, *keep: str) -> DataFrame:
    """One row per ``struct<key, value>`` of an array column: ``keep`` columns, key, value."""
    return df.select(*keep, F.explode(col).alias("_entry")).select(*keep, "_entry.*")


def entries_to_map(col: str | Column) -> Column:
    """An array of ``struct<key, value>`` as a map."""
    return F.map_from_entries(col)
