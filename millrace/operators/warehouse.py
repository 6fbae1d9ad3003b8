"""Mapping of Spark schemas to warehouse columns, and the casts that make data fit it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.shapes import quoted

# Warehouse type names and the precision and scale NUMERIC holds.
TYPE_NAMES = {
    T.IntegerType: "INT64",
    T.LongType: "INT64",
    T.FloatType: "FLOAT64",
    T.DoubleType: "FLOAT64",
    T.StringType: "STRING",
    T.BooleanType: "BOOL",
    T.TimestampType: "TIMESTAMP",
    T.DateType: "DATE",
}
NUMERIC_PRECISION, NUMERIC_SCALE = 38, 9


@dataclass(frozen=True)
class WarehouseField:
    """One warehouse column: name, type, mode, and the sub-columns of a STRUCT."""

    name: str
    type: str
    mode: str
    fields: tuple[WarehouseField, ...] = ()


def _is_numeric(dtype: T.DataType) -> bool:
    return (
        isinstance(dtype, T.DecimalType)
        and dtype.precision <= NUMERIC_PRECISION
        and dtype.scale <= NUMERIC_SCALE
    )


def warehouse_field(field: T.StructField) -> WarehouseField:
    """The warehouse column for one Spark column.

    Arrays are REPEATED columns of their element; types without a counterpart, and decimals
    beyond NUMERIC, are STRING. A map has no counterpart: see :func:`conform`.
    """
    dtype = field.dataType
    mode = "NULLABLE" if field.nullable else "REQUIRED"
    if isinstance(dtype, T.MapType):
        raise ValueError(f"map column {field.name}: turn it to entries or JSON first")
    if isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, T.ArrayType):
            raise ValueError(f"column {field.name}: an array of arrays has no warehouse type")
        item = warehouse_field(T.StructField(field.name, dtype.elementType))
        return WarehouseField(field.name, item.type, "REPEATED", item.fields)
    if isinstance(dtype, T.StructType):
        return WarehouseField(field.name, "STRUCT", mode, tuple(warehouse_schema(dtype)))
    if _is_numeric(dtype):
        return WarehouseField(field.name, "NUMERIC", mode)
    return WarehouseField(field.name, TYPE_NAMES.get(type(dtype), "STRING"), mode)


def warehouse_schema(schema: T.StructType) -> list[WarehouseField]:
    """The warehouse columns for a Spark schema."""
    return [warehouse_field(f) for f in schema.fields]


def _target(dtype: T.DataType) -> T.DataType:
    """The Spark type whose values load into the warehouse type of ``dtype``."""
    if isinstance(dtype, T.StructType):
        return T.StructType(
            [T.StructField(f.name, _target(f.dataType), f.nullable) for f in dtype.fields]
        )
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_target(dtype.elementType), dtype.containsNull)
    if isinstance(dtype, T.IntegerType):
        return T.LongType()
    if isinstance(dtype, T.FloatType):
        return T.DoubleType()
    if _is_numeric(dtype) or type(dtype) in TYPE_NAMES:
        return dtype
    return T.StringType()


def _fit(col: Column, dtype: T.DataType, maps: str, nullable: bool = True) -> Column:
    if isinstance(dtype, T.MapType):
        if maps == "json":
            return F.to_json(col)
        pair = T.StructType([
            T.StructField("key", dtype.keyType, False),
            T.StructField("value", dtype.valueType, dtype.valueContainsNull),
        ])
        return _fit(F.map_entries(col), T.ArrayType(pair, False), maps)
    if isinstance(dtype, T.StructType):
        parts = [
            _fit(col.getField(f.name), f.dataType, maps, f.nullable).alias(f.name)
            for f in dtype.fields
        ]
        # Without the guard a required struct stays required.
        return F.when(col.isNotNull(), F.struct(*parts)) if nullable else F.struct(*parts)
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _fit(x, dtype.elementType, maps, dtype.containsNull))
    if isinstance(dtype, T.BinaryType):
        return F.base64(col)
    wanted = _target(dtype)
    return col if wanted == dtype else col.cast(wanted)


def conform(df: DataFrame, maps: str = "entries") -> DataFrame:
    """Cast the data to what :func:`warehouse_schema` declares, in one projection.

    Maps become arrays of key and value (``entries``) or text (``json``), binary becomes
    Base64 text, and everything else without a counterpart its string form.
    """
    if maps not in ("entries", "json"):
        raise ValueError("maps is 'entries' or 'json'")
    return df.select(
        *[
            _fit(F.col(quoted(f.name)), f.dataType, maps, f.nullable).alias(f.name)
            for f in df.schema.fields
        ]
    )
