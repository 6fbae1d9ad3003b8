import datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from millrace.operators.warehouse import WarehouseField, conform, warehouse_schema


def test_every_type():
    schema = T.StructType([
        T.StructField("i", T.IntegerType(), False),
        T.StructField("l", T.LongType()),
        T.StructField("f", T.FloatType()),
        T.StructField("d", T.DoubleType()),
        T.StructField("s", T.StringType()),
        T.StructField("b", T.BooleanType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("day", T.DateType()),
        T.StructField("n", T.DecimalType(38, 9)),
        T.StructField("wide", T.DecimalType(20, 10)),
        T.StructField("short", T.ShortType()),
        T.StructField("bin", T.BinaryType()),
        T.StructField("st", T.StructType([T.StructField("x", T.IntegerType(), False)])),
        T.StructField("xs", T.ArrayType(T.StringType())),
        T.StructField("ss", T.ArrayType(T.StructType([T.StructField("y", T.DoubleType())]))),
    ])
    got = {f.name: (f.type, f.mode) for f in warehouse_schema(schema)}
    assert got == {
        "i": ("INT64", "REQUIRED"), "l": ("INT64", "NULLABLE"), "f": ("FLOAT64", "NULLABLE"),
        "d": ("FLOAT64", "NULLABLE"), "s": ("STRING", "NULLABLE"), "b": ("BOOL", "NULLABLE"),
        "ts": ("TIMESTAMP", "NULLABLE"), "day": ("DATE", "NULLABLE"),
        "n": ("NUMERIC", "NULLABLE"), "wide": ("STRING", "NULLABLE"),
        "short": ("STRING", "NULLABLE"), "bin": ("STRING", "NULLABLE"),
        "st": ("STRUCT", "NULLABLE"), "xs": ("STRING", "REPEATED"), "ss": ("STRUCT", "REPEATED"),
    }
    by_name = {f.name: f for f in warehouse_schema(schema)}
    assert by_name["st"].fields == (WarehouseField("x", "INT64", "REQUIRED"),)
    assert by_name["ss"].fields == (WarehouseField("y", "FLOAT64", "NULLABLE"),)


def test_maps_must_be_conformed(spark):
    df = spark.createDataFrame([({"a": 1},)], "m map<string,int>")
    with pytest.raises(ValueError, match="map column m"):
        warehouse_schema(df.schema)
    fields = warehouse_schema(conform(df).schema)
    assert (fields[0].type, fields[0].mode) == ("STRUCT", "REPEATED")
    assert warehouse_schema(conform(df, maps="json").schema)[0].type == "STRING"


def test_conform_values(spark):
    df = spark.createDataFrame(
        [(1, 2, 1.5, Decimal("1.0000000001"), b"\x01\x02", {"k": {"z": 3}},
          (4, [b"a"]), [[("q", 5)]][0], datetime.date(2020, 1, 2)),
         (None, None, None, None, None, None, None, None, None)],
        "i int, sh smallint, f float, w decimal(20,10), bin binary, m map<string,map<string,int>>, "
        "st struct<a: int, bs: array<binary>>, xs array<struct<n: string, v: smallint>>, d date",
    )
    out = conform(df)
    assert dict(out.dtypes) == {
        "i": "bigint", "sh": "string", "f": "double", "w": "string", "bin": "string",
        "m": "array<struct<key:string,value:array<struct<key:string,value:bigint>>>>",
        "st": "struct<a:bigint,bs:array<string>>", "xs": "array<struct<n:string,v:string>>",
        "d": "date",
    }
    row = out.where("i = 1").first()
    assert (row.sh, row.w, row.bin, row.st.bs, row.xs[0].v) == (
        "2", "1.0000000001", "AQI=", ["YQ=="], "5"
    )
    assert row.m[0].value[0].value == 3
    assert all(v is None for v in out.where("i is null").first())
    assert [f.type for f in warehouse_schema(out.schema)][:3] == ["INT64", "STRING", "FLOAT64"]
