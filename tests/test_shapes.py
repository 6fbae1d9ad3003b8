import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.shapes import (
    cast_columns,
    entries_to_map,
    entries_to_rows,
    flatten,
    maps_to_entries,
    maps_to_json,
    match_fields,
    rewrite_by_type,
    with_constants,
)


def test_flatten_address(spark):
    df = spark.createDataFrame(
        [(1, ("123 Main St", "CityA", "12345")), (2, ("456 Elm St", "CityB", "67890"))],
        "id int, address struct<street: string, city: string, zip: string>",
    )
    out = flatten(df)
    assert out.columns == ["id", "address_street", "address_city", "address_zip"]
    assert tuple(out.orderBy("id").first()) == (1, "123 Main St", "CityA", "12345")


def test_flatten_depth_odd_names_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, (None, ("x",))), (2, None)],
        "id int, `a.b` struct<c: int, `d``e`: struct<f: string>>",
    )
    out = flatten(df, sep=".")
    assert out.columns == ["id", "a.b.c", "a.b.d`e.f"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, None, "x"), (2, None, None)]


def test_flatten_collision(spark):
    df = spark.createDataFrame([(1, (2,))], "a_b int, a struct<b: int>")
    with pytest.raises(ValueError, match="a_b"):
        flatten(df)
    assert flatten(df, sep="__").columns == ["a_b", "a__b"]


def test_flatten_arrays(spark):
    df = spark.createDataFrame(
        [(1, [(1, [("p",), ("q",)]), (2, [])]), (2, None)],
        "id int, xs array<struct<n: int, ys: array<struct<s: string>>>>",
    )
    out = flatten(df, explode_arrays=True)
    assert out.columns == ["id", "xs_n", "xs_ys_s"]
    rows = sorted(out.collect(), key=str)
    assert [tuple(r) for r in rows] == [(1, 1, "p"), (1, 1, "q"), (1, 2, None), (2, None, None)]


def test_flatten_keeps_leaf_values(spark):
    df = spark.range(20).select(
        "id", F.struct(F.col("id").alias("a"), F.struct((F.col("id") * 2).alias("b")).alias("s")).alias("t")
    )
    assert flatten(df).agg(F.sum("t_a"), F.sum("t_s_b")).first() == (190, 380)


def test_maps(spark):
    df = spark.createDataFrame([(1, {"a": 1, "b": 2}), (2, None)], "id int, m map<string,int>")
    text = {r.id: r.m for r in maps_to_json(df).collect()}
    assert text == {1: '{"a":1,"b":2}', 2: None}
    entries = maps_to_entries(df)
    assert entries.schema["m"].dataType.elementType.fieldNames() == ["key", "value"]
    rows = sorted(tuple(r) for r in entries_to_rows(entries, "m", "id").collect())
    assert rows == [(1, "a", 1), (1, "b", 2)]
    back = entries.select("id", entries_to_map("m").alias("m"))
    assert {r.id: r.m for r in back.collect()} == {1: {"a": 1, "b": 2}, 2: None}


def test_rewrite_by_type_is_one_projection(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, `c d` string")
    out = rewrite_by_type(
        df, {T.DoubleType: lambda c, _: c.cast("int"), T.StringType: lambda c, _: F.upper(c)}
    )
    assert out.dtypes == [("a", "int"), ("b", "int"), ("c d", "string")]
    assert tuple(out.first()) == (1, 2, "X")


def test_casts_constants_filters(spark):
    df = spark.createDataFrame([("1", b"x"), ("z", b"y")], "n string, b binary")
    out = cast_columns(df, {"n": "double", "b": "string"}, strict=False)
    assert sorted(out.collect(), key=str) == [(1.0, "x"), (None, "y")]
    assert with_constants(df, {"g": "grp", "i": 3}).first()[2:] == ("grp", 3)
    assert match_fields(df, n="z").count() == 1
    assert match_fields(df, n=["z", "1"], b=bytearray(b"x")).count() == 1
