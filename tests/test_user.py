import re

from pyspark.sql import functions as F

from millrace.functions.user import batch_function, value_function


def test_value_function_is_null_safe(spark):
    strip = value_function(lambda s: re.sub("<.*?>", "", s), "string")
    df = spark.createDataFrame([("<p>a</p>",), (None,), ("b",)], "t string")
    assert [r[0] for r in df.select(strip("t")).collect()] == ["a", None, "b"]


def test_whole_numbers_stay_whole(spark):
    seen = value_function(lambda v: f"{type(v).__name__} {v}", "string")
    df = spark.createDataFrame([(1,), (None,), (2**53 + 1,)], "n bigint").coalesce(1)
    assert [r[0] for r in df.select(seen("n")).collect()] == ["int 1", None, f"int {2**53 + 1}"]


def test_batch_function_over_two_columns(spark):
    add = batch_function(lambda a, b: a + b, "bigint")
    df = spark.range(5).withColumn("x", F.col("id") * 10)
    assert [r[0] for r in df.select(add("id", "x")).collect()] == [0, 11, 22, 33, 44]


def test_frames_compose_as_functions(spark):
    def double(df):
        return df.withColumn("id", F.col("id") * 2)

    assert [r.id for r in spark.range(3).transform(double).transform(double).collect()] == [0, 4, 8]
