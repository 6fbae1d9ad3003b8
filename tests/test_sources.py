import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import scratch_path
from millrace.sources.options import OptionError, check_options
from millrace.sources.readers import (
    FormatUnavailable,
    branch_frame,
    kafka_options,
    read_log,
    read_source,
    stream_log,
)
from millrace.sources.schemas import (
    avro_decimal_fields,
    avro_to_struct,
    infer_json_schema,
    latest_schemas,
    parse_schema,
    schema_from_file,
    variant_ddl,
)


def put(spark, text, label="text", name="data"):
    path = scratch_path(spark, label)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def test_csv_options(spark):
    path = put(spark, '# note\nid;name;day\n1; "a;b" ;2020-01-02\n2;NA;2020-02-03')
    df = read_source(
        spark, "CSV", path, "id int, name string, day date", header=True, delimiter=";",
        comment="#", nullValue="NA", ignoreLeadingWhiteSpace=True, dateFormat="yyyy-MM-dd",
        ignoreTrailingWhiteSpace=True, mode="PERMISSIVE", maxCharsPerColumn=100,
    )
    assert [(r.id, r.name, str(r.day)) for r in df.orderBy("id").collect()] == [
        (1, "a;b", "2020-01-02"), (2, None, "2020-02-03")
    ]


def test_json_options_and_corrupt_column(spark):
    path = put(spark, '{a: 1, "b": 2.5} // c\n{"a": "x"\n{"a": 3, "b": null}')
    df = read_source(
        spark, "json", path, "a int, b double, _corrupt string", allowComments=True,
        allowUnquotedFieldNames=True, mode="permissive", columnNameOfCorruptRecord="_corrupt",
    ).cache()
    assert df.where("_corrupt is null").count() == 2
    assert df.where("_corrupt is not null").first()._corrupt == '{"a": "x"'
    dropped = read_source(spark, "json", path, "a int, b double", mode="DROPMALFORMED",
                          allowUnquotedFieldNames=True, allowComments=True)
    assert dropped.count() == 2
    strict = read_source(spark, "json", path, "a int", mode="FAILFAST")
    with pytest.raises(Exception, match="Malformed"):
        strict.collect()


def test_unknown_and_bad_options():
    with pytest.raises(OptionError, match="did you mean header"):
        check_options("csv", {"heder": True})
    with pytest.raises(OptionError, match="mode must be"):
        check_options("json", {"mode": "LENIENT"})
    with pytest.raises(OptionError, match="no reader profile"):
        check_options("excel", {})
    with pytest.raises(OptionError, match="rowTag is required"):
        check_options("xml", {})
    assert check_options("orc", {"MERGESCHEMA": True}) == {"mergeSchema": "true"}


@pytest.mark.parametrize(
    ("fmt", "given", "name"),
    [
        ("jdbc", {"url": "u", "dbtable": "t", "isolationLevel": "READ_COMMITTED"}, "isolationLevel"),
        ("avro", {"recordName": "User"}, "recordName"),
        ("avro", {"recordNamespace": "n"}, "recordNamespace"),
        ("avro", {"compression": "snappy"}, "compression"),
        ("xml", {"rowTag": "b", "rootTag": "bs"}, "rootTag"),
        ("orc", {"datetimeRebaseMode": "LEGACY"}, "datetimeRebaseMode"),
    ],
)
def test_options_without_effect_are_told(fmt, given, name):
    with pytest.warns(UserWarning, match=name):
        assert name not in check_options(fmt, given)


def test_jdbc_options():
    base = {"url": "jdbc:x", "dbtable": "t"}
    assert check_options("jdbc", base)["fetchsize"] == "1000"
    assert check_options("jdbc", {**base, "fetchsize": 50})["fetchsize"] == "50"
    parted = {"partitionColumn": "id", "lowerBound": 1, "upperBound": 100, "numPartitions": 4}
    assert check_options("jdbc", {**base, **parted})["numPartitions"] == "4"
    with pytest.raises(OptionError, match="also needs numPartitions"):
        check_options("jdbc", {**base, **{k: v for k, v in parted.items() if k != "numPartitions"}})
    with pytest.raises(OptionError, match="takes dbtable"):
        check_options("jdbc", {"url": "u", "query": "select 1", **parted})
    with pytest.raises(OptionError, match="exactly one"):
        check_options("jdbc", {**base, "query": "select 1"})
    with pytest.raises(OptionError, match="url is required"):
        check_options("jdbc", {"dbtable": "t"})


def test_mongo_options():
    out = check_options("mongodb", {
        "uri": "mongodb://h", "database": "d", "collection": "c",
        "pipeline": [{"$match": {"status": "completed"}}],
        "readPreference.name": "secondaryPreferred", "partitioner": "MongoSamplePartitioner",
        "partitionerOptions.partitionKey": "_id", "spark.mongodb.read.sampleSize": 1000,
    })
    assert out["connection.uri"] == "mongodb://h" and out["partitioner.options.partitionKey"] == "_id"
    assert json.loads(out["aggregation.pipeline"]) == [{"$match": {"status": "completed"}}]
    assert out["spark.mongodb.read.sampleSize"] == "1000"
    with pytest.raises(OptionError, match="collection is required"):
        check_options("mongodb", {"uri": "u", "database": "d"})


@pytest.mark.parametrize(("fmt", "kw"), [
    ("avro", {"path": "/tmp/none"}),
    ("mongodb", {"options": {"uri": "u", "database": "d", "collection": "c"}}),
])
def test_absent_connectors_say_so(spark, fmt, kw):
    with pytest.raises(FormatUnavailable, match="needs the package"):
        read_source(spark, fmt, **kw)


def test_kafka_options(spark):
    opts = kafka_options(
        "b1:9093,b2:9093", assign={"t": [0, 1]}, starting={"t": {0: 5, 1: -2}}, group_id="g",
        security={"security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN"},
        minPartitions=5, failOnDataLoss=False, maxOffsetsPerTrigger=5000,
    )
    out = check_options("kafka", opts, stream=True)
    assert json.loads(out["assign"]) == {"t": [0, 1]}
    assert json.loads(out["startingOffsets"]) == {"t": {"0": 5, "1": -2}}
    assert out["kafka.security.protocol"] == "SASL_SSL" and out["kafka.group.id"] == "g"
    assert out["failOnDataLoss"] == "false" and out["maxOffsetsPerTrigger"] == "5000"
    with pytest.raises(OptionError, match="streams only"):
        check_options("kafka", opts)
    with pytest.raises(OptionError, match="exactly one"):
        check_options("kafka", kafka_options("b"))
    with pytest.raises(OptionError, match="cannot start at latest"):
        check_options("kafka", kafka_options("b", subscribe="t", starting="latest"))
    for bad in ({"starting": {"t": {0: -1}}}, {"ending": {"t": {0: -2}}}, {"ending": "earliest"}):
        with pytest.raises(OptionError, match="batch read cannot"):
            check_options("kafka", kafka_options("b", subscribe="t", **bad))
    with pytest.raises(OptionError, match="batch reads only"):
        check_options("kafka", kafka_options("b", subscribe="t", ending="latest"), stream=True)
    with pytest.raises(FormatUnavailable, match="kafka"):
        read_log(spark, "b", subscribe=["a", "b"])
    with pytest.raises(FormatUnavailable, match="kafka"):
        stream_log(spark, "b", pattern="a.*", fetchOffset_numRetries=None)


def test_paths_are_checked(spark):
    with pytest.raises(OptionError, match="path is required"):
        read_source(spark, "csv")
    with pytest.raises(OptionError, match="takes no path"):
        read_source(spark, "jdbc", "/x", url="u", dbtable="t")


TREES = """<grove>
  <tree><no>14</no><kind>ash</kind><keeper> Ruth </keeper></tree>
  <tree><no>15</no><kind>elm</kind><keeper>Omar</keeper></tree>
</grove>"""
TRIPS = """<trips>
  <trip code="7" state="open"><guest>Ada</guest>
    <legs><leg><from>Oslo</from><km>12</km></leg><leg><from>Bonn</from><km>30</km></leg></legs></trip>
</trips>"""


def test_xml_flat(spark):
    df = read_source(spark, "xml", put(spark, TREES), rowTag="tree", inferSchema=True,
                     charset="UTF-8", ignoreSurroundingSpaces=True)
    assert df.dtypes == [("keeper", "string"), ("kind", "string"), ("no", "bigint")]
    assert sorted(r.keeper for r in df.collect()) == ["Omar", "Ruth"]


def test_xml_nested_with_attributes(spark):
    path = put(spark, TRIPS)
    df = read_source(spark, "xml", path, rowTag="trip", attributePrefix="_", valueTag="_VALUE")
    assert dict(df.dtypes) == {
        "_code": "bigint", "_state": "string", "guest": "string",
        "legs": "struct<leg:array<struct<from:string,km:bigint>>>",
    }
    bare = read_source(spark, "xml", path, rowTag="trip", excludeAttribute=True)
    assert bare.columns == ["guest", "legs"]


def test_xml_validation_sends_rows_to_the_corrupt_column(spark):
    xsd = scratch_path(spark, "xsd")
    import pathlib

    pathlib.Path(xsd).write_text(
        '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="book">'
        '<xs:complexType><xs:sequence><xs:element name="id" type="xs:int"/></xs:sequence>'
        "</xs:complexType></xs:element></xs:schema>"
    )
    spark.sparkContext.addFile(xsd)
    path = put(spark, "<r><book><id>1</id></book><book><id>x</id></book></r>")
    df = read_source(spark, "xml", path, "id string, _corrupt_record string", rowTag="book",
                     rowValidationXSDPath=xsd, mode="PERMISSIVE").cache()
    assert df.where("_corrupt_record is null").count() == 1
    assert df.where("_corrupt_record is not null").count() == 1


def test_common_file_options(spark):
    root = scratch_path(spark, "tree")
    spark.range(3).write.parquet(f"{root}/a")
    spark.range(4).write.parquet(f"{root}/b/c")
    spark.range(9).write.csv(f"{root}/b/d")
    got = read_source(spark, "parquet", root, "id bigint", recursiveFileLookup=True,
                      pathGlobFilter="*.parquet")
    assert got.count() == 7
    none = read_source(spark, "parquet", f"{root}/a", "id bigint", modifiedBefore="2001-01-01T00:00:00")
    assert none.count() == 0
    some = read_source(spark, "parquet", [f"{root}/a", f"{root}/b/c"], modifiedAfter="2001-01-01T00:00:00")
    assert some.count() == 7


def test_parquet_merge_and_base_path(spark):
    root = scratch_path(spark, "merge")
    spark.range(2).write.parquet(f"{root}/p=1")
    spark.range(2).selectExpr("id", "id * 2 as x").write.parquet(f"{root}/p=2")
    df = read_source(spark, "parquet", root, mergeSchema=True)
    assert set(df.columns) == {"id", "x", "p"}
    one = read_source(spark, "parquet", f"{root}/p=2", basePath=root)
    assert one.select("p").distinct().first().p == 2


def test_branch(spark):
    yes, no = ([(1, 2, 3)], ["a", "b", "c"]), ([(2, 3, 4)], "x int, y int, z int")
    assert branch_frame(spark, True, yes, no).columns == ["a", "b", "c"]
    assert branch_frame(spark, False, yes, no).first().asDict() == {"x": 2, "y": 3, "z": 4}
    assert branch_frame(spark, True, lambda: spark.range(1), lambda: 1 / 0).columns == ["id"]


AVRO = json.dumps({
    "type": "record", "name": "Test", "fields": [
        {"name": "field1", "type": "string"},
        {"name": "opt", "type": ["null", "int"]},
        {"name": "wide", "type": ["int", "long"]},
        {"name": "day", "type": {"type": "int", "logicalType": "date"}},
        {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "price", "type": ["null", {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}]},
        {"name": "tags", "type": {"type": "array", "items": ["null", "string"]}},
        {"name": "m", "type": {"type": "map", "values": "double"}},
        {"name": "kind", "type": {"type": "enum", "name": "Kind", "symbols": ["A"]}},
        {"name": "again", "type": "Kind"},
        {"name": "sub", "type": {"type": "record", "name": "Sub", "fields": [{"name": "x", "type": "boolean"}]}},
    ],
})


def test_avro_schema():
    got = avro_to_struct(AVRO)
    assert got["field1"] == T.StructField("field1", T.StringType(), False)
    assert got["opt"] == T.StructField("opt", T.IntegerType(), True)
    assert got["wide"].dataType == T.LongType()
    assert got["day"].dataType == T.DateType() and got["at"].dataType == T.TimestampType()
    assert got["price"] == T.StructField("price", T.DecimalType(9, 2), True)
    assert got["tags"].dataType == T.ArrayType(T.StringType(), True)
    assert got["m"].dataType == T.MapType(T.StringType(), T.DoubleType(), False)
    assert got["kind"].dataType == got["again"].dataType == T.StringType()
    assert got["sub"].dataType.fieldNames() == ["x"]
    assert avro_decimal_fields(AVRO) == {"price": (9, 2)}
    with pytest.raises(ValueError, match="not a record"):
        avro_to_struct('"string"')


def test_schema_texts(spark):
    want = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    assert parse_schema("a int, b string") == want
    assert parse_schema(want.json()) == want
    assert schema_from_file(spark, put(spark, want.json())) == want
    assert schema_from_file(spark, put(spark, AVRO)).fieldNames()[0] == "field1"


def test_latest_schemas(spark):
    reg = spark.createDataFrame(
        [("t1-value", 1, "old"), ("t1-value", 10, "new"), ("t1-value", 9, "mid"), ("t2-value", 1, "x")],
        "subject string, version int, schema string",
    )
    assert {r.subject: r.schema for r in latest_schemas(reg).collect()} == {
        "t1-value": "new", "t2-value": "x"
    }
    topics = spark.createDataFrame([("t1",), ("t1",), ("t3",)], "topic string")
    assert [tuple(r) for r in latest_schemas(reg, topics).collect()] == [("t1", "t1-value", 10, "new")]


def test_inference_covers_all_rows(spark):
    rows = ['{"sum(col1)": 1, "b": {"c": [1]}}', '{"z": "t", "b": {"d": true}}', "broken", None, '{"n": null}']
    df = spark.createDataFrame([(r,) for r in rows], "v string")
    schema = infer_json_schema(df, "v")
    out = df.select(F.from_json("v", schema).alias("r"))
    kinds = dict(out.select("r.*").dtypes)
    assert kinds == {
        "sum(col1)": "bigint", "b": "struct<c:array<bigint>,d:boolean>", "z": "string", "n": "string"
    }
    for mixed in (["x"], ["1", '{"a": 1}'], [None]):
        with pytest.raises(ValueError, match="no common structure"):
            infer_json_schema(spark.createDataFrame([(m,) for m in mixed], "v string"), "v")
    assert variant_ddl("OBJECT<a: ARRAY<VOID>>") == "STRUCT<a: ARRAY<STRING>>"


def test_schema_covers_all_rows(spark):
    rows = ['{"a":1}', '{"a":2.5,"b":"x"}', '{"VOID":1,"VARIANT":{"OBJECT":null}}', "no json", None]
    df = spark.createDataFrame([(r,) for r in rows], "v string")
    out = df.select(F.from_json("v", infer_json_schema(df, "v")).alias("r")).select("r.*")
    assert set(out.columns) == {"a", "b", "VOID", "VARIANT"}
    got = [tuple(r) for r in out.selectExpr("cast(a as double)", "b", "VOID").collect()]
    assert got[:3] == [(1.0, None, None), (2.5, "x", None), (None, None, 1)]


def test_avro_full_names():
    text = json.dumps({
        "type": "record", "name": "Top", "namespace": "com.x", "fields": [
            {"name": "kind", "type": {"type": "enum", "name": "Kind", "symbols": ["A"]}},
            {"name": "again", "type": ["null", "com.x.Kind"]}, {"name": "short", "type": "Kind"},
            {"name": "sum", "type": {"type": "fixed", "name": "Sum", "size": 8, "logicalType": "decimal", "precision": 12, "scale": 3}},
            {"name": "total", "type": "Sum"},
            {"name": "in", "type": {"type": "record", "name": "org.y.In", "fields": [
                {"name": "part", "type": {"type": "fixed", "name": "Part", "size": 2}}, {"name": "twin", "type": "org.y.Part"},
            ]}},
            {"name": "more", "type": {"type": "array", "items": "org.y.In"}},
        ],
    })
    assert avro_to_struct(text).simpleString() == (
        "struct<kind:string,again:string,short:string,sum:decimal(12,3),total:decimal(12,3),"
        "in:struct<part:binary,twin:binary>,more:array<struct<part:binary,twin:binary>>>"
    )



def test_other_analysis_errors_pass_through(spark):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_source(spark, "parquet", "/tmp/no-such-folder-here")
