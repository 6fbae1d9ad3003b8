import json

import pytest
from pyspark.sql import functions as F

from millrace.functions.text import (
    inject_before_close,
    is_json,
    json_or_null,
    json_struct,
    result_json_array,
    rows_to_json,
    strip_and_parse,
    strip_markup,
    xml_escape,
)
from millrace.plans.conversions import ARTICLE
from millrace.operators.shapes import entries_to_rows


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn("v")).first()[0]


@pytest.mark.parametrize(
    ("text", "want"),
    [("<p>a<br/>b</p>", "ab"), ("a < b > c", "a  c"), ("no", "no"), (None, None), ("<a\nb>x", "<a\nb>x"),
     ("<a\rb c>x", "x")],
)
def test_strip_markup(spark, text, want):
    assert one(spark, text, strip_markup) == want


def test_strip_markup_over_lines(spark):
    assert one(spark, "<a\nb>x", lambda c: strip_markup(c, multiline=True)) == "x"


def test_json_or_null(spark):
    assert one(spark, '{"b": 1, "a": [1, 2.5]}', json_or_null) == '{"a":[1,2.5],"b":1}'
    assert one(spark, "{'a': 1", json_or_null) is None
    for quoted in ("{'a': 1}", "{'a': 1e400}", '{"a": \'b\'}'):
        assert one(spark, quoted, json_or_null) is None
    assert one(spark, '{"a": "it\'s", "a": "x\\"\'"} ', json_or_null) == '{"a": "it\'s", "a": "x\\"\'"}'


ARTICLE_DOC = (
    '<p>{"MegaAttributes": {"lastUpdateUser": "ann", "lastUpdateTimestamp": "1999-12-31 08:00:00", '
    '"renderAsTable": "true", "tableTitle": "Measures", "attributes": []}, '
    '"SourceArticleAttributes": {"lastUpdateUser": "bob", "renderAsTable": "true", "attributes": '
    '[{"key": "length", "value": 17}, {"key": "colour", "value": ""}, '
    '{"key": "sizes", "value": [3, 4]}, {"key": "makers", "value": ["Oak & Sons"]}]}}</p>'
)


def test_article(spark):
    df = spark.createDataFrame(
        [(1, ARTICLE_DOC), (2, "<p>{'broken': ’]}</p>"), (3, None)], "id int, json_data string"
    )
    clean = strip_and_parse(df, "json_data")
    assert {r.id: r.json_data_ok for r in clean.collect()} == {1: True, 2: False, 3: True}
    parsed = clean.select("id", json_struct("json_data", ARTICLE).alias("a"))
    rows = entries_to_rows(
        parsed.select("id", F.col("a.SourceArticleAttributes.attributes").alias("x")), "x", "id"
    )
    assert {r.key: r.value for r in rows.collect()} == {
        "length": "17", "colour": "", "sizes": "[3,4]", "makers": '["Oak & Sons"]',
    }


def test_single_quoted_json(spark):
    got = one(spark, "{'id': 1, 'name': 'John'}", lambda c: json_struct(c, "id int, name string"))
    assert tuple(got) == (1, "John")


FLEET = "<fleet><ship><no>7</no><port>Kiel</port></ship><ship><no>9</no><port>Riga</port></ship></fleet>"


def test_inject(spark):
    extra = "<flag>c</flag><crew>$1\\</crew>"
    got = one(spark, FLEET, lambda c: inject_before_close(c, "ship", extra))
    assert got == FLEET.replace("</ship>", extra + "</ship>")
    assert one(spark, None, lambda c: inject_before_close(c, "ship", extra)) is None


def test_xml_escape(spark):
    assert one(spark, "a<b>&amp;", xml_escape) == "a&lt;b&gt;&amp;amp;"


def test_rows_to_json(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "`sum(a)` int, b string")
    texts = sorted(r.value for r in rows_to_json(df).collect())
    assert [json.loads(t) for t in texts] == [{"sum(a)": 1, "b": "x"}, {"sum(a)": 2}]


def test_result_array_of_any_size(spark, tmp_path):
    df = spark.range(25_000).repartition(5).withColumn("a`b", F.col("id") * 2)
    for frame, want in ((df, 25_000), (df.where("false"), 0), (df.where("id = 0"), 1)):
        path = str(tmp_path / str(want))
        result_json_array(frame).write.text(path)
        names = sorted(p for p in (tmp_path / str(want)).iterdir() if p.name.startswith("part-"))
        got = json.loads("".join(p.read_text() for p in names))
        assert sorted(r["a`b"] for r in got) == [2 * i for i in range(want)]


@pytest.mark.parametrize(("text", "ok"), [
    ('{"k":1}', True), ("", False), ("  ", False), ('{"k":1} trailing', False), ('{"k":1}{"k":2}', False),
    ("1,2", False), ("1],[2", False), ("1}", False), ('1,"b":2', False), ("null", True), (None, None),
    (' "x" ', True), ("[1]", True), ('{"a":1} }', False), ('{"a":', False), ('{"_":1},{"_":2}', False),
    ('{"a":1,"a":2}', True), ("{'a':1}", True),
])
def test_is_json(spark, text, ok):
    assert one(spark, text, is_json) is ok


@pytest.mark.parametrize(("text", "want"), [
    ('{"a": 1} x', None), ('{"b": 1e400}', '{"b": 1e400}'), ("1" * 45, "1" * 45),
    ('{"t": "1e400 x"}', '{"t": "1e400 x"}'), ('{"n": 12.50}', None),
])
def test_numbers_keep_their_text(spark, text, want):
    got = one(spark, text, json_or_null)
    if text.startswith('{"n"'):
        assert json.loads(got) == {"n": 12.5}
    else:
        assert got == want
