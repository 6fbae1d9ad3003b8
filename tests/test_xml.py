import random

import pytest

from millrace.sources.options import OptionError
from millrace.sources.xml import read_xml_split

PLAIN = "_id bigint, title string, tags struct<tag: array<string>>"
SCHEMA = PLAIN + ", _corrupt_record string"


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def book(rng, i, sections):
    text = rng.choice(["plain", "a &amp; b", "ünï", "<![CDATA[x < y]]>"])
    if sections and rng.random() < 0.2:
        text = rng.choice(["<![CDATA[ </book> <book> ]]>", "<!-- </book> -->t", "<![CDATA[ <!-- </book> ]]>", "<!-- <![CDATA[ </book> -->t"])
    kind = rng.random()
    if kind < 0.1:
        return f'<book id="{i}" />'
    if kind < 0.15:
        return f"<book id='{i}'/>"
    tags = "".join(f"<tag>t{k}</tag>" for k in range(rng.randrange(3)))
    end = rng.choice(["</book>", "</book >", "</book\n>"]) if rng.random() < 0.2 else "</book>"
    return f'<book id="{i}" note="a>b / c"><title>{text}</title><tags>{tags}</tags>{end}'


def document(seed, n, sections=False):
    rng = random.Random(seed)
    between = ["", "\n", "<shelf name='x'/>", "<shelf>text</shelf>", "<!-- a comment -->", "<bookend/>"]
    if sections:
        between += ["<!-- </book> -->", "<!-- <book id='9'> </book> </book> -->"]
    return '<?xml version="1.0"?>\n<!-- head -->\n<books>' + "".join(rng.choice(between) + book(rng, i, sections) for i in range(n)) + "\n</books>\n<!-- end -->"


def bag(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("sections", [False, True])
def test_same_rows_as_the_built_in_reader(spark, tmp_path, small_splits, sections):
    for i in range(3):
        (tmp_path / f"{i}.xml").write_text(document(i, 400, sections))
    (tmp_path / "empty.xml").write_text("")
    path = str(tmp_path)
    got = read_xml_split(spark, path, SCHEMA, rowTag="book")
    assert got.rdd.getNumPartitions() > 3
    # The built-in reader is given the plain form of closing tags, which is all it knows.
    other = tmp_path.parent / f"{tmp_path.name}-plain"
    other.mkdir()
    for i in range(3):
        (other / f"{i}.xml").write_text(document(i, 400, sections).replace("</book >", "</book>").replace("</book\n>", "</book>"))
    want = spark.read.schema(SCHEMA).option("rowTag", "book").xml(str(other))
    assert bag(got) == bag(want)
    assert got.count() == 1200


def test_one_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    (tmp_path / "one.xml").write_text(document(7, 2000))
    rows = read_xml_split(spark, str(tmp_path), SCHEMA, rowTag="book", tags_in_sections=False)
    sizes = rows.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert sum(sizes) == 2000 and sum(s > 0 for s in sizes) > 5


def test_malformed_records(spark, tmp_path):
    (tmp_path / "bad.xml").write_text('<books><book id="1"><title>x</title></book><book id="2"><title>y</book><book id="z"><title>w</title></book></books>')
    path = str(tmp_path)
    kept = read_xml_split(spark, path, SCHEMA, rowTag="book").collect()
    assert [r["_id"] for r in kept if r["_corrupt_record"] is None] == [1] and len(kept) == 3
    assert read_xml_split(spark, path, SCHEMA, rowTag="book", mode="DROPMALFORMED").count() == 1
    plain = PLAIN
    assert read_xml_split(spark, path, plain, rowTag="book", mode="DROPMALFORMED").columns == ["_id", "title", "tags"]
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        read_xml_split(spark, path, plain, rowTag="book", mode="FAILFAST").collect()


def test_options(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<r><x i='1'>v</x></r>")
    got = read_xml_split(spark, str(tmp_path), "a_i int, v string", rowTag="x", attributePrefix="a_", valueTag="v")
    assert [tuple(r) for r in got.collect()] == [(1, "v")]
    for bad in ({}, {"rowTag": "x", "charset": "latin1"}):
        with pytest.raises(OptionError):
            read_xml_split(spark, str(tmp_path), SCHEMA, bad)
