import json
from decimal import Decimal, getcontext

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.decimals import (
    bytes_to_decimal,
    convert_decimal_fields,
    decode_failed,
    json_bytes_to_decimal,
    latin1_bytes,
)

quick = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
LIMIT = 10**38
getcontext().prec = 60


def expected(raw, scale, signed, precision=38):
    if not raw:
        return None
    number = int.from_bytes(raw, "big", signed=signed)
    return Decimal(number).scaleb(-scale) if abs(number) < 10**precision else None


@quick
@given(st.lists(st.one_of(st.none(), st.binary(max_size=18), st.binary(max_size=9).map(lambda b: b'\0' * 12 + b), st.binary(max_size=9).map(lambda b: b'\xff' * 11 + b)), min_size=1, max_size=40), st.booleans())
@pytest.mark.parametrize("scale", [0, 2, 18, 37])
def test_against_python(spark, scale, raws, signed):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, b binary")
    out = df.select("i", bytes_to_decimal("b", 38, scale, signed=signed).alias("d"))
    got = {r.i: r.d for r in out.collect()}
    assert got == {i: expected(r, scale, signed) for i, r in enumerate(raws)}


def test_edges(spark):
    numbers = [
        0, 1, -1, 127, 128, -128, -129, 2**63 - 1, -(2**63), 2**63, 2**64, -(2**64), 2**64 - 1,
        LIMIT - 1, -(LIMIT - 1), LIMIT, -LIMIT, 2**127 - 1, -(2**127),
    ]
    sizes = [(n, k) for n in numbers for k in (1, 2, 8, 9, 15, 16)]
    rows = []
    for n, k in sizes:
        try:
            rows.append((str(n), n.to_bytes(k, "big", signed=True)))
        except OverflowError:
            continue
    df = spark.createDataFrame(rows, "n string, b binary")
    for row in df.select("n", "b", bytes_to_decimal("b", 38, 0).alias("d")).collect():
        assert row.d == expected(bytes(row.b), 0, True), row


def test_overflow_of_the_precision(spark):
    df = spark.createDataFrame([(b"\x27\x10",), (b"\x27\x0f",)], "b binary")
    out = df.select(bytes_to_decimal("b", 4, 2).alias("d"), "b")
    assert [r.d for r in out.collect()] == [None, Decimal("99.99")]
    flags = out.select(decode_failed("b", "d")).collect()
    assert [r[0] for r in flags] == [True, False]


# Sample byte texts and the decimals they stand for.
SAMPLES = {
    "DebtRatio": ("\u00040", "10.72"),
    "MaxDTI": ("\u0005\u0014", "13.00"),
    "MaxPTI": ("\u0019d", "65.00"),
    "MonthlyDebtPayment": ("\u00041D", "2747.56"),
    "PTI": ("\u001f\u0003", "79.39"),
    "Other": ("\u0017W", "59.75"),
}


def test_json_samples(spark):
    message = {"ApplicationNumber": "6508213"} | {n: {"bytes": b} for n, (b, _) in SAMPLES.items()}
    df = spark.createDataFrame([(json.dumps({"Message": message, "Top": [1, None]}),)], "doc string")
    out = json_bytes_to_decimal(df, "doc").first()
    want = {"ApplicationNumber": "6508213"} | {n: t for n, (_, t) in SAMPLES.items()}
    assert json.loads(out.doc) == {"Message": want, "Top": [1, None]} and out.doc_ok


def test_json_keeps_the_document(spark):
    docs = [
        '{"xs": [{"a": {"bytes": "ÿ\\u0085"}}, {"a": {"bytes": "Ā"}}, {"bytes": "\\u0001"}], "n": 1.50}',
        '{"n" : 2}', None, "broken", '{"n":1} {"n":2}', "",
        '{"said": "{\\"bytes\\": \\"x\\"}", "d": { "bytes" : "" }, "o": {"bytes": 3}}',
    ]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, doc string")
    rows = [(r.doc, r.doc_ok) for r in json_bytes_to_decimal(df, "doc", {"a": (10, 1)}).orderBy("i").collect()]
    assert rows == [
        ('{"xs": [{"a": "-12.3"}, {"a": null}, "0.01"], "n": 1.50}', False), ('{"n" : 2}', True),
        (None, True), (None, False), (None, False), (None, False),
        ('{"said": "{\\"bytes\\": \\"x\\"}", "d": null, "o": {"bytes": 3}}', False),
    ]


def test_latin1(spark):
    df = spark.createDataFrame([("\x00é\xff\n",), ("Ā",), (None,)], "s string")
    got = [r[0] for r in df.select(latin1_bytes("s")).collect()]
    assert got == [b"\x00\xe9\xff\n", None, None]


SCHEMA = json.dumps({
    "type": "record", "name": "R", "fields": [
        {"name": "a", "type": {"type": "bytes", "logicalType": "decimal", "precision": 10, "scale": 2}},
        {"name": "b", "type": ["null", {"type": "bytes", "logicalType": "decimal", "precision": 20, "scale": 3}]},
        {"name": "raw", "type": "bytes"},
        {"name": "s", "type": "string"},
    ],
})


def test_convert_fields(spark):
    df = spark.createDataFrame(
        [(1, (b"\x04\x30", None, b"\x01", "x")), (2, (b"\xff\x85", b"\x01", b"\x01", "y")), (3, None)],
        "id int, avroData struct<a: binary, b: binary, raw: binary, s: string>",
    )
    beside = convert_decimal_fields(df, SCHEMA).orderBy("id").collect()
    assert [(r.a, r.b) for r in beside] == [
        (Decimal("10.72"), None), (Decimal("-1.23"), Decimal("0.001")), (None, None)
    ]
    inside = convert_decimal_fields(df, SCHEMA, in_place=True)
    kinds = {f.name: f.dataType for f in inside.schema["avroData"].dataType.fields}
    assert kinds["a"] == T.DecimalType(10, 2) and kinds["raw"] == T.BinaryType()
    assert inside.where("id = 3").first().avroData is None
    # A reader that already gives decimals is taken as it is.
    again = convert_decimal_fields(inside, SCHEMA)
    assert again.where("id = 2").first().a == Decimal("-1.23")
    with pytest.raises(ValueError, match="neither"):
        convert_decimal_fields(df, {"s": (10, 2)})
    with pytest.raises(ValueError, match="no field"):
        convert_decimal_fields(df, {"zz": (10, 2)})
