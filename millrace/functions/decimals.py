"""Binary decimals: big-endian two's complement bytes with a scale, as Avro holds them."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import is_json
from millrace.operators.shapes import quoted
from millrace.sources.schemas import avro_decimal_fields

MAX_BYTES = 16  # of the digits themselves: any decimal of 38 digits fits
SIGN_BYTES = "^(?:00)+(?=[0-7])|^(?:FF)+(?=[89A-F])"
ZERO_BYTES = "^(?:00)+(?=.)"
TWO_POW_64 = Decimal(2**64)


def _signed_long(digits: Column, size: Column) -> Column:
    """``size`` bytes (at most 8) given as hex digits, as a signed number: the digits' value
    moved up to the sign bit and back."""
    gap = F.lit(64) - size * 8
    raw = F.conv(digits, 16, -10).cast("bigint")
    return F.call_function("shiftright", F.call_function("shiftleft", raw, gap), gap)


def _scaled_text(number: Column, scale: int) -> Column:
    """An integer number as decimal text with an exponent, which any decimal type can read."""
    return F.concat(number.cast("string"), F.lit(f"E-{scale}"))


def bytes_to_decimal(
    col: Column | str, precision: int = 38, scale: int = 0, *, signed: bool = True
) -> Column:
    """Big-endian bytes as ``decimal(precision, scale)``.

    Null for null, for no bytes and for a value of more digits than fit. Bytes that only extend
    the sign do not count, however many there are.
    Eight bytes or fewer take one base conversion; longer ones two halves in decimal. The
    expression is kept short on purpose: a large one would not be compiled by the JVM.
    """
    value = F.col(col) if isinstance(col, str) else col
    target = T.DecimalType(precision, scale)
    digits = F.hex(value)
    digits = F.when(F.length(value) <= MAX_BYTES, digits).otherwise(
        F.regexp_replace(digits, SIGN_BYTES if signed else ZERO_BYTES, "")
    )
    size = F.call_function("shiftright", F.length(digits), F.lit(1))

    if signed:
        short = _signed_long(digits, size)
    else:
        short = F.conv(digits, 16, 10)
    if scale <= 17:
        # The product of decimal(20,0) and decimal(s,s) stays within 38 digits, hence exact.
        unit = Decimal(1).scaleb(-scale)
        short = (short.cast("decimal(20,0)") * F.lit(unit)).try_cast(target)
    else:
        short = _scaled_text(short, scale).try_cast(target)

    head = F.substring(digits, F.lit(1), F.length(digits) - 16)
    low = F.conv(F.substring(digits, -16, 16), 16, 10).cast("decimal(20,0)")
    if signed:
        # Below zero one unit moves from the low to the high half, so that the product never
        # exceeds the value itself.
        negative = F.substring(digits, 1, 1) >= "8"
        high = _signed_long(head, size - 8) + F.when(negative, 1).otherwise(0)
        low = low - F.when(negative, F.lit(TWO_POW_64)).otherwise(F.lit(Decimal(0)))
    else:
        high = F.conv(head, 16, 10)
    whole = F.try_add(F.try_multiply(high.cast("decimal(20,0)"), F.lit(TWO_POW_64)), low)
    long = _scaled_text(whole, scale).try_cast(target)
    return (
        F.when(size == 0, None)
        .when(size <= 8, short)
        .when(size <= MAX_BYTES, long)
    )


def decode_failed(raw: Column | str, decoded: Column | str) -> Column:
    """Flag of a value that was there and gave no decimal."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    decoded = F.col(decoded) if isinstance(decoded, str) else decoded
    return raw.isNotNull() & decoded.isNull()


def latin1_bytes(col: Column | str) -> Column:
    """The bytes that a JSON text carries as characters U+0000 to U+00FF; else null."""
    text = F.col(col) if isinstance(col, str) else col
    return F.when(text.rlike("(?s)^[\\x00-\\xFF]*$"), F.encode(text, "ISO-8859-1"))


def convert_decimal_fields(
    df: DataFrame,
    avro_schema: str | Mapping[str, tuple[int, int]],
    source: str = "avroData",
    *,
    in_place: bool = False,
    signed: bool = True,
) -> DataFrame:
    """Decode the decimal fields that an Avro schema names, within the struct ``source``.

    The results are new top-level columns, or replace the fields with ``in_place``. Fields
    that the reader already gave as decimals are taken as they are.
    """
    if isinstance(avro_schema, str):
        avro_schema = avro_decimal_fields(avro_schema)
    have = {f.name: f.dataType for f in df.schema[source].dataType.fields}
    out: dict[str, Column] = {}
    for name, (precision, scale) in avro_schema.items():
        if name not in have:
            raise ValueError(f"{source} has no field {name}")
        field = F.col(f"{quoted(source)}.{quoted(name)}")
        if isinstance(have[name], T.BinaryType):
            out[name] = bytes_to_decimal(field, precision, scale, signed=signed)
        elif isinstance(have[name], T.DecimalType):
            out[name] = field
        else:
            raise ValueError(f"{source}.{name} is neither binary nor decimal")
    if not in_place:
        return df.withColumns(out)
    struct = F.col(quoted(source))
    for name, col in out.items():
        struct = struct.withField(quoted(name), col)
    return df.withColumn(source, F.when(F.col(quoted(source)).isNotNull(), struct))


# A bytes object in a JSON text, with the name of its field if it has one. Quotes within
# strings are escaped, so a string that quotes such an object is not one.
TEXT = r'"((?:[^"\\]|\\.)*+)"'
BYTES_OBJECT = rf'(?s)(?:{TEXT}\s*:\s*)?\{{\s*"bytes"\s*:\s*{TEXT}\s*\}}'
BYTES_ONLY = rf'(?s)\{{\s*"bytes"\s*:\s*{TEXT}\s*\}}'


def json_bytes_to_decimal(
    df: DataFrame,
    col: str,
    scales: Mapping[str, tuple[int, int]] | None = None,
    *,
    default: tuple[int, int] = (38, 2),
    signed: bool = True,
) -> DataFrame:
    """Replace the ``{"bytes": "…"}`` objects in the JSON texts of ``col`` by decimal texts.

    All else in the text stays as it is written. ``scales`` gives precision and scale by field
    name. A value that cannot be decoded becomes ``null``, a text that is not one JSON value
    becomes null; ``<col>_ok`` is false for both, true for a null text. Each step is a projection of its own,
    so that no step is worked out once per use in the next.
    """
    scales = scales or {}

    def unescaped(text: Column) -> Column:
        return F.get_json_object(F.concat(F.lit('{"v":"'), text, F.lit('"}')), "$.v")

    def decode(found: Column) -> Column:
        raw = latin1_bytes(unescaped(found["text"]))
        number = bytes_to_decimal(raw, *default, signed=signed).cast("string")
        for name, (precision, scale) in scales.items():
            own = bytes_to_decimal(raw, precision, scale, signed=signed).cast("string")
            number = F.when(unescaped(found["name"]) == name, own).otherwise(number)
        return number

    text = F.col(quoted(col))
    names, texts = (F.regexp_extract_all(text, F.lit(BYTES_OBJECT), F.lit(i)) for i in (1, 2))
    pair = lambda name, value: F.struct(name.alias("name"), value.alias("text"))
    staged = df.withColumns({
        "_valid": is_json(text),
        "_between": F.split(text, BYTES_ONLY, -1),
        "_found": F.zip_with(names, texts, pair),
    })
    staged = staged.withColumn("_numbers", F.transform("_found", decode))
    written = F.transform("_numbers", lambda n: F.coalesce(F.concat(F.lit('"'), n, F.lit('"')), F.lit("null")))
    staged = staged.withColumn("_written", F.concat(written, F.array(F.lit(""))))
    whole = F.array_join(F.zip_with("_between", "_written", lambda a, b: F.concat(a, b)), "")
    decoded = F.forall("_numbers", lambda n: n.isNotNull())
    ok = F.when(text.isNull(), True).otherwise(F.col("_valid") & decoded)
    kept = [F.when(F.col("_valid"), whole).alias(c) if c == col else F.col(quoted(c)) for c in df.columns]
    return staged.select(*kept, ok.alias(f"{col}_ok"))
