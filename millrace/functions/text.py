"""Markup and JSON text as columns; all of it stays in native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.shapes import quoted

# Fixed value: what counts as a tag. Only a line feed stops the dot.
TAG = "<.*?>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_markup(col: Column | str, *, multiline: bool = False) -> Column:
    """Text without tags. By default a tag ends on its line; ``multiline`` lifts that."""
    return F.regexp_replace(_col(col), f"(?{'s' if multiline else 'd'}){TAG}", "")


def is_json(col: Column | str) -> Column:
    """Whether a text is one JSON value and nothing else, as ``from_json`` takes it; null for null.

    The parser stops after the first value and passes over the rest. Put between brackets the
    text must therefore be exactly one element, and it must pass as a member's value as well,
    which keeps out texts that close the brackets themselves. Both checks stream over the text and build nothing.
    """
    text = _col(col)
    items = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    member = F.json_object_keys(F.concat(F.lit('{"_":'), text, F.lit("}")))
    return F.when(text.isNotNull(), F.coalesce(items == 1, F.lit(False)) & member.isNotNull())


# Numbers that the parsed form cannot hold as they are written: over 38 digits, or with an
# exponent, which makes them doubles.
INEXACT = r"(?s)(?<![\w\\.])-?(?:\d[\d.]{38,}|\d[\d.]*[eE][-+]?\d)"


# A quoted string. What is left of a text without them holds no single quote in strict JSON.
STRING = r'(?s)"(?:[^"\\]|\\.)*+"'


def json_or_null(col: Column | str) -> Column:
    """JSON text in normal form (keys sorted, no blanks), or null where it is not one JSON value.

    Strings have to stand in double quotes. A text that the parsed form would change or cannot hold (long numbers,
    exponents, a key that stands twice) stays as it is written.
    """
    text = _col(col)
    strict = ~F.contains(F.regexp_replace(text, STRING, ""), F.lit("'"))
    written = F.when(strict, F.trim(text, F.lit(" \t\r\n")))
    normal = F.when(text.rlike(INEXACT), written).otherwise(F.coalesce(F.to_json(F.try_parse_json(text)), written))
    return F.when(is_json(text), normal)


def strip_and_parse(df: DataFrame, col: str, *, multiline: bool = False) -> DataFrame:
    """Strip tags from ``col`` and normalise its JSON; ``<col>_ok`` tells if it parsed.

    A null text is no error: it stays null with the flag set.
    """
    clean = json_or_null(strip_markup(col, multiline=multiline))
    staged = df.withColumns({col: clean, "_absent": F.col(col).isNull()})
    return staged.withColumn(f"{col}_ok", F.col("_absent") | F.col(col).isNotNull()).drop(
        "_absent"
    )


def json_struct(col: Column | str, schema: T.StructType | str, **options) -> Column:
    """JSON text as a struct of a given schema (``StructType`` or type text)."""
    return F.from_json(_col(col), schema, {k: str(v) for k, v in options.items()})


def inject_before_close(col: Column | str, tag: str, fragment: Column | str) -> Column:
    """Insert ``fragment`` before every closing ``tag``; a plain text replacement."""
    close = f"</{tag}>"
    piece = F.lit(fragment) if isinstance(fragment, str) else fragment
    return F.replace(_col(col), F.lit(close), F.concat(piece, F.lit(close)))


def xml_escape(col: Column | str) -> Column:
    """Text with the three characters that XML content cannot hold replaced."""
    out = _col(col).cast("string")
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(mark), F.lit(entity))
    return out


def rows_to_json(df: DataFrame, name: str = "value") -> DataFrame:
    """One JSON object text per row."""
    return df.select(F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns])).alias(name))


def result_json_array(df: DataFrame, name: str = "value") -> DataFrame:
    """The lines of a JSON array text: ``[``, one record per line, ``]``.

    Written as text, in the order of the partitions, the lines are the array. Nothing is
    brought together, however many rows there are: every record but the first has its
    separator before it, and which one is first is the least of the rows' numbers.
    """
    records = rows_to_json(df, "_json").withColumn("_row", F.monotonically_increasing_id())
    first = records.agg(F.min("_row")).scalar()
    line = F.when(F.col("_row") == first, F.col("_json")).otherwise(F.concat(F.lit(","), "_json"))
    edge = df.sparkSession.range(1, numPartitions=1)
    return (
        edge.select(F.lit("[").alias(name))
        .unionAll(records.select(line.alias(name)))
        .unionAll(edge.select(F.lit("]").alias(name)))
    )
