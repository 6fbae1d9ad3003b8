"""Aggregations given as a text spec such as ``sum(a)|min(b)``."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.shapes import quoted

# The separator and form of a spec item.
SEPARATOR = "|"
ITEM = r"^\s*(\w+)\s*\(\s*([^()]+?)\s*\)\s*$"
CALL = r"^\s*(\w+)\s*\(\s*(.+?)\s*\)\s*$"
# What an argument may be beyond a column: numbers, field paths and arithmetic.
EXPRESSION = r"[\w\s.()+*/%-]+"
ROOT = r"(?<![\w.])([A-Za-z_]\w*)(?:\.\w+)*"

# The functions a spec may name.
FUNCTIONS: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "avg": F.avg,
    "count": F.count,
    "first": None,
    "last": None,
    "stddev": F.stddev,
    "variance": F.variance,
}


@dataclass(frozen=True)
class SpecItem:
    """One parsed item of a spec."""

    text: str
    func: str
    column: str


class SpecError(ValueError):
    """A spec item cannot be read or names an unknown function or column."""


def parse_spec(spec: str, on_unknown: str = "raise") -> list[SpecItem]:
    """The items of a spec. ``on_unknown="skip"`` passes over items that name no known
    function or have another form."""
    if on_unknown not in ("raise", "skip"):
        raise ValueError("on_unknown is 'raise' or 'skip'")
    items = []
    for text in spec.split(SEPARATOR):
        found = re.match(CALL, text)
        func = found and found.group(1).lower()
        if found and func in FUNCTIONS:
            items.append(SpecItem(text.strip(), func, found.group(2).strip("`")))
        elif on_unknown == "raise":
            raise SpecError(f"cannot use spec item {text.strip()!r}")
    return items


def _aggregate(item: SpecItem, columns: Sequence[str], order_by: str | Column | None) -> Column:
    col = F.lit(1) if item.column == "*" else _argument(item.column, columns)
    if item.func in ("first", "last"):
        if order_by is None:
            raise SpecError(f"{item.func} depends on row order: give order_by")
        pick = F.min_by if item.func == "first" else F.max_by
        return pick(col, order_by)
    return FUNCTIONS[item.func](col)


def _argument(text: str, columns: Sequence[str]) -> Column | None:
    """A column by its name; else a nested field or an arithmetic expression over such.

    An expression is names, numbers, brackets and ``+ - * / %``, nothing else; null for a text of
    another form.
    """
    if text.lower() in {c.lower() for c in columns}:
        return F.col(quoted(text))
    roots = [quoted(r).strip("`").lower() for r in re.findall(ROOT, text)]
    known = {c.lower() for c in columns}
    if not re.fullmatch(EXPRESSION, text) or not roots or not known.issuperset(roots):
        return None
    return F.expr(text)


def _alias(items: Sequence[SpecItem], style: str) -> list[str]:
    names = {
        "raw": [i.text for i in items],
        "func": [i.func for i in items],
        "positional": [f"col{n}" for n, _ in enumerate(items, 1)],
        "snake": [f"{i.func}_{'all' if i.column == '*' else i.column}" for i in items],
    }
    if style not in names:
        raise ValueError(f"alias is one of {', '.join(names)}")
    twice = [n for n, k in Counter(names[style]).items() if k > 1]
    if twice:
        raise SpecError(f"alias style {style!r} repeats {', '.join(twice)}")
    return names[style]


def spec_columns(
    df: DataFrame,
    spec: str,
    *,
    alias: str = "raw",
    order_by: str | Column | None = None,
    on_unknown: str = "raise",
) -> list[Column]:
    """The aggregate columns of a spec, checked against ``df`` and named in one of the styles
    ``raw`` (item text), ``func``, ``positional`` (``col1``…) or ``snake`` (``sum_a``)."""
    items = parse_spec(spec, on_unknown)
    absent = [i for i in items if i.column != "*" and _argument(i.column, df.columns) is None]
    if absent and on_unknown == "raise":
        raise SpecError(f"no column for {', '.join(i.text for i in absent)}")
    items = [i for i in items if i not in absent]
    if not items:
        raise SpecError("the spec holds no usable item")
    return [
        _aggregate(i, df.columns, order_by).alias(n) for i, n in zip(items, _alias(items, alias), strict=True)
    ]


def agg_spec(
    df: DataFrame,
    spec: str,
    *,
    alias: str = "raw",
    group_by: Sequence[str] = (),
    order_by: str | Column | None = None,
    on_unknown: str = "raise",
) -> DataFrame:
    """Aggregate by a spec, over all rows or per group.

    Every function of the list reduces within the tasks first, so the shuffle carries one row
    per task and group, however many rows a group has.
    """
    cols = spec_columns(df, spec, alias=alias, order_by=order_by, on_unknown=on_unknown)
    return df.groupBy(*group_by).agg(*cols) if group_by else df.agg(*cols)


def agg_attach(
    df: DataFrame,
    spec: str,
    *,
    order_by: str | Column | None = None,
    on_unknown: str = "raise",
) -> DataFrame:
    """All columns of ``df`` plus the global aggregates of the spec, as doubles, on every row.

    The aggregates are one scalar subquery, so no row moves for them; the columns are named
    ``<func>_<col>``.
    """
    cols = spec_columns(df, spec, alias="snake", order_by=order_by, on_unknown=on_unknown)
    one = df.agg(*cols)
    names = one.columns
    clash = [n for n in names if n in df.columns]
    if clash:
        raise SpecError(f"the frame already has {', '.join(clash)}")
    packed = one.select(F.struct(*[F.col(quoted(n)).cast("double").alias(n) for n in names]))
    return df.withColumn("_all", packed.scalar()).select(
        *[F.col(quoted(c)) for c in df.columns], *[F.col("_all")[n].alias(n) for n in names]
    )


def pack_struct(df: DataFrame, name: str = "datacontrols") -> DataFrame:
    """All columns packed to one struct, beside the originals."""
    return df.withColumn(name, F.struct(*[F.col(quoted(c)) for c in df.columns]))


def control_record(
    df: DataFrame, spec: str, *, alias: str = "raw", order_by: str | Column | None = None
) -> DataFrame:
    """The spec's global aggregates, the struct ``datacontrols`` of them, and ``control_json``,
    the JSON array text with that one record."""
    out = pack_struct(agg_spec(df, spec, alias=alias, order_by=order_by))
    record = F.to_json(F.struct(*[F.col(quoted(c)) for c in out.columns]))
    return out.withColumn("control_json", F.concat(F.lit("["), record, F.lit("]")))


def spec_items(df: DataFrame, col: str = "spec") -> DataFrame:
    """Specs held in a table, one row per item: other columns, ``pos``, ``func``, ``column``.

    ``valid`` tells whether the item has the form ``func(column)``; the two parts are cut at
    the brackets, trimmed, and null where it has not.
    """
    keep = [c for c in df.columns if c != col]
    text = F.col("_item")
    valid = text.rlike(ITEM)
    func = F.lower(F.trim(F.substring_index(text, "(", 1)))
    column = F.trim(F.substring_index(F.substring_index(text, "(", -1), ")", 1))
    return df.select(
        *keep, F.posexplode(F.split(F.col(col), re.escape(SEPARATOR))).alias("pos", "_item")
    ).select(
        *keep,
        "pos",
        F.when(valid, func).alias("func"),
        F.when(valid, column).alias("column"),
        valid.alias("valid"),
    )
