"""Joins and the rows that hold both minima of their group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.shapes import quoted


def join_on(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Inner equi-join that keeps each shared column once.

    No hint is given: adaptive execution ships a side only if its measured size is below the
    threshold, and splits hot keys of a shuffled join otherwise.
    """
    return left.join(right, [keys] if isinstance(keys, str) else list(keys), "inner")


def group_minima(
    df: DataFrame, keys: Sequence[str], first: Column | str, second: Column | str,
    names: tuple[str, str] = ("oldest", "least"),
) -> DataFrame:
    """The two independent minima per group."""
    return df.groupBy(*keys).agg(
        F.min(first).alias(names[0]), F.min(second).alias(names[1])
    )


def parse_day(col: str, fmt: str | None) -> Column:
    """Date text by its format, or the text itself (and its order) without one.

    Text that is no such date gives null, hence takes no part in a minimum.
    """
    return F.col(col) if fmt is None else F.try_to_timestamp(F.col(col), F.lit(fmt)).cast("date")


def min_pair_match(
    df: DataFrame,
    keys: Sequence[str],
    oldest: str,
    least: str,
    *,
    fmt: str | None = None,
) -> DataFrame:
    """Rows that hold both the group's smallest ``oldest`` and its smallest ``least``.

    Ties give several rows; groups whose oldest row is not also the cheapest give none. The
    minima come from a partial hash aggregate, never from a window, so no task sees a whole
    group. The join back is on the keys and both values, which spreads the rows of a hot group
    over the tasks; what remains in one place, adaptive execution can split. The minima are
    unique, so a plain join repeats no row.
    """
    if fmt is None:
        rows, day = df, oldest
    else:
        rows, day = df.withColumn("_oldest", parse_day(oldest, fmt)), "_oldest"
    minima = group_minima(rows, keys, day, least, names=(day, least))
    return rows.join(minima, [*keys, day, least]).select(*[F.col(quoted(c)) for c in df.columns])
