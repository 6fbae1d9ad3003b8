"""User code on columns, in Arrow batches, for what native functions cannot say."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def batch_function(
    fn: Callable[..., pd.Series], returns: T.DataType | str
) -> Callable[..., Column]:
    """A function of pandas Series as a column function; one call per Arrow batch."""

    def batch(*series: pd.Series) -> pd.Series:
        return fn(*series)

    return F.pandas_udf(batch, returns)


def value_function(fn: Callable, returns: T.DataType | str) -> Callable[[str | Column], Column]:
    """A function of one value as a column function: null in, null out, ``fn`` never sees a
    null. The rows travel in Arrow batches, and each value reaches ``fn`` as the Python value
    it is: a whole number stays one, also beside nulls."""
    import pyarrow as pa

    def batch(values: pa.Array) -> pa.Array:
        out = [None if v is None else fn(v) for v in values.to_pylist()]
        return pa.array(out, to_arrow_type(kind))

    kind = T._parse_datatype_string(returns) if isinstance(returns, str) else returns
    batch.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(batch, kind)
