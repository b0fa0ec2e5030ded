"""Request and batch checks over tables."""

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.registry import CATEGORIES


def _is_missing(df: DataFrame, name: str) -> Column:
    value, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return value.isNull() | (value == "")
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return value.isNull() | (F.size(value) == 0)
    return value.isNull()


def missing_required(requests: DataFrame, required: Sequence[str], into: str = "missing") -> DataFrame:
    """Requests lacking a required field, with the names of the null or empty ones joined by
    ``,`` in the order given."""
    checks = {name: _is_missing(requests, name) for name in required}
    # concat_ws skips the nulls of the fields that are present.
    names = F.concat_ws(",", *[F.when(bad, F.lit(name)) for name, bad in checks.items()])
    return requests.where(reduce(Column.__or__, checks.values())).withColumn(into, names)


def invalid_date_ranges(requests: DataFrame, start: str = "start_dt", end: str = "end_dt") -> DataFrame:
    """Requests whose start is after their end; equal dates are valid."""
    return requests.where(F.col(start) > F.col(end))


def route_category(rows: DataFrame, column: str = "data_cat", names: Iterable[str] = CATEGORIES) -> DataFrame:
    """Rows of a supported category."""
    return rows.where(F.col(column).isin(*names))


def unsupported_category(
    rows: DataFrame, column: str = "data_cat", names: Iterable[str] = CATEGORIES
) -> DataFrame:
    """The other rows, a NULL category among them, each with its reason."""
    supported = F.coalesce(F.col(column).isin(*names), F.lit(False))
    # Fixed value: the wording of the reason.
    reason = F.concat(F.lit("Unsupported data category: "), F.coalesce(F.col(column), F.lit("")))
    return rows.where(~supported).withColumn("reason", reason)
