"""Data categories as data: a new category is a new entry, not new code."""

from dataclasses import dataclass

from pyspark.sql import types as T

from tidewell.schemas import RAW_RECORD, SILVER


class UnsupportedCategory(ValueError):
    """Raised for a data category that has no registry entry."""


@dataclass(frozen=True)
class Category:
    name: str
    record: T.StructType
    output: T.StructType
    renames: dict[str, str]
    essentials: tuple[str, ...]
    defaults: dict[str, str]
    dates: tuple[str, ...]
    key: tuple[str, ...]
    partition: str
    envelope_field: str = "data"

    @property
    def columns(self) -> list[str]:
        return self.output.fieldNames()


# The dividends mapping.
DIVIDENDS = Category(
    name="dividends",
    record=RAW_RECORD,
    output=SILVER,
    renames={
        "dividend": "dividend_ratio",
        "date": "market_dt",
        "payment_date": "payment_dt",
        "record_date": "record_dt",
        "declaration_date": "declar_dt",
    },
    essentials=("symbol", "market_dt", "dividend_ratio"),
    defaults={"distr_freq": "Unknown"},
    dates=("market_dt", "payment_dt", "record_dt", "declar_dt"),
    key=("symbol", "market_dt"),
    partition="market_dt",
)

#: A second category: stock splits. Supported where a caller asks for it.
SPLITS = Category(
    name="splits",
    record=T.StructType([
        T.StructField("symbol", T.StringType()), T.StructField("date", T.StringType()),
        T.StructField("from", T.DoubleType()), T.StructField("to", T.DoubleType()), T.StructField("kind", T.StringType()),
    ]),
    output=T.StructType([
        T.StructField("symbol", T.StringType()), T.StructField("market_dt", T.DateType()),
        T.StructField("ratio_from", T.DoubleType()), T.StructField("ratio_to", T.DoubleType()), T.StructField("kind", T.StringType()),
    ]),
    renames={"date": "market_dt", "from": "ratio_from", "to": "ratio_to"},
    essentials=("symbol", "market_dt", "ratio_to"),
    defaults={"kind": "Unknown"},
    dates=("market_dt",),
    key=("symbol", "market_dt"),
    partition="market_dt",
)

CATEGORIES = {c.name: c for c in (DIVIDENDS,)}


def category(name: str) -> Category:
    try:
        return CATEGORIES[name]
    except KeyError:
        raise UnsupportedCategory(f"unsupported data category: {name!r}") from None
