"""Raw envelopes to typed rows: one narrow chain, no shuffle and no Python in the rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.registry import Category


def explode_records(envelopes: DataFrame, field: str = "data", keep: Sequence[str] = ()) -> DataFrame:
    """One row per array element; a null or empty array gives none."""
    return envelopes.select(*keep, F.explode(field).alias("record"))


def flatten_records(exploded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return exploded.select(*keep, "record.*")


def rename_columns(records: DataFrame, cat: Category) -> DataFrame:
    return records.withColumnsRenamed(cat.renames)


def drop_missing_essentials(records: DataFrame, cat: Category) -> DataFrame:
    return records.dropna(how="any", subset=list(cat.essentials))


def fill_defaults(records: DataFrame, cat: Category) -> DataFrame:
    return records.fillna(cat.defaults) if cat.defaults else records


def cast_dates(records: DataFrame, cat: Category) -> DataFrame:
    """Date columns to DATE, without their time of day; text that is no date becomes NULL."""
    return records.withColumns({c: F.col(c).try_cast("date") for c in cat.dates})


def arrange(records: DataFrame, cat: Category, keep: Sequence[str] = ()) -> DataFrame:
    return records.select(*keep, *cat.columns)


def prepare(envelopes: DataFrame, cat: Category, keep: Sequence[str] = ()) -> DataFrame:
    """Everything up to the casts: renamed records with all essentials, dates still text."""
    records = flatten_records(explode_records(envelopes, cat.envelope_field, keep), keep)
    return fill_defaults(drop_missing_essentials(rename_columns(records, cat), cat), cat)


def clean(envelopes: DataFrame, cat: Category, keep: Sequence[str] = ()) -> DataFrame:
    """The whole transform. The null check precedes the casts, so a malformed essential date
    survives as NULL; ``quarantine_bad_dates`` takes such rows out."""
    return arrange(cast_dates(prepare(envelopes, cat, keep), cat), cat, keep)


def _bad_date(cat: Category) -> Column:
    dates = [c for c in cat.essentials if c in cat.dates]
    bad = F.lit(False)
    for name in dates:
        bad = bad | F.col(name).try_cast("date").isNull()
    return bad


def quarantine_bad_dates(prepared: DataFrame, cat: Category) -> tuple[DataFrame, DataFrame]:
    """Split prepared records into (usable, malformed essential date). The malformed side
    keeps its text. Accepted plus rejected is the input."""
    return prepared.where(~_bad_date(cat)), prepared.where(_bad_date(cat))
