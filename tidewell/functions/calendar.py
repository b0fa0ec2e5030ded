"""Week bounds and date formats, date in and date (or text) out: no time zone is involved."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_monday(day: Column) -> Column:
    """Monday of the Monday-first week; a Sunday belongs to the week before it."""
    return F.trunc(day.cast("date"), "week")


def week_friday(day: Column) -> Column:
    return F.date_add(week_monday(day), 4)


def compact_date(day: Column) -> Column:
    """``YYYYMMDD``."""
    return F.date_format(day.cast("date"), "yyyyMMdd")


def iso_date(day: Column) -> Column:
    """``YYYY-MM-DD``."""
    return F.date_format(day.cast("date"), "yyyy-MM-dd")
