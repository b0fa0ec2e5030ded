"""Batch file names and paths as column expressions. The layouts of names and directories."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.calendar import compact_date


def batch_stem(data_cat: Column, batch_dt: Column, start_dt: Column, end_dt: Column) -> Column:
    """``<category>_<start>_<end>_<batch>``, category in lower case."""
    return F.concat(
        F.lower(data_cat), F.lit("_"), compact_date(start_dt), F.lit("_"),
        compact_date(end_dt), F.lit("_"), compact_date(batch_dt),
    )


def batch_file(
    data_cat: Column, batch_dt: Column, start_dt: Column, end_dt: Column, extension: Column
) -> Column:
    return F.concat(batch_stem(data_cat, batch_dt, start_dt, end_dt), F.lit("."), F.lower(extension))


def batch_dir(batch_dt: Column, bucket: Column, directory: Column, scheme: str) -> Column:
    """``<scheme><bucket>/<directory>/batch_date=YYYYMMDD/``."""
    return F.concat(
        F.lit(scheme), bucket, F.lit("/"), directory, F.lit("/batch_date="),
        compact_date(batch_dt), F.lit("/"),
    )


def batch_path(
    batch_dt: Column, bucket: Column, directory: Column, file_name: Column, scheme: str
) -> Column:
    return F.concat(batch_dir(batch_dt, bucket, directory, scheme), file_name)
