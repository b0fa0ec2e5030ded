"""Which request a record came from, read off the path of its file."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.registry import Category
from tidewell.schemas import envelope_schema
from tidewell.sources.envelopes import json_options

# Fixed value: the layout of a batch key, <category>_<start>_<end>_<batch>; its dates stand at fixed places from the end.
STEM = r"/batch_key=([^/]+_\d{8}_\d{8}_\d{8})(?:/|$)"
KEY = r"/batch_key=([^/]+)"


def _searched(path: Column) -> list[Column]:
    return [F.regexp_extract(path, STEM, 1).alias("_stem"), F.regexp_extract(path, KEY, 1).alias("_key")]


def _parts(stem: Column, key: Column) -> Column:
    def day(start: int) -> Column:
        year, month, of_month = F.substring(stem, start, 4), F.substring(stem, start + 4, 2), F.substring(stem, start + 6, 2)
        return F.concat(year, F.lit("-"), month, F.lit("-"), of_month).try_cast("date")

    return F.struct(
        F.when(stem != "", F.substring(stem, F.lit(1), F.length(stem) - 27)).alias("data_cat"), day(-26).alias("start_dt"),
        day(-17).alias("end_dt"), day(-8).alias("batch_dt"), F.when(key != "", key).alias("batch_key"),
    )


def path_lineage(path: Column) -> Column:
    """struct<data_cat, start_dt, end_dt, batch_dt, batch_key> of a file's path, all NULL where it has no batch key."""
    return F.transform(F.array(F.struct(*_searched(path))), lambda found: _parts(found["_stem"], found["_key"]))[0]


def read_with_lineage(spark: SparkSession, root: str, cat: Category, multi_line: bool = False) -> DataFrame:
    """Landed documents of all batches, with what their paths say and the path itself. Every row asks for its file's path,
    so that is searched in columns of their own, once a row and not once for every part."""
    schema = envelope_schema(cat.record, cat.envelope_field)
    rows = spark.read.schema(schema).options(**json_options(multi_line), recursiveFileLookup="true").json(root)
    path = F.col("_metadata.file_path")
    rows = rows.select("*", path.alias("file_path"), *_searched(path))
    return rows.withColumn("_l", _parts(F.col("_stem"), F.col("_key"))).select(*schema.fieldNames(), "_l.*", "file_path")
