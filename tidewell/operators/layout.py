"""How a table lies in its files, read from the files themselves."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_ranges(table: DataFrame, partition: str, column: str) -> DataFrame:
    """A row per file and partition value: rows, and the smallest and largest value of ``column``. ``table`` is a file scan."""
    rows = table.select(partition, column, F.col("_metadata.file_path").alias("file"))
    return rows.groupBy(partition, "file").agg(
        F.count("*").alias("rows"), F.min(column).alias("low"), F.max(column).alias("high")
    )


def clustering(table: DataFrame, partition: str, column: str) -> DataFrame:
    """Per partition value its rows, its files, and the files whose range begins before that of an earlier one has ended: none
    where files hold ranges of their own, which may touch in a value. Windows run over files, not rows."""
    earlier = Window.partitionBy(partition).orderBy("low", "high", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = file_ranges(table, partition, column).withColumn("ended", F.max("high").over(earlier))
    return files.groupBy(partition).agg(
        F.sum("rows").alias("rows"), F.count("*").alias("files"), F.count_if(F.col("low") < F.col("ended")).alias("overlapping"),
    )


def partition_counts(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str]) -> DataFrame:
    """Rows per partition value, added up from the footers of the parquet files: no column is read.

    The push-down belongs to Spark's second file reader, which a session of its own uses, so the caller's settings stay as they are.
    """
    reader = spark.newSession()
    reader.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return reader.read.schema(schema).parquet(path).groupBy(*partition_by).agg(F.count("*").alias("rows"))
