"""Reading batches and tables laid out as ``<root>/batch_date=YYYYMMDD/...``."""

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.sinks import write_partitioned

BATCH_COLUMN = "batch_date"


def batch_location(root: str, batch_dt: date) -> str:
    return f"{root.rstrip('/')}/{BATCH_COLUMN}={batch_dt:%Y%m%d}"


def with_batch_column(schema: T.StructType) -> T.StructType:
    """The directory value ``20240105`` is read as an INT."""
    return T.StructType([*schema.fields, T.StructField(BATCH_COLUMN, T.IntegerType())])


def as_batch_date(schema: T.StructType):
    """Columns of ``schema`` with ``batch_dt`` as a DATE made from the directory value."""
    batch_dt = F.to_date(F.col(BATCH_COLUMN).cast("string"), "yyyyMMdd").alias("batch_dt")
    return [batch_dt, *schema.fieldNames()]


def read_batch(
    spark: SparkSession, root: str, batch_dt: date, schema: T.StructType, file_type: str = "parquet", **options
) -> DataFrame:
    """One batch. Only its own directory is listed, however many batches the root holds."""
    reader = spark.read.format(file_type).schema(with_batch_column(schema)).option("basePath", root)
    df = reader.options(**options).load(batch_location(root, batch_dt))
    return df.select(*as_batch_date(schema))


def read_batches(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    first: date | None = None,
    last: date | None = None,
    file_type: str = "parquet",
    **options,
) -> DataFrame:
    """All batches, or those between two batch dates, pruned by directory."""
    df = spark.read.format(file_type).schema(with_batch_column(schema)).options(**options).load(root)
    if first is not None:
        df = df.where(F.col(BATCH_COLUMN) >= int(f"{first:%Y%m%d}"))
    if last is not None:
        df = df.where(F.col(BATCH_COLUMN) <= int(f"{last:%Y%m%d}"))
    return df.select(*as_batch_date(schema))


def read_table_or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The parquet table at ``path`` in ``schema`` order, or None where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def load_staging(
    spark: SparkSession,
    silver_root: str,
    batch_dt: date,
    staging_path: str,
    schema: T.StructType,
    partition: str,
    sort_by: list[str],
    save_mode: str = "overwrite",
) -> None:
    """All files of a silver batch into the staging table; ``overwrite`` empties it first."""
    rows = read_batch(spark, silver_root, batch_dt, schema).select(*schema.fieldNames())
    write_partitioned(rows, staging_path, [partition], sort_by, mode=save_mode)
