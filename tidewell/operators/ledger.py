"""Run ledger: an append-only parquet table with one row per (data_cat, batch_dt).

Plain files give no lock: let one writer at a time register batches.
"""

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewell.schemas import LEDGER, WAITING
from tidewell.sources import read_table_or_none

KEY = ["data_cat", "batch_dt"]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, or an empty one before its first row."""
    found = read_table_or_none(spark, path, LEDGER)
    return spark.createDataFrame([], LEDGER) if found is None else found


def ledger_lookup(ledger: DataFrame, data_cat: str, batch_dt: date) -> DataFrame:
    return ledger.where((F.col("data_cat") == data_cat) & (F.col("batch_dt") == F.lit(batch_dt)))


def ledger_counts(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy(*KEY).agg(F.count("*").alias("runs"))


def new_batches(batches: DataFrame, ledger: DataFrame) -> DataFrame:
    """Batches (data_cat, batch_dt, start_dt, end_dt) the ledger does not hold yet."""
    return batches.join(ledger.select(*KEY), KEY, "left_anti")


def waiting_rows(batches: DataFrame, start_time: datetime | Column | None = None) -> DataFrame:
    """A ledger row in state WAITING per batch. A batch asked for twice in one call is entered
    once, with its earliest range."""
    if start_time is None:
        started = F.current_timestamp()
    else:
        started = start_time if isinstance(start_time, Column) else F.lit(start_time)
    once = batches.groupBy(*KEY).agg(F.min(F.struct("start_dt", "end_dt")).alias("dates"))
    status = F.lit(WAITING)
    return once.select(
        *KEY, "dates.start_dt", "dates.end_dt",
        status.alias("extract_status"), status.alias("transform_status"), status.alias("load_status"),
        started.cast("timestamp").alias("start_time"),
        F.lit(None).cast("timestamp").alias("end_time"),
    )


def insert_waiting(
    spark: SparkSession, path: str, batches: DataFrame, start_time: datetime | Column | None = None
) -> int:
    """Append the batches not yet in the ledger and return how many rows were written."""
    written = Observation("ledger rows")
    rows = waiting_rows(new_batches(batches, read_ledger(spark, path)), start_time)
    rows.observe(written, F.count("*").alias("rows")).write.mode("append").parquet(path)
    return written.get["rows"]
