"""All categories' documents to their tables in one pass."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.cleanse import clean
from tidewell.registry import CATEGORIES, Category
from tidewell.schemas import CORRUPT
from tidewell.sources.documents import decode_documents

REJECTS = "_rejects"


def with_destination(rows: DataFrame, names: Iterable[str] = CATEGORIES, column: str = "data_cat") -> DataFrame:
    """``rows`` with where each goes: its category, or ``_rejects``."""
    supported = F.coalesce(F.col(column).isin(*names), F.lit(False))
    return rows.withColumn("destination", F.when(supported, F.col(column)).otherwise(REJECTS))


def fan_out(rows: DataFrame, root: str, names: Iterable[str] = CATEGORIES, column: str = "data_cat", mode: str = "append") -> str:
    """Write each row under ``<root>/destination=<category>``, rows of no supported category (a NULL one too) under ``_rejects``: one
    read and one write for all of them, and a large category over several tasks."""
    going = with_destination(rows, names, column).hint("rebalance", "destination")
    going.write.partitionBy("destination").mode(mode).parquet(root)
    return root


def routed(spark: SparkSession, root: str, destination: str) -> DataFrame:
    """What was routed to one destination; only its directory is read."""
    return spark.read.parquet(root).where(F.col("destination") == destination).drop("destination")


def clean_routed(
    spark: SparkSession, root: str, categories: Mapping[str, Category] = CATEGORIES, text: str = "value", keep: tuple[str, ...] = ()
) -> dict[str, DataFrame]:
    """Per category its routed documents, decoded and cleaned by the category's own entry."""
    cleaned = {}
    for name, cat in categories.items():
        documents = decode_documents(routed(spark, root, name).select(*keep, text), cat, text)
        cleaned[name] = clean(documents.drop(CORRUPT), cat, keep)
    return cleaned
