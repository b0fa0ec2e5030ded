"""Raw documents to JSON Lines, and the ones that do not parse to a rejects table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.calendar import compact_date
from tidewell.schemas import CORRUPT
from tidewell.scratch import stored


def land_envelopes(envelopes: DataFrame, root: str, batch: str = "batch_dt", mode: str = "append") -> str:
    """Land one document per line under ``<root>/batch_date=YYYYMMDD``. Documents of one batch
    may lie in many files; a large batch is split over tasks by size."""
    rows = envelopes.withColumn("batch_date", compact_date(F.col(batch))).drop(batch)
    rows = rows.drop(CORRUPT).hint("rebalance", "batch_date")
    rows.write.partitionBy("batch_date").mode(mode).json(root)
    return root


def land_batches(envelopes: DataFrame, root: str, stem: Column, batch: str = "batch_dt", mode: str = "append") -> str:
    """Land documents under ``<root>/batch_date=YYYYMMDD/batch_key=<stem>``, so each file's path says which request it answers;
    ``read_with_lineage`` reads it back."""
    rows = envelopes.withColumns({"batch_date": compact_date(F.col(batch)), "batch_key": stem}).drop(batch, CORRUPT)
    rows.hint("rebalance", "batch_date", "batch_key").write.partitionBy("batch_date", "batch_key").mode(mode).json(root)
    return root


def split_documents(envelopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents that parsed, documents that did not, with their text). Parsed plus corrupt is the input. Documents are
    parsed once and stored, so both sides can be read alone: Spark refuses a file query on the corrupt column only."""
    documents = stored(envelopes, "documents")
    corrupt = F.col(CORRUPT)
    return documents.where(corrupt.isNull()).drop(CORRUPT), documents.where(corrupt.isNotNull())


def write_rejects(rejects: DataFrame, path: str, mode: str = "append") -> str:
    rejects.write.mode(mode).parquet(path)
    return path
