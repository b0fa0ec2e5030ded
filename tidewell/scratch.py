"""Where a job may put intermediate tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new directory name under the shared folder of ``spark.checkpoint.dir``.

    Directories are grouped by application, so a finished application's can be dropped.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/tidewell/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as parquet in the shared folder and read back: later readers do not
    compute it again, and a lost executor takes nothing of it away."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
