"""Partitioned tables: sorted within their files, clustered across them, bucketed on a key."""

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame


def _arranged(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrame:
    """Rows of a partition value together, but a large value over several tasks: ``rebalance``
    lets Spark split it by size, where a plain repartition would give it to one task."""
    rows = df.hint("rebalance", *partition_by)
    return rows.sortWithinPartitions(*partition_by, *[c for c in sort_by if c not in partition_by])


def _bloom(writer, columns: Mapping[str, int]):
    """Parquet Bloom filters by column, each for its expected number of distinct values in a row group."""
    for name, distinct in columns.items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{name}", str(distinct))
    return writer


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str],
    mode: str = "append",
    file_type: str = "parquet",
    bloom: Mapping[str, int] | None = None,
) -> str:
    """Write ``df`` under ``path``, one directory per value of ``partition_by``, and return the path.

    ``bloom`` (column to expected distinct values) lets a lookup by equality or list skip row groups whose
    minimum and maximum say nothing, such as those of a column that the files are not sorted by.
    """
    rows = _arranged(df, partition_by, sort_by)
    _bloom(rows.write.format(file_type), bloom or {}).partitionBy(*partition_by).mode(mode).save(path)
    return path


def write_clustered(
    df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str], mode: str = "append"
) -> str:
    """Like ``write_partitioned``, but the files of a partition value hold ranges of ``sort_by`` that do not overlap, so a
    lookup reads the files of its range and skips the others.

    Rows are range-partitioned by all columns, ``partition_by`` and ``sort_by`` first: a large value is split
    over tasks by what follows it, and only a key that fills a task of its own is in more than one file.
    """
    first = [*partition_by, *[c for c in sort_by if c not in partition_by]]
    order = [*first, *[c for c in df.columns if c not in first]]
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.partitionBy(*partition_by).mode(mode).parquet(path)
    return path


def write_bucketed(
    df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int, partition_by: Sequence[str] = ()
) -> str:
    """Create the catalog table ``table`` at ``path``, bucketed on ``keys`` and sorted by them in each file. A join or merge on the
    keys reads it without a shuffle. Choose ``buckets`` so that a bucket of what one merge touches fits a task; Spark wants ``partition_by`` to
    be no key column, such as the month of a key's date."""
    rows = df.repartition(buckets, *keys).sortWithinPartitions(*partition_by, *keys)
    writer = rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)
    return table


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str], file_type: str = "parquet"
) -> str:
    """Replace the partitions that ``df`` holds and leave all others as they are."""
    rows = _arranged(df, partition_by, sort_by)
    writer = rows.write.format(file_type).partitionBy(*partition_by).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").save(path)
    return path


def replace_batch(
    df: DataFrame, root: str, batch_dt: date, partition_by: Sequence[str], sort_by: Sequence[str], file_type: str = "parquet"
) -> str:
    """Write a batch again: what its directory held goes, dates that the new rows lack too; other batches stay as they are."""
    path = f"{root.rstrip('/')}/batch_date={batch_dt:%Y%m%d}"
    rows = _arranged(df, partition_by, sort_by).write.format(file_type).partitionBy(*partition_by)
    rows.mode("overwrite").option("partitionOverwriteMode", "static").save(path)
    return path
