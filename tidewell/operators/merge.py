"""Keyed upsert of a batch into a partitioned parquet table.

A matched target row takes all columns of its staging row, an unmatched staging row is inserted,
an unmatched target row stays. A key may occur once in staging. A row with a NULL key part can match
nothing and would be inserted again by every merge, so such rows are split off before the merge.

On plain parquet there is no snapshot: a reader running while the job commits can see some
partitions before and some after the merge, two writers must not merge at once, and a driver lost during the
commit can leave a touched partition removed and not yet replaced: merge the batch again from its silver files
onto a restored copy. A lost executor only repeats its tasks.
"""

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.registry import Category
from tidewell.sinks import replace_partitions, write_rejects
from tidewell.scratch import stored
from tidewell.sources import read_table_or_none


@dataclass(frozen=True)
class MergeResult:
    inserted: int
    updated: int
    rejected: int


def _keyed(keys: Sequence[str]) -> Column:
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    return whole


def split_null_keys(staging: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a whole key, rows with a NULL key part)."""
    return staging.where(_keyed(keys)), staging.where(~_keyed(keys))


def matched(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The replaced rows: staging columns for every target row with the same key."""
    return target.select(*keys).join(staging, list(keys)).select(*staging.columns)


def not_matched(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staging rows to insert."""
    return staging.join(target.select(*keys), list(keys), "left_anti")


def duplicate_keys(staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staging keys that break the one-row rule, with their number of rows."""
    whole, _ = split_null_keys(staging, keys)
    return whole.groupBy(*keys).agg(F.count("*").alias("staging_rows")).where("staging_rows > 1")


def joined(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target and staging met once on the key: the merged row's columns, ``_staged`` and ``_existing``.

    A key staged twice fails the job where the row is made, before anything is committed. Columns that staging lacks keep what the
    target has.
    """
    rest = [c for c in target.columns if c not in keys]
    given = [c for c in rest if c in staging.columns]
    whole, _ = split_null_keys(staging, keys)
    staged = whole.groupBy(*keys).agg(F.count("*").alias("_n"), F.max(F.struct(F.lit(0).alias("_"), *given)).alias("_new"))
    message = F.concat(F.lit("staged more than once: "), F.to_json(F.struct(*keys)))
    once = staged.select(*keys, F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col("_new")).alias("_new"))
    existing = target.select(*keys, F.struct(F.lit(0).alias("_"), *rest).alias("_old"))
    both = existing.join(once, list(keys), "full_outer")
    staged_row, old_row = F.col("_new"), F.col("_old")
    value = {c: F.when(staged_row.isNotNull(), staged_row[c]).otherwise(old_row[c]) if c in given else old_row[c] for c in rest}
    return both.select(
        *keys, *[value[c].alias(c) for c in rest],
        F.col("_new").isNotNull().alias("_staged"), F.col("_old").isNotNull().alias("_existing"),
    )


def upsert(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after the merge."""
    return joined(target, staging, keys).select(*target.columns)


def _counts() -> list[Column]:
    staged, existing = F.col("_staged"), F.col("_existing")
    return [F.count_if(staged & ~existing).alias("inserted"), F.count_if(staged & existing).alias("updated")]


def merge_metrics(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``inserted`` and ``updated`` rows of the merge, and ``rejected`` rows with a NULL key part."""
    _, rejects = split_null_keys(staging, keys)
    counts = joined(target, staging, keys).agg(*_counts()).withColumn("rejected", F.lit(0).cast("long"))
    lost = rejects.agg(
        F.lit(0).cast("long").alias("inserted"), F.lit(0).cast("long").alias("updated"), F.count("*").alias("rejected")
    )
    return counts.unionByName(lost).agg(*[F.sum(c).alias(c) for c in ("inserted", "updated", "rejected")])


def latest_per_key(rows: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``newest_by`` and then by every other column, NULL
    lowest. A maximum is combined before the shuffle, so a key with very many copies does
    not gather in one task as it would under a window. Rows with a NULL key part are no
    copies of each other and all stay."""
    if both := set(newest_by) & set(keys):
        raise ValueError(f"newest_by names key columns: {sorted(both)}")
    rest = [c for c in rows.columns if c not in keys and c not in newest_by]
    whole, others = split_null_keys(rows, keys)
    best = (
        whole.groupBy(*keys)
        .agg(F.max(F.struct(*newest_by, *rest)).alias("best"))
        .select(*keys, "best.*")
    )
    return best.select(*rows.columns).unionByName(others)


def affected_slice(target: DataFrame, staging: DataFrame, partition: str) -> DataFrame:
    """The target's partitions that staging touches, as a literal list that prunes directories at planning time. The list
    is as long as the directories the merge is about to write, which the planner of the target holds anyway."""
    touched = [row[0] for row in staging.select(partition).where(F.col(partition).isNotNull()).distinct().collect()]
    return target.where(F.col(partition).isin(touched))


def evolved(cat: Category, staging: T.StructType) -> Category:
    """The category with the columns that staging brings beyond it, at the end of its output. Merge with it, and keep it: files written
    before the merge read such a column as NULL, and partitions that no staged row falls in are not rewritten. A column that
    changes its type is refused."""
    known = {f.name: f for f in cat.output}
    for field in staging:
        if field.name in known and field.dataType != known[field.name].dataType:
            raise ValueError(f"{field.name} is {known[field.name].dataType.simpleString()}, staged as {field.dataType.simpleString()}")
    new = [T.StructField(f.name, f.dataType) for f in staging if f.name not in known]
    return replace(cat, output=T.StructType([*cat.output.fields, *new]))


def merge_into_bucketed(spark: SparkSession, table: str, staging: DataFrame, cat: Category, buckets: int) -> MergeResult:
    """Merge staging into a table that ``write_bucketed`` made with as many ``buckets`` on the category's key. Staging is dealt out to
    the table's buckets, so the table itself is read where it lies, without a shuffle; only touched partitions are read and
    rewritten. Rows with a NULL key part are counted and left out."""
    keys = list(cat.key)
    staging = stored(staging.select(*cat.columns), "merge-staging")
    whole, rejects = split_null_keys(staging, keys)
    target = spark.read.table(table)
    written = Observation("merge")
    merged = bucketed_join(affected_slice(target, whole, cat.partition), whole, keys, buckets).observe(written, *_counts())
    # The order of the table's own columns, its partition last; its buckets are those the rows are in.
    rows = merged.select(*target.columns).sortWithinPartitions(cat.partition, *keys)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    return MergeResult(written.get["inserted"], written.get["updated"], rejects.count())


def bucketed_join(target: DataFrame, staging: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``joined`` with staging dealt out like the target's buckets."""
    return joined(target, staging.repartition(buckets, *keys), keys)


def merge_into_path(
    spark: SparkSession,
    path: str,
    staging: DataFrame,
    cat: Category,
    on_duplicate: str = "error",
    newest_by: Sequence[str] = (),
    rejects_path: str | None = None,
) -> MergeResult:
    """Merge staging into the parquet table at ``path`` and rewrite only touched partitions.

    ``on_duplicate`` is ``"error"``, which fails before anything is committed, or ``"latest"``, which keeps one row
    per key. Columns are taken by name; one that staging lacks keeps what the target has, or is NULL in an inserted row. Rows with a NULL key part are counted and, with ``rejects_path``, appended there.
    """
    keys = list(cat.key)
    if on_duplicate == "latest":
        staging = latest_per_key(staging, keys, newest_by)
    elif on_duplicate != "error":
        raise ValueError(f"on_duplicate must be 'error' or 'latest', not {on_duplicate!r}")
    # Read for the partition list, the rejects and the write, so computed once.
    staging = stored(staging.select(*[c for c in cat.columns if c in staging.columns]), "merge-staging")
    whole, rejects = split_null_keys(staging, keys)
    rejected = rejects.count()
    if rejected and rejects_path:
        write_rejects(rejects, rejects_path)

    target = read_table_or_none(spark, path, cat.output)
    if target is None:
        target = spark.createDataFrame([], cat.output)
    current = affected_slice(target, whole, cat.partition)
    written = Observation("merge")
    merged = joined(current, whole, keys).observe(written, *_counts()).select(*cat.columns)
    # Dynamic overwrite swaps the touched partitions in at job commit; until then the files being read stay in place.
    replace_partitions(merged, path, [cat.partition], sort_by=[k for k in keys if k != cat.partition])
    return MergeResult(written.get["inserted"], written.get["updated"], rejected)
