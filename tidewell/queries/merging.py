"""The keyed upsert, by part and as a real write."""

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators import cleanse, merge
from tidewell.queries.inputs import CLEAN, MERGE, envelopes, merge_sides
from tidewell.registry import DIVIDENDS
from tidewell.scratch import scratch_dir
from tidewell.sinks import write_bucketed, write_partitioned

KEYS = list(DIVIDENDS.key)


def _clean(spark, sf_dir):
    return cleanse.clean(envelopes(spark, sf_dir), DIVIDENDS)


def _by_month(rows):
    """The merge queries keep their target by month, so that a write makes tens of directories, not thousands."""
    return rows.withColumn("month", F.trunc("market_dt", "month"))


def _on_sides(operator):
    return lambda spark, sf_dir: operator(*merge_sides(_clean(spark, sf_dir)), KEYS)


#: The category with its target by month.
MONTHLY = replace(DIVIDENDS, output=T.StructType([*DIVIDENDS.output.fields, T.StructField("month", T.DateType())]), partition="month")
BUCKETS = 8


def _merged(spark, sf_dir, sides=None):
    """Write the target, merge staging into it, and give the path and the result."""
    target, staging = map(_by_month, sides or merge_sides(_clean(spark, sf_dir)))
    cat = MONTHLY
    path = scratch_dir(spark, "merge-target")
    write_partitioned(target, path, ["month"], ["symbol", "market_dt"])
    return path, cat, merge.merge_into_path(spark, path, staging, cat)


def merge_upsert(spark, sf_dir):
    path, cat, _ = _merged(spark, sf_dir)
    return spark.read.schema(cat.output).parquet(path).select(*DIVIDENDS.columns)


def merge_metrics(spark, sf_dir):
    target, staging = merge_sides(_clean(spark, sf_dir))
    _, _, result = _merged(spark, sf_dir, (target, staging))
    # The write's own counts beside those of the tables.
    return merge.merge_metrics(target, staging, KEYS).withColumns({
        "written_inserted": F.lit(result.inserted).cast("long"), "written_updated": F.lit(result.updated).cast("long"),
    })


def merge_bucketed(spark, sf_dir):
    """The same merge into a table bucketed on the key, which is read without a shuffle."""
    target, staging = map(_by_month, merge_sides(_clean(spark, sf_dir)))
    path = scratch_dir(spark, "merge-buckets")
    table = f"merge_{path.rsplit('-', 1)[1]}"
    write_bucketed(target, table, path, KEYS, BUCKETS, ["month"])
    merge.merge_into_bucketed(spark, table, staging, MONTHLY, BUCKETS)
    return spark.read.table(table).select(*DIVIDENDS.columns)


def merge_new_column(spark, sf_dir):
    """Staging brings a column, and lacks another; the target's files have the old columns."""
    target, staging = map(_by_month, merge_sides(_clean(spark, sf_dir)))
    path = scratch_dir(spark, "merge-evolved")
    write_partitioned(target, path, ["month"], ["symbol", "market_dt"])
    staging = staging.withColumn("currency", F.concat(F.lit("C"), F.substring("symbol", 5, 1))).drop("record_dt")
    cat = merge.evolved(MONTHLY, staging.schema)
    merge.merge_into_path(spark, path, staging, cat)
    return spark.read.schema(cat.output).parquet(path).select(*DIVIDENDS.columns, "currency")


def merge_duplicate_keys(spark, sf_dir):
    return merge.duplicate_keys(_clean(spark, sf_dir), KEYS)


def merge_latest_wins(spark, sf_dir):
    return merge.latest_per_key(_clean(spark, sf_dir), KEYS, ["payment_dt"])


UPSERT = f"""with {MERGE} select * from staging union all
  select t.* from target t where not exists (select 1 from staging s where s.symbol = t.symbol and s.market_dt = t.market_dt)"""

QUERIES = {
    "merge_upsert": (merge_upsert, UPSERT),
    "merge_bucketed": (merge_bucketed, UPSERT),
    "merge_new_column": (
        merge_new_column,
        f"""with {MERGE} select s.* replace (t.record_dt as record_dt), 'C' || substr(s.symbol, 5, 1) as currency
  from staging s left join target t using (symbol, market_dt)
union all select t.*, null from target t
  where not exists (select 1 from staging s where s.symbol = t.symbol and s.market_dt = t.market_dt)""",
    ),
    "merge_upsert_rows": (_on_sides(merge.upsert), UPSERT),
    "merge_matched": (_on_sides(merge.matched), f"with {MERGE} select s.* from staging s join target t using (symbol, market_dt)"),
    "merge_not_matched": (
        _on_sides(merge.not_matched), f"with {MERGE} select s.* from staging s anti join target t using (symbol, market_dt)"
    ),
    "merge_duplicate_keys": (
        merge_duplicate_keys,
        f"with {CLEAN} select symbol, market_dt, count(*) as staging_rows from clean where market_dt is not null "
        "group by 1, 2 having count(*) > 1",
    ),
    "merge_metrics": (
        merge_metrics,
        f"""with {MERGE}, c as (select count(*) filter (t.symbol is null) as inserted,
    count(*) filter (t.symbol is not null) as updated from staging s left join target t using (symbol, market_dt))
select inserted, updated, 0::bigint as rejected, inserted as written_inserted, updated as written_updated from c""",
    ),
    "merge_latest_wins": (
        merge_latest_wins,
        f"""with {CLEAN}, r as (select *, row_number() over (partition by symbol, market_dt order by payment_dt desc nulls last,
    dividend_ratio desc nulls last, distr_freq desc nulls last, record_dt desc nulls last, declar_dt desc nulls last) as n
  from clean where market_dt is not null)
select * exclude (n) from r where n = 1 union all select * from clean where market_dt is null""",
    ),
}
