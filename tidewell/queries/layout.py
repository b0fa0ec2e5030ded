"""Tables laid out for reading less: clustered files, Bloom filters, counts from footers, a batch written again."""

from datetime import date

from pyspark.sql import functions as F

from tidewell.operators import layout
from tidewell.operators.requests import source_slice
from tidewell.queries.inputs import USER_DAYS, user_days
from tidewell.schemas import SILVER
from tidewell.scratch import scratch_dir
from tidewell.sinks import replace_batch, write_clustered, write_partitioned
from tidewell.sources import read_batches
from tidewell.sources.batches import batch_location

ORDER = ["symbol", "market_dt"]
BATCHES = (date(2024, 1, 5), date(2024, 1, 12))
#: Users asked for by the lookup, and the days.
SYMBOLS = [f"U{n}" for n in range(0, 10_000, 7)]
DAYS = ("2024-01-03", "2024-01-20")


def cluster_files(spark, sf_dir):
    path = write_clustered(user_days(spark, sf_dir), scratch_dir(spark, "clustered"), ["market_dt"], ORDER)
    found = layout.clustering(spark.read.schema(SILVER).parquet(path), "market_dt", "symbol")
    return found.select("market_dt", "rows", "overlapping")


def rerun_batch(spark, sf_dir):
    """Two batches are written, then the first again with the days up to the 15th alone."""
    days, root = user_days(spark, sf_dir), scratch_dir(spark, "silver")
    for batch_dt in BATCHES:
        write_partitioned(days, batch_location(root, batch_dt), ["market_dt"], ORDER)
    replace_batch(days.where(F.dayofmonth("market_dt") <= 15), root, BATCHES[0], ["market_dt"], ORDER)
    return read_batches(spark, root, SILVER)


def symbol_lookup(spark, sf_dir):
    """A table by day whose files are sorted by value, so only Bloom filters tell where a symbol is."""
    path = scratch_dir(spark, "bloom")
    write_partitioned(user_days(spark, sf_dir), path, ["market_dt"], ["dividend_ratio"], bloom={"symbol": 100_000})
    table = spark.read.schema(SILVER).parquet(path).select(*SILVER.fieldNames())
    return source_slice(table, SYMBOLS, *DAYS, date="market_dt")


def footer_counts(spark, sf_dir):
    path = scratch_dir(spark, "counted")
    write_partitioned(user_days(spark, sf_dir), path, ["market_dt"], ORDER)
    return layout.partition_counts(spark, path, SILVER, ["market_dt"])


QUERIES = {
    "cluster_files": (
        cluster_files, f"with {USER_DAYS} select market_dt, count(*) as rows, 0::bigint as overlapping from days group by 1"
    ),
    "rerun_batch": (
        rerun_batch,
        f"""with {USER_DAYS} select date '2024-01-05' as batch_dt, * from days where day(market_dt) <= 15
union all select date '2024-01-12', * from days""",
    ),
    "symbol_lookup": (
        symbol_lookup,
        f"""with {USER_DAYS} select * from days where market_dt between date '{DAYS[0]}' and date '{DAYS[1]}'
  and symbol in (select 'U' || n from range(0, 10000, 7) r(n))""",
    ),
    "footer_counts": (footer_counts, f"with {USER_DAYS} select market_dt, count(*) as rows from days group by 1"),
}
