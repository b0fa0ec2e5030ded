"""Writes that are read back: raw documents, silver tables, staging loads."""

from datetime import date

from pyspark.sql import functions as F

from tidewell.operators import cleanse
from tidewell.queries.inputs import FIELDS, RAW, USER_DAYS, envelopes, user_days
from tidewell.registry import DIVIDENDS
from tidewell.schemas import SILVER
from tidewell.sinks import land_envelopes, split_documents, write_partitioned
from tidewell.scratch import scratch_dir
from tidewell.sources import load_staging, read_batch, read_landed
from tidewell.sources.batches import batch_location

ORDER = ["symbol", "market_dt"]
BATCH = date(2024, 1, 5)


def _landed(spark, sf_dir):
    return land_envelopes(envelopes(spark, sf_dir).drop("l_orderkey"), scratch_dir(spark, "bronze"))


def read_envelope(spark, sf_dir):
    """Landed documents as they are read: batch and number of records."""
    documents = read_landed(spark, _landed(spark, sf_dir), DIVIDENDS)
    return documents.select("batch_dt", F.size("data").cast("long").alias("records"))


def land_raw_roundtrip(spark, sf_dir):
    documents = read_landed(spark, _landed(spark, sf_dir), DIVIDENDS)
    return cleanse.flatten_records(cleanse.explode_records(documents, keep=["batch_dt"]), keep=["batch_dt"])


def corrupt(spark, sf_dir):
    """Every fourth order's document is cut short before it lands; parsed and corrupt ones by batch."""
    whole = F.to_json(F.struct("data"))
    broken = F.when(F.col("l_orderkey") % 4 == 0, F.expr("substr(j, 1, length(j) - 2)")).otherwise(F.col("j"))
    text = envelopes(spark, sf_dir).withColumn("j", whole).select(
        broken.alias("value"), F.date_format("batch_dt", "yyyyMMdd").alias("batch_date")
    )
    path = scratch_dir(spark, "bronze-text")
    text.hint("rebalance", "batch_date").write.partitionBy("batch_date").text(path)
    parsed, broken_ones = split_documents(read_landed(spark, path, DIVIDENDS))
    sides = [
        side.groupBy("batch_dt").agg(F.count("*").alias("documents")).withColumn("side", F.lit(name))
        for name, side in (("parsed", parsed), ("corrupt", broken_ones))
    ]
    return sides[0].unionByName(sides[1])


def _silver(spark, sf_dir, times=1):
    root = scratch_dir(spark, "silver")
    for _ in range(times):
        write_partitioned(user_days(spark, sf_dir), batch_location(root, BATCH), ["market_dt"], ORDER)
    return root


def read_silver_batch(spark, sf_dir):
    return read_batch(spark, _silver(spark, sf_dir), BATCH, SILVER)


def _written(times):
    def query(spark, sf_dir):
        root = _silver(spark, sf_dir, times)
        return spark.read.schema(SILVER).parquet(batch_location(root, BATCH)).select(*SILVER.fieldNames())

    return query


def _staged(mode):
    def query(spark, sf_dir):
        root, path = _silver(spark, sf_dir), scratch_dir(spark, "staging")
        for _ in range(2):
            load_staging(spark, root, BATCH, path, SILVER, "market_dt", ORDER, save_mode=mode)
        return spark.read.schema(SILVER).parquet(path).select(*SILVER.fieldNames())

    return query


ONCE = f"with {USER_DAYS} select * from days"
TWICE = f"{ONCE} union all select * from days"

QUERIES = {
    "read_envelope": (
        read_envelope, f"with {RAW} select batch_dt, count(*) as records from raw group by batch_dt, l_orderkey"
    ),
    "land_raw_roundtrip": (land_raw_roundtrip, f"with {RAW} select batch_dt, {', '.join(FIELDS)} from raw"),
    "corrupt_documents": (
        corrupt,
        f"""with {RAW}, e as (select distinct batch_dt, l_orderkey from raw)
select batch_dt, case when l_orderkey % 4 = 0 then 'corrupt' else 'parsed' end as side, count(*) as documents
from e group by all""",
    ),
    "read_batch": (read_silver_batch, f"with {USER_DAYS} select date '2024-01-05' as batch_dt, * from days"),
    "write_silver_partitioned": (_written(1), ONCE),
    "write_silver_append_twice": (_written(2), TWICE),
    "load_staging_overwrite": (_staged("overwrite"), ONCE),
    "load_staging_append": (_staged("append"), TWICE),
}
