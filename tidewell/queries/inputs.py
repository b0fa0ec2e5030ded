"""Inputs derived from the given tables (FIXTURES.md), as DataFrames and as SQL."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.scratch import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records from lineitem with missing fields, malformed dates and times of day, their batch date (a Friday)
    and l_orderkey."""
    ship, line = F.col("l_shipdate").cast("date"), F.col("l_linenumber")
    text = lambda day: day.cast("string")
    return table(spark, sf_dir, "lineitem").select(
        F.date_add(F.trunc(ship, "week"), 4).alias("batch_dt"),
        "l_orderkey",
        F.when(line != 7, F.concat(F.lit("S"), F.lpad(F.col("l_suppkey").cast("string"), 4, "0"))).alias("symbol"),
        F.when(line == 6, "not-a-date").when(line != 5, F.concat(text(ship), F.lit("T00:00:00+0000"))).alias("date"),
        F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("dividend"),
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("distr_freq"),
        text(F.date_add(ship, 14)).alias("payment_date"),
        F.when(F.col("l_linestatus") != "O", F.concat(text(F.date_add(ship, 1)), F.lit(" 00:00:00"))).alias("record_date"),
        F.when(line == 4, "n/a").otherwise(text(F.date_sub(ship, 30))).alias("declaration_date"),
    )


FIELDS = ["symbol", "date", "dividend", "distr_freq", "payment_date", "record_date", "declaration_date"]

RAW = """raw as (
  select cast(date_trunc('week', l_shipdate) as date) + 4 as batch_dt, l_orderkey,
    case when l_linenumber <> 7 then 'S' || lpad(cast(l_suppkey as varchar), 4, '0') end as symbol,
    case when l_linenumber = 6 then 'not-a-date' when l_linenumber <> 5
      then strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00+0000' end as date,
    case when l_discount <> 0 then l_discount end as dividend,
    case when l_returnflag <> 'R' then l_returnflag end as distr_freq,
    strftime(l_shipdate + interval 14 day, '%Y-%m-%d') as payment_date,
    case when l_linestatus <> 'O' then strftime(l_shipdate + interval 1 day, '%Y-%m-%d 00:00:00') end as record_date,
    case when l_linenumber = 4 then 'n/a' else strftime(l_shipdate - interval 30 day, '%Y-%m-%d') end as declaration_date
  from lineitem)"""

#: Records with their essentials, dates still text.
PREPARED = RAW + """, prepared as (
  select batch_dt, symbol, date as market_dt, dividend as dividend_ratio, coalesce(distr_freq, 'Unknown') as distr_freq,
    payment_date as payment_dt, record_date as record_dt, declaration_date as declar_dt
  from raw where symbol is not null and date is not null and dividend is not null)"""


def as_day(column: str) -> str:
    return f"try_cast(substr({column}, 1, 10) as date)"


CLEAN = PREPARED + f""", clean as (
  select symbol, {as_day('market_dt')} as market_dt, dividend_ratio, distr_freq, {as_day('payment_dt')} as payment_dt,
    {as_day('record_dt')} as record_dt, {as_day('declar_dt')} as declar_dt from prepared)"""


def as_documents(records: DataFrame, fields: Sequence[str | Column] = FIELDS) -> DataFrame:
    """One document per order and batch: a document holds an order's lines, not a batch's. Records meet before they are
    listed: lists of a line or two, made before the shuffle, would only be sorted and carried for nothing."""
    key = ["batch_dt", "l_orderkey"]
    return records.repartition(*key).groupBy(*key).agg(F.collect_list(F.struct(*fields)).alias("data"))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_documents(raw_records(spark, sf_dir))


def merge_sides(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Target (before 2001-03-01) and staging (from 2001-01-01, ratios doubled), a row per key."""
    rest = ["distr_freq", "payment_dt", "record_dt", "declar_dt"]
    one = cleaned.where("market_dt is not null").groupBy("symbol", "market_dt").agg(
        F.max("dividend_ratio").alias("dividend_ratio"), *[F.max(c).alias(c) for c in rest]
    )
    # Both sides are made of it.
    one = stored(one, "merge-fixture")
    staging = one.where("market_dt >= date'2001-01-01'").withColumn("dividend_ratio", F.col("dividend_ratio") * 2)
    return one.where("market_dt < date'2001-03-01'"), staging


MERGE = CLEAN + """, one as (
  select symbol, market_dt, max(dividend_ratio) as dividend_ratio, max(distr_freq) as distr_freq,
    max(payment_dt) as payment_dt, max(record_dt) as record_dt, max(declar_dt) as declar_dt
  from clean where market_dt is not null group by symbol, market_dt),
target as (select * from one where market_dt < date '2001-03-01'),
staging as (select * replace (dividend_ratio * 2 as dividend_ratio) from one where market_dt >= date '2001-01-01')"""


def user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver-shaped table of few dates: the largest value of each user and day."""
    from tidewell.schemas import SILVER

    rows = table(spark, sf_dir, "events").groupBy(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"), F.col("ts").cast("date").alias("market_dt")
    ).agg(F.max("value").alias("dividend_ratio"))
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in SILVER if f.name not in rows.columns}
    return rows.withColumns(nothing).select(*SILVER.fieldNames())


USER_DAYS = """days as (
  select 'U' || user_id as symbol, cast(ts as date) as market_dt, max(value) as dividend_ratio,
    null::varchar as distr_freq, null::date as payment_dt, null::date as record_dt, null::date as declar_dt
  from events group by 1, 2)"""
