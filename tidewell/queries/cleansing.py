"""Explode, flatten, rename, drop, fill, cast, and the whole transform."""

from pyspark.sql import functions as F

from tidewell.operators import cleanse
from tidewell.queries.inputs import CLEAN, FIELDS, PREPARED, RAW, as_day, envelopes
from tidewell.registry import DIVIDENDS

KEEP = ["batch_dt"]


def clean_dividends(spark, sf_dir):
    return cleanse.clean(envelopes(spark, sf_dir), DIVIDENDS)


def explode_records(spark, sf_dir):
    records = cleanse.explode_records(envelopes(spark, sf_dir), keep=["batch_dt", "l_orderkey"])
    return records.select("batch_dt", "l_orderkey", F.col("record.symbol"), F.col("record.dividend"))


def _flat(spark, sf_dir):
    return cleanse.flatten_records(cleanse.explode_records(envelopes(spark, sf_dir), keep=KEEP), keep=KEEP)


def rename_columns(spark, sf_dir):
    return cleanse.rename_columns(_flat(spark, sf_dir), DIVIDENDS)


def drop_missing_essentials(spark, sf_dir):
    return cleanse.drop_missing_essentials(rename_columns(spark, sf_dir), DIVIDENDS)


def fill_defaults(spark, sf_dir):
    return cleanse.fill_defaults(rename_columns(spark, sf_dir), DIVIDENDS)


def cast_dates(spark, sf_dir):
    return cleanse.cast_dates(rename_columns(spark, sf_dir), DIVIDENDS)


def quarantine_bad_dates(spark, sf_dir):
    usable, rejected = cleanse.quarantine_bad_dates(
        cleanse.prepare(envelopes(spark, sf_dir), DIVIDENDS, keep=KEEP), DIVIDENDS
    )
    return usable.withColumn("side", F.lit("usable")).unionByName(rejected.withColumn("side", F.lit("rejected")))


RENAMED = """batch_dt, symbol, date as market_dt, dividend as dividend_ratio, distr_freq, payment_date as payment_dt,
  record_date as record_dt, declaration_date as declar_dt"""

QUERIES = {
    "clean_dividends": (clean_dividends, f"with {CLEAN} select * from clean"),
    "explode_records": (explode_records, f"with {RAW} select batch_dt, l_orderkey, symbol, dividend from raw"),
    "flatten_records": (_flat, f"with {RAW} select batch_dt, {', '.join(FIELDS)} from raw"),
    "rename_columns": (rename_columns, f"with {RAW} select {RENAMED} from raw"),
    "drop_missing_essentials": (
        drop_missing_essentials,
        f"with {RAW} select {RENAMED} from raw where symbol is not null and date is not null and dividend is not null",
    ),
    "fill_defaults": (
        fill_defaults,
        f"with {RAW}, r as (select {RENAMED} from raw) "
        "select * replace (coalesce(distr_freq, 'Unknown') as distr_freq) from r",
    ),
    "cast_dates": (
        cast_dates,
        f"with {RAW}, r as (select {RENAMED} from raw) select * replace ("
        + ", ".join(f"{as_day(c)} as {c}" for c in ("market_dt", "payment_dt", "record_dt", "declar_dt"))
        + ") from r",
    ),
    "quarantine_bad_dates": (
        quarantine_bad_dates,
        f"with {PREPARED} select *, case when {as_day('market_dt')} is null then 'rejected' else 'usable' end as side "
        "from prepared",
    ),
}
