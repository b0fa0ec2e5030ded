"""The run ledger: lookup, new batches, insert, counts."""

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from tidewell.functions import week_friday, week_monday
from tidewell.operators import ledger
from tidewell.queries.inputs import table
from tidewell.scratch import scratch_dir

STARTED = datetime(2024, 1, 5, 12, 0, 0, tzinfo=timezone.utc)
LOOKED_UP = date(1998, 6, 12)


def batches(spark, sf_dir):
    """A batch for each week with orders."""
    day = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.lit("dividends").alias("data_cat"), week_friday(day).alias("batch_dt"), week_monday(day).alias("start_dt"),
        week_friday(day).alias("end_dt"),
    )


def _existing(spark, sf_dir):
    """The ledger after the even weeks were registered."""
    even = batches(spark, sf_dir).where(F.weekofyear("batch_dt") % 2 == 0)
    path = scratch_dir(spark, "ledger")
    ledger.insert_waiting(spark, path, even, STARTED)
    return path


def ledger_insert(spark, sf_dir):
    path = _existing(spark, sf_dir)
    ledger.insert_waiting(spark, path, batches(spark, sf_dir), STARTED)
    ledger.insert_waiting(spark, path, batches(spark, sf_dir), STARTED)
    return ledger.read_ledger(spark, path)


def ledger_lookup(spark, sf_dir):
    return ledger.ledger_lookup(ledger.read_ledger(spark, _existing(spark, sf_dir)), "dividends", LOOKED_UP).select(
        "data_cat", "batch_dt", "load_status"
    )


def ledger_new_batches(spark, sf_dir):
    return ledger.new_batches(batches(spark, sf_dir), ledger.read_ledger(spark, _existing(spark, sf_dir)))


def ledger_counts(spark, sf_dir):
    """Runs by batch of a ledger with a row per order."""
    return ledger.ledger_counts(batches(spark, sf_dir))


BATCHES = """b as (select 'dividends' as data_cat, cast(date_trunc('week', o_orderdate) as date) + 4 as batch_dt,
  cast(date_trunc('week', o_orderdate) as date) as start_dt, cast(date_trunc('week', o_orderdate) as date) + 4 as end_dt
  from orders)"""
ROWS = """'WAITING' as extract_status, 'WAITING' as transform_status, 'WAITING' as load_status,
  timestamp '2024-01-05 12:00:00' as start_time, null::timestamp as end_time"""

QUERIES = {
    "ledger_insert": (ledger_insert, f"with {BATCHES} select distinct *, {ROWS} from b"),
    "ledger_lookup": (
        ledger_lookup,
        f"""with {BATCHES} select distinct data_cat, batch_dt, 'WAITING' as load_status from b
where batch_dt = date '1998-06-12' and weekofyear(batch_dt) % 2 = 0""",
    ),
    "ledger_new_batches": (ledger_new_batches, f"with {BATCHES} select * from b where weekofyear(batch_dt) % 2 <> 0"),
    "ledger_counts": (ledger_counts, f"with {BATCHES} select data_cat, batch_dt, count(*) as runs from b group by 1, 2"),
}
