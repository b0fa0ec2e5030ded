"""Requests and batch checks: slices, symbol pages, week bounds, keys, labels, routing."""

from pyspark.sql import functions as F

from tidewell.functions import batch_dir, batch_file, batch_path, batch_stem, status_label, week_friday, week_monday
from tidewell.operators import cleanse
from tidewell.operators import quality
from tidewell.operators.requests import source_slice, symbols_param
from tidewell.queries.inputs import CLEAN, RAW, envelopes, raw_records, table
from tidewell.registry import DIVIDENDS

SLICE = ("1997-01-01", "1998-12-31")
#: Rows asked for by the two slice queries: the limit is what they show.
LIMIT = 200


def _symbols(spark, sf_dir):
    """Suppliers of the fixture's symbols, every seventh."""
    number = F.col("s_suppkey")
    symbol = F.concat(F.lit("S"), F.lpad(number.cast("string"), 4, "0"))
    return table(spark, sf_dir, "supplier").where(number % 7 == 0).select(symbol.alias("symbol"))


def _slice(sort, limit=None):
    def query(spark, sf_dir):
        rows = cleanse.clean(envelopes(spark, sf_dir), DIVIDENDS)
        return source_slice(rows, _symbols(spark, sf_dir), *SLICE, limit=limit, sort=sort, date="market_dt")

    return query


def _slice_sql(sort, limit=None):
    columns = ["market_dt", "symbol", "dividend_ratio", "distr_freq", "payment_dt", "record_dt", "declar_dt"]
    nulls = "nulls first" if sort == "asc" else "nulls last"
    order = ", ".join(f"{c} {sort} {nulls}" for c in columns)
    return f"""with {CLEAN} select * from clean where market_dt between date '{SLICE[0]}' and date '{SLICE[1]}'
  and symbol in (select 'S' || lpad(cast(s_suppkey as varchar), 4, '0') from supplier where s_suppkey % 7 = 0)
  order by {order}""" + (f" limit {limit}" if limit else "")


def symbol_pages(spark, sf_dir):
    return symbols_param(raw_records(spark, sf_dir), "batch_dt", pages=4)


def week_range(spark, sf_dir):
    day = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", week_monday(day).alias("start_dt"), week_friday(day).alias("end_dt")
    )


def batch_key(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    category, bucket, directory = F.lit("Dividends"), F.lit("raw"), F.lit("bronze/dividends")
    start, end = week_monday(day), week_friday(day)
    file = batch_file(category, end, start, end, F.lit("JSON"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", batch_stem(category, end, start, end).alias("stem"), file.alias("file"),
        batch_dir(end, bucket, directory, "s3a://").alias("dir"),
        batch_path(end, bucket, directory, file, "s3a://").alias("path"),
    )


CODES = [200, 201, 299, 302, 400, 404, 499, 500, 503, 599, 600]


def status_labels(spark, sf_dir):
    code = F.element_at(F.array(*map(F.lit, CODES)), (F.col("event_id") % 11 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", code.alias("code")).select(
        "event_id", "code", status_label(F.col("code")).alias("label"),
        status_label(F.col("code"), strict_bounds=True).alias("strict_label"),
    )


def _requests(spark, sf_dir):
    """A request per order with one field null or empty, by its key."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 7 == 0, "").when(key % 7 != 1, "dividends").alias("data_cat"),
        F.when(key % 7 != 2, day).alias("start_dt"),
        F.when(key % 7 != 3, F.date_add(day, (key % 5 - 2).cast("int"))).alias("end_dt"),
        F.when(key % 7 == 4, "").when(key % 7 != 1, "bronze").alias("dir_nm"),
    )


REQUESTS = """req as (select o_orderkey,
  case when o_orderkey % 7 = 0 then '' when o_orderkey % 7 <> 1 then 'dividends' end as data_cat,
  case when o_orderkey % 7 <> 2 then cast(o_orderdate as date) end as start_dt,
  case when o_orderkey % 7 <> 3 then cast(o_orderdate as date) + cast(o_orderkey % 5 - 2 as integer) end as end_dt,
  case when o_orderkey % 7 = 4 then '' when o_orderkey % 7 <> 1 then 'bronze' end as dir_nm from orders)"""
REQUIRED = ["data_cat", "start_dt", "end_dt", "dir_nm"]


def missing_required(spark, sf_dir):
    return quality.missing_required(_requests(spark, sf_dir), REQUIRED)


def invalid_date_ranges(spark, sf_dir):
    return quality.invalid_date_ranges(_requests(spark, sf_dir))


def _categories(spark, sf_dir):
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(kind == "purchase", "dividends").otherwise(kind).alias("data_cat")
    )


CATEGORIES = """cat as (select event_id,
  case when event_type = 'purchase' then 'dividends' else event_type end as data_cat from events)"""

QUERIES = {
    "source_slice": (_slice("ASC"), _slice_sql("asc")),
    "source_slice_asc": (_slice("ASC", LIMIT), _slice_sql("asc", LIMIT)),
    "source_slice_desc": (_slice("DESC", LIMIT), _slice_sql("desc", LIMIT)),
    "symbols_param": (symbol_pages, f"""with {RAW}, p as (
  select distinct batch_dt, symbol, cast(cast('0x' || substr(md5(symbol), 1, 7) as integer) % 4 as integer) as page
  from raw where symbol is not null)
select batch_dt, page, string_agg(symbol, ',' order by symbol) as symbols from p group by batch_dt, page"""),
    "week_range": (week_range, """select o_orderkey, cast(date_trunc('week', o_orderdate) as date) as start_dt,
  cast(date_trunc('week', o_orderdate) as date) + 4 as end_dt from orders"""),
    "batch_key": (batch_key, """with w as (select o_orderkey, strftime(date_trunc('week', o_orderdate), '%Y%m%d') as a,
  strftime(date_trunc('week', o_orderdate) + interval 4 day, '%Y%m%d') as b from orders)
select o_orderkey, 'dividends_' || a || '_' || b || '_' || b as stem, 'dividends_' || a || '_' || b || '_' || b || '.json' as file,
  's3a://raw/bronze/dividends/batch_date=' || b || '/' as dir,
  's3a://raw/bronze/dividends/batch_date=' || b || '/dividends_' || a || '_' || b || '_' || b || '.json' as path from w"""),
    "status_label": (status_labels, f"""with c as (select event_id, {CODES}[event_id % 11 + 1] as code from events)
select event_id, code, case when code between 200 and 299 then 'success' when code between 400 and 599 then 'error'
    else 'unknown' end as label,
  case when code > 200 and code < 299 then 'success'
    when (code > 400 and code < 499) or (code > 500 and code < 599) then 'error' else 'unknown' end as strict_label from c"""),
    "missing_required": (missing_required, f"""with {REQUESTS}, m as (select *, concat_ws(',',
  case when coalesce(data_cat, '') = '' then 'data_cat' end, case when start_dt is null then 'start_dt' end,
  case when end_dt is null then 'end_dt' end, case when coalesce(dir_nm, '') = '' then 'dir_nm' end) as missing from req)
select * from m where missing <> ''"""),
    "invalid_date_ranges": (invalid_date_ranges, f"with {REQUESTS} select * from req where start_dt > end_dt"),
    "route_category": (
        lambda spark, sf_dir: quality.route_category(_categories(spark, sf_dir)),
        f"with {CATEGORIES} select * from cat where data_cat = 'dividends'",
    ),
    "unsupported_category": (
        lambda spark, sf_dir: quality.unsupported_category(_categories(spark, sf_dir)),
        f"""with {CATEGORIES} select *, 'Unsupported data category: ' || data_cat as reason from cat
where data_cat <> 'dividends'""",
    ),
}
