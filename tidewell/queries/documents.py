"""Documents as text: decoded, compared with the schema, traced to their files, and routed by category."""

from pyspark.sql import functions as F

from tidewell.functions import batch_stem, week_monday
from tidewell.operators import routing
from tidewell.queries.inputs import FIELDS, RAW, as_documents, envelopes, raw_records
from tidewell.registry import DIVIDENDS, SPLITS
from tidewell.schemas import CORRUPT
from tidewell.scratch import scratch_dir
from tidewell.sinks import land_batches
from tidewell.sources import decode_documents, encode_documents, read_with_lineage, schema_drift

BY_CATEGORY = {c.name: c for c in (DIVIDENDS, SPLITS)}


def _cut(text):
    """Every fourth order's document loses its end."""
    return F.when(F.col("l_orderkey") % 4 == 0, F.substring(text, F.lit(1), F.length(text) - 2)).otherwise(text)


def decoded(spark, sf_dir):
    texts = encode_documents(envelopes(spark, sf_dir), DIVIDENDS).withColumn("value", _cut(F.col("value")))
    return decode_documents(texts, DIVIDENDS).select(
        "batch_dt", "l_orderkey", F.when(F.col(CORRUPT).isNull(), F.size("data").cast("long")).alias("records"),
        F.col(CORRUPT).isNotNull().alias("corrupt"),
    )


def drift(spark, sf_dir):
    """Batches of some months have a currency; NULL fields are left out of documents, so a batch may lack a field altogether."""
    currency = F.when(F.month("batch_dt") % 4 == 0, F.lit("EUR")).alias("currency")
    # A whole year's first weeks also come without frequencies.
    frequency = F.when(F.weekofyear("batch_dt") > 2, F.col("distr_freq")).alias("distr_freq")
    fields = [frequency if c == "distr_freq" else F.col(c) for c in FIELDS]
    documents = as_documents(raw_records(spark, sf_dir), [*fields, currency])
    texts = documents.withColumn("value", F.to_json(F.struct("data"))).withColumn("value", _cut(F.col("value")))
    return schema_drift(texts, DIVIDENDS, ["batch_dt"])


def file_lineage(spark, sf_dir):
    """Landed under a path that names the request; documents and records by what the paths say."""
    day = F.col("batch_dt")
    stem = batch_stem(F.lit("Dividends"), day, week_monday(day), day)
    root = land_batches(envelopes(spark, sf_dir).drop("l_orderkey"), scratch_dir(spark, "lineage"), stem)
    found = read_with_lineage(spark, root, DIVIDENDS)
    return found.groupBy("data_cat", "start_dt", "end_dt", "batch_dt", "batch_key").agg(
        F.count("*").alias("documents"), F.sum(F.size("data")).alias("records")
    )


def _mixed(spark, sf_dir):
    """An order's document is one of dividends, of splits, or of a category that is none or not supported."""
    kind = F.element_at(F.array(*map(F.lit, ["dividends", "splits", None, "earnings", "dividends"])), (F.col("l_orderkey") % 5 + 1).cast("int"))
    split = F.transform("data", lambda r: F.struct(
        r.symbol.alias("symbol"), r.date.alias("date"), F.lit(1.0).alias("from"), (r.dividend * 100).alias("to"), r.distr_freq.alias("kind"),
    ))
    rows = envelopes(spark, sf_dir).withColumn("data_cat", kind)
    text = F.when(F.col("data_cat") == "splits", F.to_json(F.struct(split.alias("data")))).otherwise(F.to_json(F.struct("data")))
    return rows.select("batch_dt", "l_orderkey", "data_cat", text.alias("value"))


def fan_out(spark, sf_dir):
    """All documents are read and written once; then each category's are cleaned by its own entry."""
    root = routing.fan_out(_mixed(spark, sf_dir), scratch_dir(spark, "routed"), BY_CATEGORY)
    cleaned = routing.clean_routed(spark, root, BY_CATEGORY, keep=("batch_dt",))
    sides = {**cleaned, routing.REJECTS: routing.routed(spark, root, routing.REJECTS)}
    out = None
    for name, rows in sides.items():
        value = F.sum(F.round(F.col({"dividends": "dividend_ratio", "splits": "ratio_to"}[name]) * 100).cast("long")) if name in cleaned else F.lit(None).cast("long")
        counted = rows.groupBy("batch_dt").agg(F.count("*").alias("rows"), value.alias("value")).withColumn("destination", F.lit(name))
        out = counted if out is None else out.unionByName(counted)
    return out


ABSENT = " || ".join(
    f"case when count({'f' if c == 'distr_freq' else c}) filter (good) = 0 then '{c},' else '' end" for c in sorted(FIELDS)
)

QUERIES = {
    "decode_documents": (
        decoded,
        f"""with {RAW} select batch_dt, l_orderkey, case when l_orderkey % 4 <> 0 then count(*) end as records,
  l_orderkey % 4 = 0 as corrupt from raw group by batch_dt, l_orderkey""",
    ),
    "schema_drift": (
        drift,
        f"""with {RAW}, r as (select *, l_orderkey % 4 <> 0 as good, case when weekofyear(batch_dt) > 2 then distr_freq end as f from raw)
select batch_dt, count(distinct l_orderkey) as documents, count(distinct l_orderkey) filter (not good) as undecoded,
  case when month(batch_dt) % 4 = 0 and count(*) filter (good) > 0 then 'currency' else '' end as added, rtrim({ABSENT}, ',') as absent
from r group by batch_dt""",
    ),
    "file_lineage": (
        file_lineage,
        f"""with {RAW} select 'dividends' as data_cat, batch_dt - 4 as start_dt, batch_dt as end_dt, batch_dt,
  'dividends_' || strftime(batch_dt - 4, '%Y%m%d') || '_' || strftime(batch_dt, '%Y%m%d') || '_' || strftime(batch_dt, '%Y%m%d') as batch_key,
  count(distinct l_orderkey) as documents, count(*) as records from raw group by batch_dt""",
    ),
    "fan_out": (
        fan_out,
        f"""with {RAW} select 'dividends' as destination, batch_dt, count(*) as rows, sum(round(dividend * 100)::bigint)::bigint as value
  from raw where l_orderkey % 5 in (0, 4) and symbol is not null and date is not null and dividend is not null group by batch_dt
union all select 'splits', batch_dt, count(*), sum(round(dividend * 100 * 100)::bigint)::bigint
  from raw where l_orderkey % 5 = 1 and symbol is not null and date is not null and dividend is not null group by batch_dt
union all select '_rejects', batch_dt, count(distinct l_orderkey), null from raw where l_orderkey % 5 in (2, 3) group by batch_dt""",
    ),
}
