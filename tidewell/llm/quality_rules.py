r"""Quality rules with host verdicts.

Each document is measured and held against rules. Rule failures are then counted by host; a host's failure
rate is shrunk towards all hosts' rates with a beta prior fitted to them, so a host with two documents is
not judged like one with two million; hosts whose shrunk rate passes a limit that follows from the prior are refused and the
verdict is joined back to their documents. A document is kept if it meets the base rules and its host is not refused. Only DataFrame functions are used, text is read once, and what is
shuffled is counts.

Defined cases: NULL text has no words (and fails the word-count rule); a NULL host is one host of its
own; repeated rows are judged and counted each; an empty table gives no row; other columns are
ignored. Repeated windows are recognised by a 64-bit digest of their eight words.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.columns import BLANKS, let, text_or_empty
from tidewell.scratch import stored

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"


def words(text: Column) -> Column:
    """Words of ``[^\\x20\\x09-\\x0D]+``."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[ \t\n\x0B\f\r]+", -1)
    )


def repeated_words(ws: Column, window: int = WINDOW) -> Column:
    """How many words stand in a window of ``window`` words that the text holds twice or more."""
    def covered(digests: Column) -> Column:
        placed = F.sort_array(F.transform(digests, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def shared(s: Column) -> Column:
            alike = lambda x, j: (F.get(s, j - 1).h == x.h) | (F.get(s, j + 1).h == x.h)
            return F.sort_array(F.transform(
                F.filter(s, lambda x, j: F.coalesce(alike(x, j), F.lit(False))), lambda x: x.i
            ))

        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        step = lambda acc, i: F.struct(
            (acc.n + i + window - F.greatest(i, acc.end)).alias("n"), (i + window).alias("end")
        )
        total = F.aggregate(let(placed, shared), start, step, lambda acc: acc.n)
        # Most texts repeat nothing: the distinct count is cheap and spares them the sort.
        return F.when(F.size(F.array_distinct(digests)) < F.size(digests), total).otherwise(0)

    def of(w: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(w) - (window - 1))
        digests = F.transform(places, lambda i: F.xxhash64(F.slice(w, i, window)))
        return F.when(F.size(w) > window, let(digests, covered)).otherwise(0)

    return let(ws, of)


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the measures of every document, without its text."""
    text = text_or_empty()
    rows = docs.select("doc_id", F.col(host).alias("host"), text.alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    counts = let(words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).cast("long").alias("n_repeat_words"),
    ))
    symbols = F.when(
        F.col("text").rlike(SYMBOLS), F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", ""))
    ).otherwise(0)
    return rows.select(
        "doc_id", "host", counts.alias("c"),
        symbols.cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        )).alias("l"),
    ).select("doc_id", "host", "c.*", "n_symbols", "l.*")


def rule_failures(max_symbol_share: float = 0.1, max_dup_lines: float = 0.5) -> dict[str, Column]:
    """The rules, by name. ``words`` and ``repeats`` are the base rules."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "words": n < 20,
        "repeats": 100 * F.col("n_repeat_words") > 30 * n,
        "symbols": F.col("n_symbols") > max_symbol_share * chars,
        "dup_lines": F.col("n_dup_lines") > max_dup_lines * F.col("n_lines"),
    }


def host_verdicts(measured: DataFrame, max_prior: float = 100.0, spread: float = 4.0) -> DataFrame:
    """host, its documents, failures, shrunk rate, the limit and whether the host is refused.

    A document fails if any rule says so. The true rates of all other hosts are taken to come from a beta distribution, fitted by the
    beta-binomial's moments, each host counting once: the variance of the rates seen, less what drawing so few documents adds
    to it. The host's own rate is shrunk towards that prior, and the host is refused if it is still more than ``spread`` of the prior's
    standard deviations above the prior's mean. A prior weighs ``max_prior`` documents at most, so hosts are never taken to be
    more alike than that. A host that has no others beside it is not refused.

    Rates are taken half a failure up in one document more, so a host that never failed is not taken to be without fault. One row of sums
    is all that meets in one place.
    """
    failed = F.lit(False)
    for rule in rule_failures().values():
        failed = failed | rule
    hosts = measured.groupBy("host").agg(F.count("*").alias("docs"), F.count_if(failed).alias("failures"))
    r, draw = (F.col("failures") + 0.5) / (F.col("docs") + 1), 1 / F.col("docs")
    k, total, squares, draws = hosts.agg(F.count("*") - 1, F.sum(r), F.sum(r * r), F.sum(draw)).first()
    if k < 1:
        return hosts.withColumns({"shrunk_rate": r, "limit": F.lit(1.0), "refused": F.lit(False)})
    m = (F.lit(total) - r) / k
    some = F.col("m") * (1 - F.col("m"))
    seen = (F.lit(squares) - r * r - k * F.col("m") * F.col("m")) / max(1, k - 1)
    few = (F.lit(draws) - draw) / k
    v = F.when(few < 1, (seen - some * few) / (1 - few)).otherwise(0.0) if k > 1 else F.lit(0.0)
    weight = F.when(F.col("v") > 0, F.least(F.lit(max_prior), F.greatest(F.lit(0.0), some / F.col("v") - 1))).otherwise(max_prior)
    fitted = hosts.withColumn("m", m).withColumn("v", v).withColumn("weight", weight)
    return fitted.select(
        "host", "docs", "failures",
        ((F.col("failures") + F.col("m") * F.col("weight")) / (F.col("docs") + F.col("weight"))).alias("shrunk_rate"),
        (F.col("m") + spread * F.sqrt(some / (F.col("weight") + 1))).alias("limit"),
    ).withColumn("refused", F.col("shrunk_rate") > F.col("limit"))


def quality_rules(docs: DataFrame, host: str = "source", **options: float) -> DataFrame:
    """Measures, the rules each document fails, its host's shrunk rate and the limit, and ``kept``: no base rule failed and the host is not
    refused. The other rules count towards the host."""
    measured = stored(measure(docs, host), "quality-rules")
    verdicts = host_verdicts(measured, **options).select(F.col("host").alias("h"), "shrunk_rate", "limit", "refused")
    rules = rule_failures()
    base = rules["words"] | rules["repeats"]
    failed = F.concat_ws(",", *[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    joined = measured.join(verdicts, F.col("host").eqNullSafe(F.col("h")))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "n_lines", (~base & ~F.col("refused")).alias("kept"),
        failed.alias("failed_rules"), "shrunk_rate", F.col("limit").alias("host_limit"),
    )


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    done = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.withColumns({c: F.round(c, 9) for c in ("shrunk_rate", "host_limit")})


ORACLE = r"""
with t as (select doc_id, source, coalesce(text, '') as text from documents),
x as (select *, list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) as l from t),
g as (select doc_id, array_to_string(w[i:i+7], ' ') as gram, i from
        (select doc_id, w, unnest(range(1, greatest(len(w) - 6, 1))) as i from x)),
z as (select doc_id, i from (select *, count(*) over (partition by doc_id, gram) as c from g) where c > 1),
p as (select doc_id, count(distinct i + k) as n from z, (select unnest(range(8)) as k) group by doc_id),
q as (
  select x.doc_id, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, len(l)::bigint as n_lines, coalesce(n, 0)::bigint as n_repeat_words
  from x left join p on x.doc_id = p.doc_id),
f as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    concat_ws(',', case when n_words < 20 then 'words' end,
      case when 100 * n_repeat_words > 30 * n_words then 'repeats' end,
      case when n_symbols > 0.1 * word_chars then 'symbols' end,
      case when n_dup_lines > 0.5 * n_lines then 'dup_lines' end) as failed_rules from q),
h as (select source, count(*) as docs, count(*) filter (failed_rules <> '') as failures from f group by source),
r as (select *, (failures + 0.5::double) / (docs + 1) as r from h),
a as (select count(*) - 1 as k, sum(r) as total, sum(r * r) as squares, sum(1.0::double / docs) as draws from r),
m as (select *, (total - r) / k as m, (draws - 1.0::double / docs) / k as few from r, a where k > 0),
v as (select *, case when few < 1 and k > 1 then ((squares - r * r - k * m * m) / (k - 1) - m * (1 - m) * few) / (1 - few) else 0.0 end as v from m),
w as (select *, case when v > 0 then least(100.0, greatest(0.0, m * (1 - m) / v - 1)) else 100.0 end::double as w from v),
s as (select source, (failures + m * w) / (docs + w) as rate, m + 4 * sqrt(m * (1 - m) / (w + 1)) as top from w
  union all select source, r, 1.0 from r, a where k = 0)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
  not base_failed and s.rate <= s.top as kept, failed_rules, round(s.rate, 9) as shrunk_rate, round(s.top, 9) as host_limit
from f join s on f.source is not distinct from s.source
"""
