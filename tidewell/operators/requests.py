"""The record slice a request asks for, and its symbol lists."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def source_slice(
    records: DataFrame,
    symbols: Sequence[str] | DataFrame,
    start_dt,
    end_dt,
    limit: int | None = None,
    sort: str = "ASC",
    date: str = "date",
) -> DataFrame:
    """Records of ``symbols`` dated within both bounds, by date, all of them or the first ``limit``.

    ``symbols`` is a list, which is filtered on, or a one-column DataFrame, which is joined. ``sort`` is ``ASC`` or
    ``DESC``. Ties on the date are ordered by every other column, so the slice is the same on each run. On a DATE
    column both bounds reach the scan; on text they are compared after the cast.
    """
    if sort not in ("ASC", "DESC"):
        raise ValueError(f"sort must be 'ASC' or 'DESC', not {sort!r}")
    typed = dict(records.dtypes)[date] == "date"
    day = F.col(date) if typed else F.col(date).try_cast("date")
    hits = records.where(day.between(F.lit(start_dt).cast("date"), F.lit(end_dt).cast("date")))
    if isinstance(symbols, DataFrame):
        wanted = symbols.toDF("symbol").where(F.col("symbol").isNotNull()).distinct()
        hits = hits.join(wanted, "symbol", "left_semi").select(*records.columns)
    else:
        hits = hits.where(F.col("symbol").isin(sorted(set(symbols))))
    keys: list[Column] = [day, *(F.col(c) for c in records.columns if c != date)] + [F.col(date)] * (not typed)
    ordered = hits.orderBy(*[k.desc() if sort == "DESC" else k.asc() for k in keys])
    return ordered if limit is None else ordered.limit(limit)


def symbols_param(rows: DataFrame, batch: str, pages: int, symbol: str = "symbol") -> DataFrame:
    """Comma-joined symbol lists per batch, sorted, each symbol once, spread over ``pages`` requests (``page`` from 0) by
    a digest of the symbol. Choose ``pages`` by the symbols a batch may have and a request may carry; a page without
    symbols has no row."""
    pairs = rows.select(batch, symbol).where(F.col(symbol).isNotNull()).distinct()
    # 28 bits of the digest: the same number in any engine.
    digest = F.conv(F.substring(F.md5(F.col(symbol)), 1, 7), 16, 10).cast("long")
    paged = pairs.withColumn("page", (digest % pages).cast("int"))
    return paged.groupBy(batch, "page").agg(
        F.array_join(F.array_sort(F.collect_list(symbol)), ",").alias("symbols")
    )
