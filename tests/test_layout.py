from datetime import date
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewell.operators import layout
from tidewell.operators.requests import source_slice
from tidewell.schemas import SILVER
from tidewell.sinks import replace_batch, replace_partitions, write_clustered, write_partitioned
from tidewell.sources import read_batches
from tidewell.sources.batches import batch_location

D = [date(2024, 1, n) for n in (1, 2, 3)]


@pytest.fixture(scope="module")
def rows(spark):
    """Two days: one of 20,000 symbols that every input task holds some of, one of a few; and rows without a day."""
    number = F.pmod(F.xxhash64("id"), F.lit(100_000))
    day = F.when(F.col("id") < 20_000, F.lit(D[0])).when(F.col("id") < 20_050, F.lit(D[1]))
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in SILVER}
    return spark.range(0, 20_060, 1, 6).select("id", day.alias("market_dt")).withColumns(
        {c: v for c, v in nothing.items() if c != "market_dt"} | {"symbol": F.concat(F.lit("S"), number), "dividend_ratio": F.col("id") / 7}
    ).select(*SILVER.fieldNames())


@pytest.fixture()
def small_tasks(spark):
    """Test tables are far below the size at which Spark leaves tasks apart."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def _read(spark, path):
    return spark.read.schema(SILVER).parquet(path)


def _files(path):
    return sorted(Path(path).rglob("*.parquet"))


def test_files_of_a_day_hold_ranges_of_their_own(spark, rows, tmp_path, small_tasks):
    path = write_clustered(rows, str(tmp_path / "t"), ["market_dt"], ["symbol", "market_dt"])
    found = {r.market_dt: r for r in layout.clustering(_read(spark, path), "market_dt", "symbol").collect()}
    assert found[D[0]].files > 1 and {d: r.rows for d, r in found.items()} == {D[0]: 20_000, D[1]: 50, None: 10}
    assert not any(r.overlapping for r in found.values())
    assert _read(spark, path).select(*SILVER.fieldNames()).exceptAll(rows).count() == 0

    dealt = str(tmp_path / "dealt")
    rows.repartition(6).write.partitionBy("market_dt").parquet(dealt)
    mixed = {r.market_dt: r for r in layout.clustering(_read(spark, dealt), "market_dt", "symbol").collect()}
    assert mixed[D[0]].overlapping == mixed[D[0]].files - 1 > 0


@pytest.mark.parametrize("write", [write_clustered, write_partitioned, replace_partitions])
def test_rows_are_sorted_in_every_file(rows, tmp_path, write):
    write(rows, str(tmp_path / "t"), ["market_dt"], ["symbol", "market_dt"])
    for file in _files(tmp_path / "t"):
        symbols = pq.ParquetFile(file).read(["symbol"])["symbol"].to_pylist()
        assert symbols == sorted(symbols)


def test_one_hot_key_is_split_over_files(spark, tmp_path, small_tasks):
    hot = spark.range(20_000).select(F.lit("A").alias("symbol"), F.lit(D[0]).alias("market_dt"), F.col("id"))
    path = write_clustered(hot, str(tmp_path / "t"), ["market_dt"], ["symbol"])
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in _files(path)]
    assert sum(sizes) == 20_000 and max(sizes) < 10_000


def _read_rows(df):
    """Rows that the scan under ``df`` gave, once it has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    leaf = leaves.apply(0)
    leaf = leaf.plan().collectLeaves().apply(0) if "QueryStage" in leaf.nodeName() else leaf
    return leaf.metrics().apply("numOutputRows").value()


def test_bloom_filters_skip_what_ranges_cannot(spark, rows, tmp_path):
    wanted = [r.symbol for r in rows.where(F.col("market_dt") == D[0]).limit(3).collect()]
    read = {}
    for name, bloom in (("with", {"symbol": 5_000}), ("without", None)):
        path = str(tmp_path / name)
        # Small row groups, each with symbols of the whole range.
        spark.conf.set("parquet.block.size", "65536")
        try:
            write_partitioned(rows, path, ["market_dt"], ["dividend_ratio"], bloom=bloom)
        finally:
            spark.conf.unset("parquet.block.size")
        found = _read(spark, path).where((F.col("market_dt") == D[0]) & F.col("symbol").isin(wanted))
        read[name] = _read_rows(found), sorted(map(tuple, found.select("symbol", "dividend_ratio").collect()))
        same = source_slice(_read(spark, path).select(*SILVER.fieldNames()), wanted, D[0], D[0], date="market_dt")
        assert same.count() == len(read[name][1])
    assert read["with"][1] == read["without"][1] and len(read["with"][1]) >= 3
    assert read["with"][0] < read["without"][0]


def test_counts_come_from_footers(spark, rows, tmp_path):
    path = write_partitioned(rows, str(tmp_path / "t"), ["market_dt"], ["symbol"])
    counted = layout.partition_counts(spark, path, SILVER, ["market_dt"])
    assert {tuple(r) for r in counted.collect()} == {(D[0], 20_000), (D[1], 50), (None, 10)}
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [market_dt]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_a_batch_written_again_leaves_nothing_behind(spark, rows, tmp_path):
    root = str(tmp_path / "silver")
    for batch in D[:2]:
        write_partitioned(rows, batch_location(root, batch), ["market_dt"], ["symbol"])
    others = _files(batch_location(root, D[1]))
    for _ in range(2):
        replace_batch(rows.where(F.col("market_dt") == D[1]), root, D[0], ["market_dt"], ["symbol"])
        counts = {tuple(r) for r in read_batches(spark, root, SILVER).groupBy("batch_dt", "market_dt").count().collect()}
        assert counts == {(D[0], D[1], 50), (D[1], D[0], 20_000), (D[1], D[1], 50), (D[1], None, 10)}
    assert _files(batch_location(root, D[1])) == others
