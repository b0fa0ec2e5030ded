import pytest
from rows import same_rows

from tidewell import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    same_rows(queries.queries()[name](spark, sf_dir), duck.sql(SQL[name]))


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(queries.queries()) <= set(entry.queries())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clean_is_one_narrow_chain(spark, tmp_path):
    from tidewell.operators.cleanse import clean
    from tidewell.registry import DIVIDENDS
    from tidewell.sources import read_envelopes

    (tmp_path / "a.json").write_text('{"data": []}\n')
    plan = _plan(clean(read_envelopes(spark, str(tmp_path), DIVIDENDS), DIVIDENDS))
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", ["clean_dividends", "merge_upsert_rows", "symbols_param", "ledger_counts"])
def test_no_python_in_plans(spark, sf_dir, name):
    plan = _plan(queries.queries()[name](spark, sf_dir))
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_one_batch_reads_one_directory(spark, tmp_path):
    from datetime import date

    from tidewell.schemas import SILVER
    from tidewell.sources import read_batches

    root = str(tmp_path / "silver")
    for day in ("20240105", "20240112"):
        spark.createDataFrame([], SILVER).write.parquet(f"{root}/batch_date={day}")
    plan = _plan(read_batches(spark, root, SILVER, first=date(2024, 1, 12)))
    assert "PartitionFilters: [isnotnull(batch_date" in plan and ">= 20240112" in plan


def test_limited_slice_keeps_a_bounded_heap_per_task(spark, sf_dir):
    assert "TakeOrderedAndProject" in _plan(queries.queries()["source_slice_asc"](spark, sf_dir))
