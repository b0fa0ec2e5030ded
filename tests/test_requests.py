from datetime import date

import pytest
from pyspark.sql import functions as F

from tidewell.functions import status_label, week_friday, week_monday
from tidewell.operators.quality import invalid_date_ranges, missing_required, unsupported_category
from tidewell.operators.requests import source_slice, symbols_param


@pytest.fixture(scope="module")
def records(spark):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int"))
    return spark.range(300).select(F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"), day.alias("date"), "id")


def test_no_limit_keeps_every_row(records):
    got = source_slice(records, ["S0", "S1", "S2"], "2024-01-01", "2024-01-10")
    assert got.count() == 300


def test_list_and_table_of_symbols_agree(spark, records):
    wanted = spark.createDataFrame([("S0",), ("S2",), (None,), ("S0",)], "symbol string")
    a = source_slice(records, wanted, "2024-01-02", "2024-01-04")
    b = source_slice(records, ["S2", "S0"], "2024-01-02", "2024-01-04")
    assert a.collect() == b.collect() and a.count() == 60


def test_limit_and_direction(records):
    up = source_slice(records, ["S1"], "2024-01-01", "2024-01-31", limit=3)
    down = source_slice(records, ["S1"], "2024-01-01", "2024-01-31", limit=3, sort="DESC")
    assert {r["date"] for r in up.collect()} == {date(2024, 1, 1)}
    assert {r["date"] for r in down.collect()} == {date(2024, 1, 10)}
    for bad in ("descending", "asc", ""):
        with pytest.raises(ValueError):
            source_slice(records, ["S1"], "2024-01-01", "2024-01-31", sort=bad)


@pytest.mark.parametrize("n", [1000, 1001])
def test_symbol_pages_do_not_depend_on_their_number(spark, n):
    rows = spark.range(n).select(F.lit(1).alias("batch"), F.concat(F.lit("S"), "id").alias("symbol"))
    got = symbols_param(rows.union(rows), "batch", pages=2).collect()
    assert sorted(r["page"] for r in got) == [0, 1]
    assert sum(len(r["symbols"].split(",")) for r in got) == n
    assert symbols_param(rows, "batch", pages=1).count() == 1


def test_week_of_a_sunday_is_the_week_before(spark):
    day = F.lit("2024-01-07").cast("date")
    row = spark.range(1).select(week_monday(day), week_friday(day)).first()
    assert tuple(row) == (date(2024, 1, 1), date(2024, 1, 5))


def test_status_bounds(spark):
    codes = [199, 200, 201, 299, 300, 399, 400, 499, 500, 599, 600, None]
    df = spark.createDataFrame([(c,) for c in codes], "code int")
    got = {r[0]: (r[1], r[2]) for r in df.select("code", status_label(F.col("code")), status_label(F.col("code"), True)).collect()}
    assert got[200] == ("success", "unknown") and got[201] == ("success", "success")
    assert got[299] == ("success", "unknown") and got[400] == got[499] == got[500] == got[599] == ("error", "unknown")
    assert got[199] == got[300] == got[600] == got[None] == ("unknown", "unknown")


def test_checks(spark):
    df = spark.createDataFrame(
        [("", date(2024, 1, 2), date(2024, 1, 1)), ("x", date(2024, 1, 1), date(2024, 1, 1)), (None, None, date(2024, 1, 1))],
        "data_cat string, start_dt date, end_dt date",
    )
    assert sorted(r["missing"] for r in missing_required(df, ["data_cat", "start_dt"]).collect()) == ["data_cat", "data_cat,start_dt"]
    assert invalid_date_ranges(df).count() == 1
    reasons = {r["reason"] for r in unsupported_category(df).collect()}
    assert reasons == {"Unsupported data category: ", "Unsupported data category: x"}
