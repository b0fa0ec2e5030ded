import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidewell.functions import batch_stem
from tidewell.operators import routing
from tidewell.registry import CATEGORIES, DIVIDENDS, SPLITS
from tidewell.schemas import CORRUPT
from tidewell.scratch import stored
from tidewell.sinks import land_batches
from tidewell.sources import decode_documents, encode_documents, path_lineage, read_with_lineage, record_types, schema_drift

GOOD = {"symbol": "A", "date": "2024-01-01", "dividend": 1.5}
TEXTS = [
    json.dumps({"data": [GOOD, {"symbol": "B"}]}), json.dumps({"data": [GOOD]}, indent=2), json.dumps({"data": []}), "{}", '{"data": null}',
    '{"data": [', "not json", "", None, json.dumps({"data": [{"symbol": "A", "dividend": "much"}]}), json.dumps({"data": [GOOD | {"new": 1}]}),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, value string")


def test_decoding_keeps_corrupt_texts_whole(texts):
    found = {r.id: r for r in decode_documents(texts, DIVIDENDS).collect()}
    assert len(found) == len(TEXTS)
    assert [len(found[i].data) for i in (0, 1, 2, 10)] == [2, 1, 0, 1] and found[1].data[0].dividend == 1.5
    assert [found[i].data for i in (3, 4, 7, 8)] == [None] * 4
    for i in (5, 6, 9):
        assert found[i][CORRUPT] == TEXTS[i]
    assert all(found[i][CORRUPT] is None for i in (0, 1, 2, 3, 4, 8, 10))


def test_encoding_and_decoding_round_trip(texts):
    whole = stored(decode_documents(texts, DIVIDENDS), "decoded").where("size(data) > 0 and _corrupt_record is null").drop(CORRUPT)
    again = decode_documents(encode_documents(whole, DIVIDENDS), DIVIDENDS)
    assert again.where(F.col(CORRUPT).isNull()).drop(CORRUPT).exceptAll(whole).count() == 0


def test_drift_names_new_and_lacking_fields(spark):
    rows = [
        (1, json.dumps({"data": [GOOD, {"distr_freq": None}]})), (1, json.dumps({"data": [{"x": {"y": 1}}, {"currency": "EUR"}]})), (1, "{"),
        (None, json.dumps({"data": [dict.fromkeys(DIVIDENDS.record.fieldNames(), "1")]})), (3, json.dumps({"data": []})), (4, "nothing"),
    ]
    found = {r.batch: tuple(r)[1:] for r in schema_drift(spark.createDataFrame(rows, "batch int, value string"), DIVIDENDS, ["batch"]).collect()}
    every = ",".join(sorted(DIVIDENDS.record.fieldNames()))
    assert found == {
        1: (3, 1, "currency,x", "declaration_date,payment_date,record_date"), None: (1, 0, "", ""), 3: (1, 0, "", every), 4: (1, 1, "", every),
    }
    types = {r.batch: r.schema for r in record_types(spark.createDataFrame(rows, "batch int, value string"), DIVIDENDS, ["batch"]).collect()}
    assert "currency: STRING" in types[1] and "y: BIGINT" in types[1]


def test_drift_parses_a_text_once_and_counts_every_copy(spark):
    rows = [(1, json.dumps({"data": [GOOD]}))] * 3 + [(1, json.dumps({"data": [GOOD | {"x": 1}]})), (1, "{"), (1, None), (2, "{")] + [(None, "{}")] * 2
    found = schema_drift(spark.createDataFrame(rows, "batch int, value string"), DIVIDENDS, ["batch"])
    every = ",".join(sorted(DIVIDENDS.record.fieldNames()))
    assert {tuple(r) for r in found.collect()} == {
        (1, 6, 2, "x", "declaration_date,distr_freq,payment_date,record_date"), (2, 1, 1, "", every), (None, 2, 2, "", every),
    }
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_paths_tell_their_request(spark):
    paths = ["s3a://b/bronze/batch_date=20240105/batch_key=dividends_20240101_20240105_20240105/part-0.json",
             "file:/x/batch_key=stock_splits_20240101_20249999_20240105/p.json", "file:/x/y.json", None]
    found = spark.createDataFrame([(p,) for p in paths], "p string").select(path_lineage(F.col("p")).alias("l")).select("l.*").collect()
    day = date(2024, 1, 5)
    assert tuple(found[0]) == ("dividends", date(2024, 1, 1), day, day, "dividends_20240101_20240105_20240105")
    assert tuple(found[1])[:4] == ("stock_splits", date(2024, 1, 1), None, day)
    assert tuple(found[2]) == tuple(found[3]) == (None,) * 5


def test_landed_batches_come_back_with_their_requests(spark, texts, tmp_path):
    documents = decode_documents(texts, DIVIDENDS).where("size(data) > 0").withColumn("batch_dt", F.date_add(F.lit("2024-01-05").cast("date"), F.col("id") * 7))
    day = F.col("batch_dt")
    root = land_batches(documents.drop("id"), str(tmp_path / "bronze"), batch_stem(F.lit("Dividends"), day, F.date_sub(day, 4), day))
    found = read_with_lineage(spark, root, DIVIDENDS).collect()
    assert len(found) == documents.count() and {r.data_cat for r in found} == {"dividends"}
    assert all((r.batch_dt - r.start_dt).days == 4 and r.end_dt == r.batch_dt and r.batch_key in r.file_path for r in found)


def test_paths_are_searched_once_a_row_for_all_parts(spark, texts, tmp_path):
    documents = decode_documents(texts, DIVIDENDS).where("size(data) > 0").drop("id").withColumn("batch_dt", F.lit("2024-01-05").cast("date"))
    root = land_batches(documents, str(tmp_path / "bronze"), F.lit("a_b_20240101_20240230_20240105"))
    found = read_with_lineage(spark, root, DIVIDENDS)
    assert {(r.data_cat, r.start_dt, r.end_dt, r.batch_dt, r.batch_key) for r in found.collect()} == {
        ("a_b", date(2024, 1, 1), None, date(2024, 1, 5), "a_b_20240101_20240230_20240105")
    }
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") == 2


def test_fan_out_reads_once_and_loses_nothing(spark, tmp_path):
    split = json.dumps({"data": [{"symbol": "S", "date": "2024-01-02", "from": 1.0, "to": 4.0}, {"symbol": None}]})
    rows = [("dividends", TEXTS[0]), ("dividends", TEXTS[5]), ("splits", split), ("earnings", "{}"), (None, None)]
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(rows, "data_cat string, value string").write.parquet(source)
    both = {c.name: c for c in (DIVIDENDS, SPLITS)}
    read = spark.read.parquet(source)
    plan = routing.with_destination(read, both)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Union" not in plan
    routing.fan_out(read, root, both)
    assert {tuple(r) for r in spark.read.parquet(root).groupBy("destination").count().collect()} == {("dividends", 2), ("splits", 1), ("_rejects", 2)}
    cleaned = routing.clean_routed(spark, root, both)
    assert [tuple(r) for r in cleaned["splits"].collect()] == [("S", date(2024, 1, 2), 1.0, 4.0, "Unknown")]
    assert [r.symbol for r in cleaned["dividends"].collect()] == ["A"] and cleaned["dividends"].columns == DIVIDENDS.columns
    plan = cleaned["splits"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(destination" in plan
    # One category alone: the other's documents are rejects.
    routing.fan_out(read, str(tmp_path / "one"), CATEGORIES)
    assert routing.routed(spark, str(tmp_path / "one"), routing.REJECTS).count() == 3

