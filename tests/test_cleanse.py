import json
from datetime import date

from pyspark.sql import functions as F

from tidewell.operators import cleanse
from tidewell.registry import DIVIDENDS
from tidewell.sinks import split_documents
from tidewell.sources import read_envelopes


def record(**fields):
    names = ["symbol", "date", "dividend", "distr_freq", "payment_date", "record_date", "declaration_date"]
    return {n: None for n in names} | {"symbol": "A", "date": "2024-02-09", "dividend": 0.5} | fields


def landed(spark, path, documents, **options):
    (path / "d.json").write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in documents))
    return read_envelopes(spark, str(path), DIVIDENDS, **options)


def test_indented_documents_need_multi_line(spark, tmp_path):
    text = json.dumps({"data": [record(), record(symbol="B")]}, indent=4)
    assert cleanse.clean(landed(spark, tmp_path, [text], multi_line=True), DIVIDENDS).count() == 2
    # Read line by line nothing parses, and nothing is lost without a trace.
    parsed, corrupt = split_documents(read_envelopes(spark, str(tmp_path), DIVIDENDS))
    assert corrupt.count() == len(text.split("\n")) and parsed.count() == 0


def test_parsed_and_corrupt_make_up_the_input(spark, tmp_path):
    documents = [{"data": [record()]}, '{"data": [', {"data": []}, {"data": None}, "nonsense"]
    parsed, corrupt = split_documents(landed(spark, tmp_path, documents))
    assert (parsed.count(), corrupt.count()) == (3, 2)
    assert cleanse.clean(parsed, DIVIDENDS).count() == 1


def test_date_forms(spark, tmp_path):
    forms = {
        "2024-02-09": date(2024, 2, 9), "2024-02-15 00:00:00": date(2024, 2, 15),
        "2024-02-09T00:00:00+0000": date(2024, 2, 9), "n/a": None, "": None,
    }
    rows = landed(spark, tmp_path, [{"data": [record(symbol=k, payment_date=k) for k in forms if k] + [record(payment_date="")]}])
    found = {r["symbol"]: r["payment_dt"] for r in cleanse.clean(rows, DIVIDENDS).collect()}
    assert found == {k or "A": v for k, v in forms.items()}


def test_missing_essentials_go_and_defaults_fill(spark, tmp_path):
    rows = landed(spark, tmp_path, [{"data": [
        record(), record(symbol=None), record(date=None), record(dividend=None), record(date="bad"), record(distr_freq="Q"),
    ]}])
    found = cleanse.clean(rows, DIVIDENDS)
    assert found.columns == DIVIDENDS.columns
    assert sorted((r["distr_freq"], r["market_dt"] is None) for r in found.collect()) == [
        ("Q", False), ("Unknown", False), ("Unknown", True)
    ]


def test_quarantine_splits_without_loss(spark, tmp_path):
    rows = cleanse.prepare(landed(spark, tmp_path, [{"data": [record(), record(date="bad")]}]), DIVIDENDS)
    usable, rejected = cleanse.quarantine_bad_dates(rows, DIVIDENDS)
    assert usable.count() == 1
    assert [r["market_dt"] for r in rejected.collect()] == ["bad"]
    assert usable.unionByName(rejected).exceptAll(rows).count() == 0 and rows.where(F.lit(True)).count() == 2
