import pytest
from rows import same_rows

import corpus_pipeline
from tidewell.llm import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    same_rows(queries.queries()[name](spark, sf_dir), duck.sql(SQL[name]))


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in queries.queries()} == set(range(1, 14))
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5


@pytest.mark.parametrize("name", ["op1_license_scan", "op4_quality_rules", "op9_chat_formatting"])
def test_native_operators_run_no_python(spark, sf_dir, name):
    plan = queries.queries()[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow", "ArrowEval"))
