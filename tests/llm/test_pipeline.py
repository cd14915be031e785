"""The stages one after the other, and every registered query on the smallest tables."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from leafmill.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_run_gives_their_result(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        path = str(tmp_path / name.replace(" ", "-"))
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        if name != "mixing sources":
            assert 0.8 * before <= docs.count() <= before
        before = docs.count()
    last = cp.STAGES[-1][1](spark, docs, SF_DIR)
    got = cp.run(spark, SF_DIR)
    assert {r["doc_id"] for r in got.collect()} == {r["doc_id"] for r in last.collect()}


def test_stages_of_no_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("doc_id < 0")
    for _, stage in cp.STAGES:
        assert stage(spark, docs, SF_DIR).collect() == []


def test_each_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert {"pipeline", *QUERIES} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_plan_has_a_cross_join_and_native_ones_no_python(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "BroadcastNestedLoopJoin" not in plan
    if int(name[2:].split("_")[0]) in (1, 2, 4, 7, 8):
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
