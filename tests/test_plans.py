"""Physical-plan checks: column expressions stay JVM-side, filters and column
selection reach the Parquet scan, and only the model call runs Python."""

import re

import pytest

import __spark_entry__ as E
from quire.plans.catalog import QUERIES

from support import SF_SMALL

# Queries that call the model (mapInPandas), run a stream or walk files.
MODEL_QUERIES = {"infer_replay", "answer_run", "stream_resume", "two_step_answer", "context_run",
                 "fact_check_run", "rewrite_run", "two_step_model", "repeat_vote", "snapshot_run", "one_group_check",
                 "compare_modes", "three_step_run", "three_rounds", "two_step_failures",
                 "context_failures", "fact_check_failures", "rewrite_failures", "infer_attempts",
                 "media_answers", "run_log", "json_array_items", "csv_blocks"}
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODEL_QUERIES))
def test_no_python_in_table_queries(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert not any(n in plan for n in PYTHON_NODES), plan


def test_model_call_is_arrow_batched(spark):
    plan = _plan(E.queries()["infer_replay"](spark, SF_SMALL))
    assert "MapInPandas" in plan and "BatchEvalPython" not in plan


def test_filter_and_projection_reach_the_scan(spark):
    plan = _plan(E.queries()["filter_group"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(conv_id), EqualTo(conv_id,7)]" in plan
    plan = _plan(E.queries()["unanswered"](spark, SF_SMALL))
    assert "EqualTo(role,user)" in plan and "EqualTo(role,assistant)" in plan
    # The answers side reads no text column.
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<conv_id:bigint,turn:bigint,role:string>" in scans


def test_model_input_is_pruned(spark):
    # Only the key and the prompt (and the group key) are shipped to Python.
    plan = _plan(E.queries()["infer_replay"](spark, SF_SMALL))
    m = re.search(r"MapInPandas \w+\(([^)]*)\)", plan)
    assert m is not None
    shipped = {c.split("#")[0].strip() for c in m.group(1).split(",")}
    assert shipped <= {"qid", "prompt", "conv_id"}


@pytest.mark.parametrize("name,partial", [("latest_prediction", "partial_max_by"),
                                          ("candidate_vote", "partial_count"),
                                          ("group_questions", "partial_min_by"),
                                          ("error_ids", "partial_count")])
def test_hot_keys_fold_map_side(spark, name, partial):
    # A key holding a third of the rows is reduced before the shuffle.
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert partial in plan


def test_only_bounded_broadcast_hint(spark):
    # The offsets table of the distributed ordinals has one row per range partition.
    from quire.operators.ordering import global_index

    df = spark.range(1000).withColumnRenamed("id", "o")
    plan = global_index(df, ["o"], partitions=4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("broadcast") <= 1
