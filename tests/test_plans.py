"""Physical-plan guards of the library's own queries: no Python UDF and no cross
join in any; Arrow batches only where the dense algebra of concepts and
searches runs."""

import pytest

from __spark_entry__ import queries
from data_paths import SF0001

# Spark's ALS fits dominate these; their plans are covered by the ones they share.
HEAVY = {"grid_search_cv", "grid_eval_summary", "als_top_n", "als_predictions_labels",
         "als_auc", "als_confusion", "new_user_top_n", "new_user_fold_in"}
# The training-data operators may be removed; they have tests of their own.
OWN = {name for name in queries() if not name.startswith("op") and name != "pipeline"}
# Blocks of vectors are searched in Arrow batches.
BATCHES = {"keyword_search", "keyword_search_work", "run_report"}
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
             "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(OWN - HEAVY))
def test_plan_without_python_rows_or_cross_join(spark, name):
    df = queries()[name](spark, SF0001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    if name not in BATCHES:
        assert "MapInArrow" not in plan and "PythonMapInArrow" not in plan, name


def test_scan_prunes_columns_and_pushes_filters(spark):
    from tessera.plans import tables as TB

    plan = TB.hash_sample_plays(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double>" in plan


def test_lemma_tokens_are_not_shuffled_by_term(spark):
    """The changed lemmas are a written table of known size, joined where the tokens lie."""
    plan = queries()["lemma_tokens"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
