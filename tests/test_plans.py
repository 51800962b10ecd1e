"""Physical plans: no cross products, pruned scans, no Python in column-only operators."""

import pytest

from opslake import registry

SF = "/root/testdata/sf0.001"
# Queries that write files or run streams when built; their result is a plain scan.
SIDE_EFFECTS = ("opslake.plans.lake",)
PYTHON = {"normalize_unicode", "chunk_unique_words", "chunk_sentences", "chunk_overlap_sentences", "extract_paragraphs",
          "first_section", "embed_batch", "topk_cosine", "rank_dot", "topk_cosine_distinct", "topk_l2", "topk_l2_sources",
          "payload_filter", "ann_candidates", "keyword_search", "excerpt_search", "hybrid_search", "token_budget",
          "token_budget_steps", "prompt_build", "source_context", "graph_context"}


def builder(key):
    return registry.queries()[key].__closure__[0].cell_contents


KEYS = [k for k in registry.queries() if builder(k).__module__ not in SIDE_EFFECTS and k != "fuzzy_groups"]


@pytest.mark.parametrize("key", KEYS)
def test_plan(spark, key):
    plan = registry.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
    if key not in PYTHON:
        for node in ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas", "PythonUDF"):
            assert node not in plan


def test_scan_is_pruned_and_filtered(spark):
    plan = registry.queries()["recent_telemetry"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "TakeOrderedAndProject" in plan
    narrow = registry.queries()["severity_counts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "user_id" not in narrow.split("ReadSchema:")[1]


def test_top_n_is_limited_before_the_shuffle(spark):
    plan = registry.queries()["last_n_messages"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
