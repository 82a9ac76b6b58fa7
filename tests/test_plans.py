"""Plan lint over every registered batch query: the shapes that break at scale."""

import pytest

from conftest import SF001

from hitlens.registry import BATCH_QUERIES

NEVER = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
         "FlatMapGroupsInPandas", "MapInPandas"]

# single-partition exchanges that carry a bounded number of rows
SINGLE_PARTITION_OK = {
    "parse_summary": "keyless aggregate: one partial row per partition",
    "content_size_stats": "keyless aggregate: one partial row per partition",
}


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_plan_has_no_unscalable_node(spark, name):
    plan = BATCH_QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    for node in NEVER:
        assert node not in plan, f"{name}: {node}"
    if "SinglePartition" in plan:
        assert name in SINGLE_PARTITION_OK, f"{name}: unexpected single-partition exchange"
    # joins, where present, are broadcasts against bounded sides
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
