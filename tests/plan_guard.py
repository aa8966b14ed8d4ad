"""What no registered query's final plan may hold."""

#: The KNN multiplies blocks of vectors in a grouped pandas function.
BLOCKS_ALLOWED = ("knn_", "blend_", "direct_ranking", "direct_route", "area_search_model")


def check_plan(name, df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan  # pairs are never emitted
    assert "BroadcastNestedLoopJoin" not in plan  # one-row values travel as scalar subqueries
    assert "BatchEvalPython" not in plan
    if not name.startswith(BLOCKS_ALLOWED):
        for node in ("InPandas", "MapInArrow", "ArrowEvalPython", "AggregateInPandas", "WindowInPandas"):
            assert node not in plan, node
    return plan
