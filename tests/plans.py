"""Reading executed plans in tests."""

from __future__ import annotations

from pyspark.sql import DataFrame


def executed_nodes(df: DataFrame) -> list:
    """Run `df` and return every physical operator that ran, each once, subqueries included.

    A reused exchange or subquery is one node of its own; what lies below it is not visited again.
    """
    execution = df._jdf.queryExecution()
    rdd = execution.toRdd()
    rdd.count()
    seen: dict[int, object] = {}

    identity = df.sparkSession._jvm.System.identityHashCode

    def visit(node) -> None:
        key = identity(node)
        if key in seen:
            return
        name = node.nodeName()
        seen[key] = node
        if name.startswith("AdaptiveSparkPlan"):
            visit(node.executedPlan())
            return
        if name.startswith(("ReusedExchange", "ReusedSubquery")):
            return
        if name.endswith("QueryStage"):
            visit(node.plan())
            return
        for i in range(node.subqueries().size()):
            visit(node.subqueries().apply(i))
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    visit(execution.executedPlan())
    return list(seen.values())


def scans(df: DataFrame, column: str) -> int:
    """How many times the plan of `df` really scans the table that has `column`."""
    return sum(
        1
        for node in executed_nodes(df)
        if node.nodeName().startswith("Scan parquet") and column in node.output().mkString(",")
    )
