"""Read a DataFrame's physical plan: exchanges, joins, Python nodes.

Used by the plan tests and the PLANS.md writer to keep the plan honest: no
single-partition exchange over customer-sized data, no Python UDF in the
hot path, filters reaching the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints, as a string."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


_NODES = {
    "hash_exchange": r"Exchange hashpartitioning",
    "required_hash_exchange": r"Exchange hashpartitioning\([^\n]*ENSURE_REQUIREMENTS",
    "explicit_repartition": r"Exchange [a-z]+partitioning\([^\n]*REPARTITION_BY",
    "range_exchange": r"Exchange rangepartitioning",
    "single_partition_exchange": r"Exchange SinglePartition",
    "broadcast_exchange": r"BroadcastExchange",
    "sort_merge_join": r"SortMergeJoin",
    "broadcast_hash_join": r"BroadcastHashJoin",
    "expand": r"\bExpand\b",
    "python_udf": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
    "window": r"\bWindow\b",
    "window_group_limit": r"WindowGroupLimit",
    "hash_aggregate": r"HashAggregate",
}


def plan_summary(df: DataFrame) -> dict[str, int]:
    """Counts of the plan's node kinds (initial plan, before adaptive re-planning)."""
    text = plan_text(df, "simple")
    return {name: len(re.findall(pattern, text)) for name, pattern in _NODES.items()}


def scan_filters(df: DataFrame) -> list[str]:
    """``PushedFilters`` of every file scan in the plan."""
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df, "formatted"))
