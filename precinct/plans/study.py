"""What a report did under a join strategy, as rows: the nodes of the plan that
ran, what its exchanges moved, and the time it took.

Figures come from the executed plan (with adaptive execution, the final one) and
the metrics of its nodes; nothing is parsed from text.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

#: The node that a hint asks for.
NODES = {"broadcast": "BroadcastHashJoin", "merge": "SortMergeJoin", "shuffle_hash": "ShuffledHashJoin"}
JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "CartesianProduct", "BroadcastNestedLoopJoin")
SCHEMA = (
    "report string, hint string, cores int, n_rows bigint, joins map<string,int>, exchanges int, broadcasts int, "
    "shuffle_bytes bigint, broadcast_bytes bigint, scans int, seconds double"
)


def _nodes(plan) -> Iterable:
    """The nodes of an executed plan, through stages and subqueries' wrappers."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from _nodes(plan.executedPlan())
        return
    if kind.endswith("QueryStageExec"):
        yield from _nodes(plan.plan())
        return
    yield plan
    children = plan.children()
    for k in range(children.size()):
        yield from _nodes(children.apply(k))


def _metric(node, name: str) -> int:
    found = node.metrics().get(name)
    return int(found.get().value()) if found.isDefined() else 0


def executed(df: DataFrame) -> dict:
    """Runs ``df`` into no sink; counts of its plan's nodes, and seconds."""
    execution = df._jdf.queryExecution()
    began = time.perf_counter()
    # The plan itself is run, so that its metrics are those of this run.
    n_rows = execution.executedPlan().execute().count()
    seconds = time.perf_counter() - began
    kinds, shuffled, sent = Counter(), 0, 0
    for node in _nodes(execution.executedPlan()):
        name = node.getClass().getSimpleName().removesuffix("Exec")
        kinds[name] += 1
        if name == "ShuffleExchange":
            shuffled += _metric(node, "shuffleBytesWritten")
        elif name == "BroadcastExchange":
            sent += _metric(node, "dataSize")
    return {
        "n_rows": n_rows,
        "joins": {j: kinds[j] for j in JOINS if kinds[j]},
        "exchanges": kinds["ShuffleExchange"],
        "broadcasts": kinds["BroadcastExchange"],
        "shuffle_bytes": shuffled,
        "broadcast_bytes": sent,
        "scans": kinds["FileSourceScan"],
        "seconds": seconds,
    }


def study(spark: SparkSession, reports: Mapping[str, Callable[[str], DataFrame]], hints: Iterable[str]) -> DataFrame:
    """A row for each report and hint. Reports run one after the other, each once."""
    cores = spark.sparkContext.defaultParallelism
    rows = []
    for name, build in reports.items():
        for hint in hints:
            found = executed(build(hint))
            rows.append((name, hint, cores, *found.values()))
    return spark.createDataFrame(rows, SCHEMA)
