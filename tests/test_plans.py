"""Physical-plan properties of the reports (read from the executed plan)."""

import fnmatch
import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.conftest import SF0001


def executed_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString() + "\n" + qe.explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def q():
    return entry.queries()


SQL_REPORTS = [
    "month_top3_df", "month_top3_sql", "daypart_df", "descent_by_income", "distance_by_year_area",
    "distance_by_division_area", "distance_by_year_nearest", "distance_by_division_nearest",
]


@pytest.mark.parametrize("key", SQL_REPORTS)
def test_reports_have_no_python_udf(spark, q, key):
    plan = executed_plan(q[key](spark, SF0001))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("key", ["month_top3_df", "month_top3_sql"])
def test_top_k_per_year_limits_before_the_shuffle(spark, q, key):
    plan = executed_plan(q[key](spark, SF0001))
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("key", ["distance_by_year_area", "distance_by_division_area"])
def test_station_join_is_broadcast(spark, q, key):
    plan = executed_plan(q[key](spark, SF0001))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_nearest_is_solved_in_place(spark, q):
    final = executed_plan(q["nearest_station"](spark, SF0001))
    assert "MapInArrow" in final and "Join" not in final and "Exchange" not in final


def test_q3_joins_before_it_aggregates(spark, q):
    plan = q["descent_by_income"](spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate [descent") < plan.index("Join Inner")
    assert "lat#" not in plan[plan.index("Aggregate [descent"):].split("\n")[0]


@pytest.mark.parametrize("report", ["distance_by_year_area", "distance_by_division_area", "distance_by_division_nearest"])
@pytest.mark.parametrize("hint,node", [("merge", "SortMergeJoin"), ("shuffle_hash", "ShuffledHashJoin")])
def test_station_reports_follow_the_hint(spark, q, report, hint, node):
    assert node in q[f"{report}_{hint}"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()


def test_year_filter_reaches_parquet(spark, q):
    plan = executed_plan(q["descent_by_income"](spark, SF0001))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate,1997-01-01", plan)
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(o_orderdate,1998-01-01", plan)


def test_scans_read_only_needed_columns(spark, q):
    plan = executed_plan(q["month_top3_df"](spark, SF0001))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan


def test_premise_filter_pushed(spark, q):
    plan = executed_plan(q["daypart_df"](spark, SF0001))
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan


@pytest.mark.parametrize("key", ["month_top3_df", "daypart_df", "descent_by_income", "distance_by_year_area",
                                 "distance_by_division_area", "distance_by_year_nearest",
                                 "distance_by_division_nearest"])
def test_reports_scan_the_fact_once(spark, q, key):
    df = q[key](spark, SF0001)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
    assert final.count("orders.parquet") == 1


def test_coverage_names_what_exists():
    """Keys and tests of COVERAGE.md's last column, and the helpers named with a file."""
    root = Path(__file__).resolve().parent.parent
    tests = "".join(p.read_text() for p in root.glob("tests/test_*.py"))
    for line in (root / "COVERAGE.md").read_text().splitlines():
        for name in re.findall(r"`([a-z0-9_*]+)`", line.split("|")[-2]) if line.startswith("|") else []:
            assert fnmatch.filter(entry.queries(), name) or f"def {name}(" in tests, name
        for path, name in re.findall(r"`(\w+/\w+\.py): (\w+)", line):
            assert f"def {name}(" in (root / "precinct" / path).read_text(), name
