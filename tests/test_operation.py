"""Lifetimes, previews, elected formats and the study of plans."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from precinct.lifetimes import named_view, released, sent
from precinct.operators.nearest import nearest_station
from precinct.operators.preview import preview
from precinct.plans import reports as rp
from precinct.plans.study import NODES, study
from precinct.sources import formats
from precinct.sources import testdata as td
from tests.conftest import SF0001


def test_no_broadcast_is_left_after_a_query(spark):
    near = lambda: nearest_station(td.incidents(spark, SF0001), td.stations(spark, SF0001))
    with released() as own:
        with released() as inner:
            rows = near().count()
            assert len(inner) == 1 and not own
        assert rows and len(inner) == 1
        with pytest.raises(Exception, match="destroy"):
            inner[0].unpersist()
        near()
        assert len(own) == 1
    with pytest.raises(ZeroDivisionError), released() as own:
        sent(spark, [1])
        raise ZeroDivisionError
    with pytest.raises(Exception, match="destroy"):
        own[0].unpersist()
    assert near().count() == rows  # outside of a block a broadcast stays usable


def test_named_view(spark):
    inc = td.incidents(spark, SF0001)
    got = rp.month_top3_view(inc, 2, "some_view")
    assert not spark.catalog.tableExists("some_view")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, rp.month_top3(inc, 2).collect()))
    with named_view(inc, "some_view"):
        with pytest.raises(Exception, match="some_view"), named_view(inc, "some_view"):
            pass
        assert spark.table("some_view").count() == inc.count()


def test_preview_is_the_same_each_time(spark):
    df = spark.createDataFrame([(k % 7 or None, f"t{k}", k) for k in range(500)], "a int, b string, digest int")
    one = [tuple(r) for r in preview(df).collect()]
    for parts in (1, 3, 40):
        assert [tuple(r) for r in preview(df.repartition(parts)).collect()] == one
    assert len(one) == 20 and preview(df, ["b"], 7).columns == df.columns
    assert preview(df.limit(3)).count() == 3 and preview(df.where("false")).count() == 0
    plan = preview(df)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_files_elect_their_format(spark):
    days = [dt.datetime(2020, 3, d, 13, 5) for d in (1, 5, 13, 28)]
    us, eu, iso = ("%m/%d/%Y %I:%M:%S %p", "%d/%m/%Y %I:%M:%S %p", "%Y-%m-%d %H:%M:%S")
    rows = [(f, d.strftime(layout), d) for f, layout in (("us", us), ("eu", eu), ("iso", iso)) for d in days]
    rows += [("tie", "03/04/2020 01:00:00 AM", dt.datetime(2020, 3, 4, 1)), ("us", "junk", None), ("us", "13/03/2020 01:05:00 PM", None)]
    rows += [("us", "", None), ("none", None, None), ("none", " ", None), (None, "2020-03-01 00:00:00", dt.datetime(2020, 3, 1))]
    df = spark.createDataFrame([(*r, 1) for r in rows], "file string, stamp string, want timestamp, format int")
    got = formats.parsed(df, "stamp", "file", "got")
    assert got.columns == [*df.columns, "got"]
    assert got.where(~F.col("want").eqNullSafe(F.col("got"))).collect() == [] and got.count() == len(rows)
    chosen = {r.file: (r.format, r.rejects) for r in formats.elected(formats.votes(df, "stamp", "file")).collect()}
    assert chosen == {"us": (0, 2), "eu": (1, 0), "iso": (2, 0), "tie": (0, 0), "none": (0, 0), None: (2, 0)}


def test_study_tells_the_nodes_that_ran(spark):
    inc, geo, income, st = (getattr(td, n)(spark, SF0001) for n in ("incidents", "revgeo", "income", "stations"))
    reports = {
        "q3": lambda hint: rp.descent_by_income(inc, geo, income, 1997, hint=hint),
        "q4": lambda hint: rp.distance_by_year_area(inc, st, hint=hint),
    }
    rows = {(r.report, r.hint): r for r in study(spark, reports, NODES).collect()}
    assert len(rows) == 6 and all(r.seconds > 0 and r.scans > 0 for r in rows.values())
    for hint, node in NODES.items():
        assert rows["q4", hint].joins == {node: 1} and rows["q4", hint].n_rows == 7
        assert node in rows["q3", hint].joins
    few, many = rows["q3", "broadcast"], rows["q3", "merge"]
    assert few.shuffle_bytes < many.shuffle_bytes and few.broadcasts and few.broadcast_bytes > 0


def test_study_of_a_report_without_a_join(spark):
    inc = td.incidents(spark, SF0001)
    (row,) = study(spark, {"q1": lambda hint: rp.month_top3(inc)}, ["none"]).collect()
    assert row.joins == {} and row.exchanges >= 1 and row.cores == spark.sparkContext.defaultParallelism


def test_rdd_chain_is_the_report(spark):
    inc = td.incidents(spark, SF0001)
    for premis in ("1-URGENT", "none"):
        assert rp.daypart_counts_rdd(inc, premis).collect() == rp.daypart_counts(inc, premis).collect()


def test_q3_joins_the_fact_where_it_is_read(spark):
    """No exchange between the fact's scan and the aggregate."""
    df = entry.queries()["descent_by_income"](spark, SF0001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial")[0]
    lines = plan.split("\n")
    scan = next(k for k, line in enumerate(lines) if "o_orderdate" in line and "Scan parquet" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    above, at = [], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < at:
            above.append(line)
            at = depth(line)
    first = next(k for k, line in enumerate(above) if "Aggregate" in line)
    assert any("BroadcastHashJoin" in line for line in above[:first])
    assert not any("Exchange" in line or "ShuffleQueryStage" in line for line in above[:first])
