"""Composite reports: golden facts, API equivalences, invariances."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from precinct.plans import reports as rp
from precinct.sources import testdata as td
from tests.conftest import SF001


@pytest.fixture(scope="module")
def tables(spark):
    return (td.incidents(spark, SF001), td.revgeo(spark, SF001), td.income(spark, SF001),
            td.stations(spark, SF001))


# Measured, equal to the DuckDB oracle.
GOLDEN_DESCENT = [("F", 146), ("O", 165), ("P", 163)]


def rows(df, n=None):
    out = [tuple(r) for r in df.collect()]
    return out if n is None else out[:n]


def test_golden_month_top3(spark, tables):
    got = rows(rp.month_top3(tables[0]))
    assert len(got) == 22
    assert got[:3] == [(1995, 7, 230, 1), (1995, 9, 212, 2), (1995, 10, 201, 3)]
    assert (1996, 3, 211, 2) in got


def test_month_top3_df_equals_sql(spark, tables):
    assert rows(rp.month_top3(tables[0])) == rows(rp.month_top3_sql(spark, tables[0]))


def test_golden_daypart_and_rdd_twin(spark, tables):
    df = dict(rows(rp.daypart_counts(tables[0], "1-URGENT")))
    assert {k: df[k] for k in ["afternoon", "evening", "morning", "night"]} == {
        "afternoon": 537, "evening": 442, "morning": 836, "night": 977}
    assert rows(rp.daypart_counts(tables[0], "1-URGENT")) == rows(rp.daypart_counts_rdd(tables[0], "1-URGENT"))


def test_golden_descent_by_income(spark, tables):
    inc, geo, income, _ = tables
    assert sorted(rows(rp.descent_by_income(inc, geo, income, 1997))) == GOLDEN_DESCENT


@pytest.mark.parametrize("hint", ["broadcast", "merge", "shuffle_hash"])
def test_descent_by_income_hints_equal(spark, tables, hint):
    inc, geo, income, _ = tables
    assert sorted(rows(rp.descent_by_income(inc, geo, income, 1997, hint=hint))) == GOLDEN_DESCENT


def _naive_descent(incidents, revgeo, income, year, k):
    """The straightforward plan: join everything, then filter and count."""
    from precinct.functions.text import zip5

    sel = rp.selected_zips(income, k)
    geo = revgeo.withColumn("zip_code", zip5("zip"))
    j = (incidents.where(F.year("occ_date") == year).where(F.col("descent").isNotNull())
         .join(geo, ["lat", "lon"]).join(income, "zip_code").join(sel, "zip_code", "left_semi"))
    return j.groupBy("descent").agg(F.count(F.lit(1)).alias("crime_count"))


def test_descent_by_income_matches_naive_join_with_duplicates(spark):
    d = dt.date(2015, 6, 1)
    inc = spark.createDataFrame(
        [(1, d, "H", 34.0, -118.0), (2, d, "H", 34.0, -118.0), (3, d, "W", 34.0, -118.0),
         (4, d, "B", 34.1, -118.1), (5, d, None, 34.1, -118.1), (6, dt.date(2014, 1, 1), "H", 34.0, -118.0),
         (7, d, "W", 34.2, -118.2), (8, d, "H", 34.3, -118.3)],
        "incident_id long, occ_date date, descent string, lat double, lon double")
    geo = spark.createDataFrame(
        [(34.0, -118.0, "90001"), (34.0, -118.0, "90001-0002"), (34.1, -118.1, "90002"),
         (34.2, -118.2, "90003"), (34.3, -118.3, "90009")],
        "lat double, lon double, zip string")
    income = spark.createDataFrame(
        [(90001, 10), (90001, 12), (90002, 500), (90003, 40), (90004, 30), (90005, 20), (90006, 1000),
         (90009, None)],
        "zip_code int, median_income bigint")
    want = sorted(rows(_naive_descent(inc, geo, income, 2015, 2)))
    got = sorted(rows(rp.descent_by_income(inc, geo, income, 2015, 2)))
    assert got == want and got  # H: 2 incidents x 2 geocodes x 2 income rows = 8


@pytest.mark.parametrize("parts", ["1", "4", "13"])
def test_results_do_not_depend_on_partitioning(spark, tables, parts):
    inc, geo, income, st = tables
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert rows(rp.month_top3(inc)) == rows(rp.month_top3(td.incidents(spark, SF001)))
        assert sorted(rows(rp.descent_by_income(inc, geo, income, 1997))) == GOLDEN_DESCENT
        assert rows(rp.distance_by_year_nearest(inc, st), 1) == [(1995, 3.383, 480)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_golden_distances(spark, tables):
    inc, _, _, st = tables
    assert rows(rp.distance_by_year_area(inc, st), 2) == [(1995, 28.8551, 480), (1996, 29.5029, 425)]
    by_div = {r[0]: (r[1], r[2]) for r in rows(rp.distance_by_division_area(inc, st))}
    assert len(by_div) == 100 and by_div["Supplier#000000000"] == (37.8935, 37)
    assert rows(rp.distance_by_year_nearest(inc, st), 2) == [(1995, 3.383, 480), (1996, 3.472, 425)]
    near_div = {r[0]: (r[1], r[2]) for r in rows(rp.distance_by_division_nearest(inc, st))}
    assert len(near_div) == 100 and near_div["Supplier#000000000"] == (3.1001, 30)


def test_nearest_never_farther_than_responsible(spark, tables):
    inc, _, _, st = tables
    from precinct.functions.geo import haversine_km_f32
    from precinct.operators.filters import firearm_incidents
    from precinct.operators.joins import join_area_station
    from precinct.operators.nearest import nearest_station

    resp = join_area_station(firearm_incidents(inc), st).select(
        "incident_id", haversine_km_f32("lat", "lon", "y", "x").alias("resp"))
    near = nearest_station(firearm_incidents(inc).select("incident_id", "lat", "lon"), st)
    bad = near.join(resp, "incident_id").where(F.col("near_km").cast("float") > F.col("resp"))
    assert bad.count() == 0
    # every area has a station, so both reports count the same incidents
    a = sum(r[2] for r in rows(rp.distance_by_year_area(inc, st)))
    b = sum(r[2] for r in rows(rp.distance_by_year_nearest(inc, st)))
    assert a == b


def test_formatted_distance(spark, tables):
    inc, _, _, st = tables
    out = rows(rp.distance_formatted(rp.distance_by_year_area(inc, st)), 1)
    assert out == [(1995, 28.8551, 480, "28.8551")]


def test_empty_station_table(spark, tables):
    inc = tables[0]
    empty = spark.createDataFrame([], "y double, x double, division string, prec int")
    assert rp.distance_by_year_nearest(inc, empty).count() == 0
    assert rp.distance_by_year_area(inc, empty).count() == 0


@pytest.mark.parametrize("hint", ["merge", "shuffle_hash", None])
def test_station_reports_do_not_depend_on_the_join(spark, tables, hint):
    inc, _, _, st = tables
    assert rows(rp.distance_by_year_area(inc, st, hint=hint)) == rows(rp.distance_by_year_area(inc, st))
    assert rows(rp.distance_by_division_area(inc, st, hint=hint)) == rows(rp.distance_by_division_area(inc, st))
    assert rows(rp.distance_by_division_nearest(inc, st, hint=hint)) == rows(rp.distance_by_division_nearest(inc, st))
