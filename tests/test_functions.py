"""Column functions on hand-made rows (semantics ledger cases)."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from precinct.functions.geo import haversine_km, haversine_km_f32, not_null_island
from precinct.functions.temporal import (
    ORIGINAL_DAY_PART_LABELS,
    day_part,
    day_part_py,
    parse_date,
    parse_timestamp,
    year_range,
)
from precinct.functions.text import format_fixed, parse_money, zip5

BOUNDARIES = {
    0: "night", 459: "night", 460: "unclassified", 499: "unclassified", 500: "morning",
    1159: "morning", 1160: "unclassified", 1199: "unclassified", 1200: "afternoon",
    1659: "afternoon", 1660: "unclassified", 1699: "unclassified", 1700: "evening",
    2059: "evening", 2060: "unclassified", 2099: "unclassified", 2100: "night", 2359: "night",
    9999: "night", -5: "night", None: "unclassified",
}


def test_day_part_boundaries(spark):
    df = spark.createDataFrame([(t,) for t in BOUNDARIES], "t int")
    got = dict(df.select("t", day_part("t").alias("p")).collect())
    assert got == BOUNDARIES


def test_day_part_python_twin_matches_expression(spark):
    rng = random.Random(7)
    values = [rng.randint(-100, 2500) for _ in range(2000)] + [None]
    df = spark.createDataFrame([(t,) for t in values], "t int")
    for t, p in df.select("t", day_part("t")).collect():
        assert p == day_part_py(t)


def test_day_part_original_labels(spark):
    df = spark.createDataFrame([(600,), (470,)], "t int")
    got = [r[0] for r in df.select(day_part("t", ORIGINAL_DAY_PART_LABELS)).collect()]
    assert got == [ORIGINAL_DAY_PART_LABELS["morning"], ORIGINAL_DAY_PART_LABELS["unclassified"]]


def _py_haversine(lat1, lon1, lat2, lon2):
    lat1, lon1, lat2, lon2 = map(math.radians, (lat1, lon1, lat2, lon2))
    a = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 6371.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(max(0.0, 1 - a)))


def test_haversine_matches_python_formula(spark):
    rng = random.Random(42)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180), rng.uniform(-90, 90), rng.uniform(-180, 180))
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = df.select("a", "b", "c", "d", haversine_km("a", "b", "c", "d").alias("km"),
                    haversine_km_f32("a", "b", "c", "d").alias("f")).collect()
    for a, b, c, d, km, f in got:
        ref = _py_haversine(a, b, c, d)
        assert km == pytest.approx(ref, rel=1e-12, abs=1e-9)
        assert f == pytest.approx(ref, rel=1e-6)


def test_haversine_antipodes_are_finite(spark):
    rows = [(float(lat), 0.0, float(-lat), 180.0) for lat in range(-89, 90)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    for (km,) in df.select(haversine_km("a", "b", "c", "d")).collect():
        assert km is not None and not math.isnan(km)
        assert km == pytest.approx(math.pi * 6371.0, rel=1e-7)


def test_haversine_zero_and_null(spark):
    df = spark.createDataFrame([(34.0, -118.0, 34.0, -118.0), (None, -118.0, 34.0, -118.0)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert got == [0.0, None]


def test_not_null_island(spark):
    rows = [(34.0, -118.0), (0.0, -118.0), (34.0, 0.0), (0.0, 0.0), (None, -118.0), (34.0, None)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    kept = df.where(not_null_island()).collect()
    assert [tuple(r) for r in kept] == [(34.0, -118.0)]


def test_zip5(spark):
    rows = [("90001",), ("90001-1234",), ("9000",), ("abcde",), (None,), (" 9000",)]
    df = spark.createDataFrame(rows, "z string")
    got = [r[0] for r in df.select(zip5("z")).collect()]
    assert got == [90001, 90001, 9000, None, None, 9000]


def test_zip5_of_number(spark):
    df = spark.createDataFrame([(90001,), (900011234,)], "z bigint")
    assert [r[0] for r in df.select(zip5("z")).collect()] == [90001, 90001]


def test_parse_money_orders_numerically(spark):
    rows = [("$9,887",), ("$33,887",), ("$110,887",), ("12345.5",), ("n/a",), (None,)]
    df = spark.createDataFrame(rows, "m string")
    got = [r[0] for r in df.select(parse_money("m")).collect()]
    assert got == [9887.0, 33887.0, 110887.0, 12345.5, None, None]
    ordered = [r[0] for r in df.where(parse_money("m").isNotNull()).orderBy(parse_money("m").desc()).collect()]
    assert ordered == ["$110,887", "$33,887", "12345.5", "$9,887"]


def test_parse_timestamp_12_hour_clock(spark):
    rows = [("03/01/2015 12:00:00 AM",), ("03/01/2015 12:00:00 PM",), ("12/31/2019 11:59:59 PM",),
            ("not a date",), ("13/45/2015 01:00:00 AM",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    got = [tuple(r) for r in df.select(parse_timestamp("s"), parse_date("s")).collect()]
    assert got[0] == (dt.datetime(2015, 3, 1, 0, 0), dt.date(2015, 3, 1))
    assert got[1] == (dt.datetime(2015, 3, 1, 12, 0), dt.date(2015, 3, 1))
    assert got[2] == (dt.datetime(2019, 12, 31, 23, 59, 59), dt.date(2019, 12, 31))
    assert got[3:] == [(None, None)] * 3


def test_year_range_is_half_open(spark):
    rows = [(dt.date(2014, 12, 31),), (dt.date(2015, 1, 1),), (dt.date(2015, 12, 31),), (dt.date(2016, 1, 1),),
            (None,)]
    df = spark.createDataFrame(rows, "d date")
    got = [r[0] for r in df.where(year_range("d", 2015)).collect()]
    assert got == [dt.date(2015, 1, 1), dt.date(2015, 12, 31)]


def test_format_fixed(spark):
    df = spark.createDataFrame([(1234567.891249,), (29.71774,), (None,)], "x double")
    got = [r[0] for r in df.select(format_fixed("x", 4)).collect()]
    assert got == ["1,234,567.8912", "29.7177", None]


def test_expressions_are_native(spark):
    df = spark.createDataFrame([(34.0, -118.0, 600)], "lat double, lon double, t int")
    out = df.select(day_part("t"), haversine_km("lat", "lon", F.lit(33.0), F.lit(-117.0)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
