"""Exact sums, the join for heavy keys, and nearest stations by regions."""

import math
import random
import struct
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from precinct.operators import nearest_regions
from precinct.operators.exact import exact_sums, mean_of, merged, total_of
from precinct.operators.nearest import nearest_station, sphere
from precinct.operators.skew import Frequent, frequent_keys, skewed_join
from precinct.plans import reports as rp
from precinct.sources import testdata as td
from tests.conftest import SF0001
from tests.test_nearest import _world, brute, check, run
from tests.test_plans import executed_plan

# ------------------------------------------------------------ exact sums


def f32(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def numbers(seed):
    rng = random.Random(seed)
    for _ in range(400):
        yield f32(rng.choice([1, -1]) * rng.uniform(0, 1) * 10.0 ** rng.randrange(-44, 7))
    yield from (0.0, -0.0, 2.0**-149, -(2.0**-149), 16777215.0)


def bits(x):
    return struct.pack("d", x)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sums_are_exact(spark, seed):
    values = list(numbers(seed))
    df = spark.createDataFrame([(v,) for v in values], "d float")
    s = df.agg(exact_sums("d").alias("s")).select(total_of("s").alias("total"), mean_of("s").alias("mean")).first()
    total = sum(map(Fraction, values))
    assert abs(Fraction(s.total) - total) <= abs(total) * Fraction(1, 2**52)
    assert abs(Fraction(s.mean) - total / len(values)) <= abs(total / len(values)) * Fraction(1, 2**51)


def test_sums_do_not_depend_on_order_or_partitions(spark):
    values = [(k % 5, v) for k, v in enumerate(numbers(9))]
    seen = Counter()
    for parts, seed in ((1, 0), (4, 1), (13, 2), (40, 3)):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame(values, "g int, d float").repartition(parts)
        direct = df.agg(exact_sums("d").alias("s"))
        in_parts = df.groupBy("g").agg(exact_sums("d").alias("p")).agg(merged("p").alias("s"))
        for sums in (direct, in_parts):
            seen[bits(sums.select(mean_of("s")).first()[0])] += 1
    assert len(seen) == 1


def test_sums_of_nothing_and_of_what_is_no_number(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (2, 1.0), (3, 2.0), (3, None)], "g int, d float")
    got = {r.g: (r.n, r.m) for r in df.groupBy("g").agg(exact_sums("d").alias("s")).select("g", F.col("s.n").alias("n"), mean_of("s").alias("m")).collect()}
    assert got[1] == (0, None) and got[3] == (1, 2.0) and got[2][0] == 2 and math.isnan(got[2][1])
    with pytest.raises(Exception, match="below 2"):
        spark.createDataFrame([(2.0**24,)], "d float").agg(exact_sums("d")).collect()


def test_reports_have_the_same_bits_on_any_partitions(spark):
    inc, st = td.incidents(spark, SF0001), td.stations(spark, SF0001)
    for report in (rp.distance_by_year_area, rp.distance_by_division_area, rp.distance_by_year_nearest, rp.distance_by_division_nearest):
        results = {tuple((r[0], bits(r[1]), r[2]) for r in report(inc.repartition(n), st, places=None).collect()) for n in (1, 4, 13)}
        assert len(results) == 1 and results.pop()


# ------------------------------------------------------------ heavy keys


def test_summary_keeps_heavy_keys(spark):
    rng = np.random.default_rng(4)
    keys = np.concatenate([np.repeat(7, 3000), np.repeat(8, 400), rng.integers(10**6, 10**9, 6000)])
    rng.shuffle(keys)
    own = Frequent(50)
    for part in np.array_split(keys, 31):
        own.add(*np.unique(part, return_counts=True))
        own.rows += len(part)
    counts = dict(zip(own.keys.tolist(), own.counts.tolist(), strict=True))
    assert len(counts) <= 50 and own.rows == 9400
    assert 3000 - 9400 / 50 <= counts[7] <= 3000 and 400 - 9400 / 50 <= counts[8] <= 400
    df = spark.createDataFrame([(int(k),) for k in keys], "k bigint").repartition(13)
    found, rows = frequent_keys(df, ["k"], 50)
    heavy = df.where("k = 7").select(F.xxhash64("k")).first()[0]
    assert rows == 9400 and 3000 - 2 * 9400 / 50 <= found[heavy] <= 3000 and len(found) <= 50
    assert frequent_keys(df.where("k < 0"), ["k"], 50) == ({}, 0)


def skewed(spark, n=30_000):
    """A third of all rows on one place, a tenth on another, the rest spread."""
    k = F.col("id")
    place = F.when(k % 3 == 0, 5).when(k % 10 == 1, -1).otherwise(k % 5000 + 100)
    left = spark.range(n).select(k.alias("incident_id"), place.cast("double").alias("lat"), (-place).cast("double").alias("lon"))
    right = spark.range(5200).select(F.col("id").cast("double").alias("lat"), (-F.col("id")).cast("double").alias("lon"), F.col("id").alias("key"))
    return left, right.unionByName(right.where("lat = 5").withColumn("key", F.lit(-7).cast("bigint")))


@pytest.mark.parametrize("hint", ["merge", "shuffle_hash", "broadcast", None])
def test_skewed_join_is_the_join(spark, hint):
    left, right = skewed(spark, 3000)
    nulls = spark.createDataFrame([(-1, None, 1.0), (-2, None, None), (-3, -0.0, 0.0), (-4, float("nan"), 1.0)], "incident_id bigint, lat double, lon double")
    left = left.unionByName(nulls)
    right = right.unionByName(spark.createDataFrame([(None, 1.0, 1), (0.0, -0.0, 2), (float("nan"), 1.0, 3)], "lat double, lon double, key bigint"))
    got = skewed_join(left, right, ["lat", "lon"], hint=hint)
    want = left.join(right, ["lat", "lon"])
    assert got.columns == want.columns
    assert Counter(map(str, got.collect())) == Counter(map(str, want.collect()))
    assert skewed_join(left.where("false"), right, ["lat", "lon"]).count() == 0
    assert skewed_join(left, right.where("false"), ["lat", "lon"]).count() == 0


def test_no_task_gets_a_heavy_key_whole(spark):
    left, right = skewed(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        sizes = {}
        for name, joined in (("plain", left.join(right.hint("merge"), ["lat", "lon"])), ("spread", skewed_join(left, right, ["lat", "lon"], hint="merge"))):
            tasks = joined.where("key >= 0").groupBy(F.spark_partition_id()).count().collect()
            sizes[name] = sorted(r["count"] for r in tasks)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    median = sizes["spread"][len(sizes["spread"]) // 2]
    assert len(sizes["spread"]) == 24 and sizes["spread"][-1] < 2 * median
    assert sizes["plain"][-1] > 5 * median


# ------------------------------------------------------------ regions


@pytest.mark.parametrize("n_stations,regions", [(1, 4), (40, 1), (40, 7), (2000, 16), (2000, 300)])
def test_regions_find_the_nearest(spark, n_stations, regions):
    pts, sts = _world(n_stations, 300, n_stations)
    pts += [(900, -95.0, 10.0), (901, -118.2, 34.0), (902, 100.0, 400.0), (903, float("nan"), 1.0), (904, 1.0, None)]
    check(run(spark, pts, sts, method="regions", regions=regions), brute([p for p in pts if p[0] != 903], sts))


def test_regions_with_ties_crowds_and_empty_sides(spark):
    rng = random.Random(6)
    # Most stations and a third of the points crowd in one place; some repeat.
    sts = [(34 + rng.randrange(40) / 1000, -118 + rng.randrange(40) / 1000, k, f"D{k}") for k in range(600)]
    sts += [(0.0, 10.0, 700, "E"), (0.0, -10.0, 699, "W"), (None, 1.0, 1, "lost")]
    pts = [(k, 34.02, -117.98) for k in range(200)] + [(200 + k, rng.uniform(33, 35), rng.uniform(-119, -117)) for k in range(400)]
    pts += [(1000, 0.0, 0.0), (1001, 90.0, 0.0)]
    check(run(spark, pts, sts, method="regions", regions=9), brute(pts, sts))
    assert run(spark, pts, [], method="regions") == {} == run(spark, pts, [(None, 1.0, 1, "x")], method="regions")
    assert run(spark, [], sts, method="regions", regions=3) == {}


def test_regions_keep_columns_and_choose_themselves(spark):
    st = spark.createDataFrame([(k / 10, k / 10, k, f"D{k}") for k in range(50)], "y double, x double, prec int, division string")
    pt = spark.createDataFrame([(k / 7, k / 7, k, "r", 1.5, [k]) for k in range(40)], "lat double, lon double, uid int, region string, best double, near array<int>")
    one, many = nearest_station(pt, st), nearest_station(pt, st, block_rows=20)
    assert one.columns == many.columns and Counter(map(str, one.collect())) == Counter(map(str, many.collect()))
    with pytest.raises(ValueError):
        nearest_station(pt, st, method="guess")


def test_regions_read_the_fact_once_and_broadcast_nothing(spark):
    st = spark.createDataFrame([(k / 10, k / 10, k, f"D{k}") for k in range(50)], "y double, x double, prec int, division string")
    pt = td.incidents(spark, SF0001).select("incident_id", "lat", "lon")
    plan = executed_plan(nearest_station(pt, st, method="regions", regions=5))
    assert "Broadcast" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert "orders.parquet" not in plan  # what is left to read are the tagged points, solved


def test_parts_spread_a_crowded_region(spark, monkeypatch):
    """A third of the points in one region do not land in one task."""
    seen = []
    original = nearest_regions._solved

    def spied(*args):
        out = original(*args)
        seen.append(sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()))
        return out

    monkeypatch.setattr(nearest_regions, "_solved", spied)
    st = spark.createDataFrame([(float(k % 40), float(k // 40), k, "D") for k in range(1600)], "y double, x double, prec int, division string")
    pt = spark.range(9000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 5.1).otherwise(F.col("id") % 40).cast("double").alias("lat"), (F.when(F.col("id") % 3 == 0, 5.1).otherwise(F.col("id") % 37)).cast("double").alias("lon"))
    nearest_station(pt, st, method="regions", regions=16).count()
    assert seen[0][-1] < 2 * (9000 / 8) and sum(seen[0]) == 9000


def test_few_points_do_not_ask_for_many_copies_of_the_stations(spark, monkeypatch):
    """A part has at least as many points as stations."""
    seen = []
    original = nearest_regions._solved

    def spied(*args):
        out = original(*args)
        seen.append(out.select(F.spark_partition_id()).distinct().count())
        return out

    monkeypatch.setattr(nearest_regions, "_solved", spied)
    st = spark.createDataFrame([(float(k % 40), float(k // 40), k, "D") for k in range(800)], "y double, x double, prec int, division string")
    pt = spark.range(80).select(F.col("id"), (F.col("id") % 40).cast("double").alias("lat"), (F.col("id") % 20).cast("double").alias("lon"))
    assert nearest_station(pt, st, method="regions", regions=2).count() == 80
    assert max(seen) <= 2  # one part a region, of 8 tasks


def test_curve_numbers_are_close_for_close_points():
    places = sphere(np.array([10.0, 10.0, -80.0]), np.array([20.0, 20.00001, 5.0]))
    a, b, c = nearest_regions.curve(places)
    assert abs(a - b) < abs(a - c) and 0 <= min(a, b, c) and max(a, b, c) < 1 << 51
