"""Filters, joins, ranking and set operators on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from precinct.operators import filters as flt
from precinct.operators import joins as jn
from precinct.operators.ranking import extremes, top_k, top_k_per_group

INC_SCHEMA = "incident_id long, lat double, lon double, weapon_cd int, descent string"


def _inc(spark):
    rows = [
        (1, 34.0, -118.0, 100, "H"), (2, 0.0, -118.0, 150, "W"), (3, 34.0, 0.0, 199, None),
        (4, None, -118.0, 120, "B"), (5, 34.1, -118.2, 99, "H"), (6, 34.1, -118.2, 200, "W"),
        (7, 34.1, -118.2, None, "O"), (8, 34.0, -118.0, 199, "H"),
    ]
    return spark.createDataFrame(rows, INC_SCHEMA)


def ids(df):
    return sorted(r["incident_id"] for r in df.collect())


def test_filters(spark):
    inc = _inc(spark)
    assert ids(flt.filter_null_island(inc)) == [1, 5, 6, 7, 8]
    assert ids(flt.filter_code_range(inc, "weapon_cd", 100, 200)) == [1, 2, 3, 4, 8]
    assert ids(flt.filter_not_null(inc, "descent")) == [1, 2, 4, 5, 6, 7, 8]
    assert ids(flt.filter_equals(inc, "descent", "H")) == [1, 5, 8]
    assert ids(flt.filter_isin(inc, "descent", ["W", "B"])) == [2, 4, 6]
    assert ids(flt.firearm_incidents(inc)) == [1, 8]


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "inc")
    _inc(spark).write.parquet(path)
    df = flt.firearm_incidents(spark.read.parquet(path)).select("incident_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lat), IsNotNull(lon), IsNotNull(weapon_cd), Not(EqualTo(lat,0.0))" in plan
    assert "ReadSchema: struct<incident_id:bigint,lat:double,lon:double,weapon_cd:int>" in plan


def test_coordinate_joins_agree_and_duplicates_multiply(spark):
    inc = _inc(spark).select("incident_id", "lat", "lon")
    geo = spark.createDataFrame(
        [(34.0, -118.0, "90001"), (34.0, -118.0, "90002-0001"), (34.1, -118.2, "90003"), (-0.0, -118.0, "90009")],
        "lat double, lon double, zip string",
    )
    a = jn.join_coords_expr(inc, geo)
    b = jn.join_coords_using(inc, geo)
    assert sorted(a.columns) == sorted(b.columns)
    rows_a = sorted(tuple(r[c] for c in sorted(a.columns)) for r in a.collect())
    rows_b = sorted(tuple(r[c] for c in sorted(b.columns)) for r in b.collect())
    assert rows_a == rows_b
    # the duplicate (34.0, -118.0) geocode doubles incidents 1 and 8; -0.0 joins 0.0
    assert sorted(r["incident_id"] for r in a.collect()) == [1, 1, 2, 5, 6, 7, 8, 8]


@pytest.mark.parametrize("hint", [None, *jn.JOIN_HINTS])
def test_hints_do_not_change_rows(spark, hint):
    inc = _inc(spark).select("incident_id", "lat", "lon")
    geo = spark.createDataFrame([(34.0, -118.0, "90001"), (34.1, -118.2, "90003")], "lat double, lon double, zip string")
    got = sorted(tuple(r) for r in jn.join_coords_using(inc, geo, hint=hint).select("incident_id", "zip").collect())
    assert got == [(1, "90001"), (5, "90003"), (6, "90003"), (7, "90003"), (8, "90001")]


def _join_nodes(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hint_selects_strategy(spark):
    left = spark.range(0, 1000).withColumnRenamed("id", "k")
    right = spark.range(0, 100).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in _join_nodes(left.join(jn.hinted(right, "broadcast"), "k"))
        assert "SortMergeJoin" in _join_nodes(left.join(jn.hinted(right, "merge"), "k"))
        assert "ShuffledHashJoin" in _join_nodes(left.join(jn.hinted(right, "shuffle_hash"), "k"))
        assert "CartesianProduct" in _join_nodes(left.join(jn.hinted(right, "shuffle_replicate_nl"), "k"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_checked_broadcast_refuses_large_side(spark):
    small, big = spark.range(5), spark.range(50)
    assert jn.fits(small, 5) and not jn.fits(big, 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _join_nodes(spark.range(100).join(jn.checked_broadcast(big, 5), "id"))
        assert "BroadcastHashJoin" not in plan
        plan = _join_nodes(spark.range(100).join(jn.checked_broadcast(small, 5), "id"))
        assert "BroadcastHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unknown_hint(spark):
    with pytest.raises(ValueError):
        jn.hinted(spark.range(1), "nested_loop")


def test_zip_and_area_joins(spark):
    located = spark.createDataFrame([(1, "90001-1234"), (2, "90002"), (3, "x")], "incident_id long, zip string")
    income = spark.createDataFrame([(90001, 10), (90002, 20), (90002, 21)], "zip_code int, median_income bigint")
    got = sorted(tuple(r) for r in jn.join_zip_income(jn.with_zip_code(located), income)
                 .select("incident_id", "median_income").collect())
    assert got == [(1, 10), (2, 20), (2, 21)]
    inc = spark.createDataFrame([(1, 3), (2, 4), (3, None)], "incident_id long, area int")
    st = spark.createDataFrame([(3, "C")], "prec int, division string")
    assert [tuple(r) for r in jn.join_area_station(inc, st).select("incident_id", "division").collect()] == [(1, "C")]


def test_semi_join(spark):
    df = spark.createDataFrame([(1, 90001), (2, 90002), (3, 90001), (4, None)], "id long, zip_code int")
    keys = spark.createDataFrame([(90001,), (90001,), (None,)], "zip_code int")
    assert ids_of(jn.semi_join(df, keys, "zip_code")) == [1, 3]
    assert ids_of(jn.semi_join(df, keys, "zip_code", bounded=True)) == [1, 3]


def ids_of(df):
    return sorted(r["id"] for r in df.collect())


def test_top_k_per_group_keeps_ties(spark):
    rows = [(2015, 1, 10), (2015, 2, 9), (2015, 3, 9), (2015, 4, 8), (2015, 5, 7), (2016, 1, 5), (2016, 2, 4)]
    df = spark.createDataFrame(rows, "year int, month int, n long")
    got = sorted((r["year"], r["month"], r["rank"]) for r in top_k_per_group(df, ["year"], [F.desc("n")], 2).collect())
    assert got == [(2015, 1, 1), (2015, 2, 2), (2015, 3, 2), (2016, 1, 1), (2016, 2, 2)]
    rn = top_k_per_group(df, ["year"], [F.desc("n"), F.asc("month")], 2, fn="row_number")
    assert rn.count() == 4


def test_top_k_per_group_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("v"))
    out = top_k_per_group(df, ["g"], [F.desc("v")], 3)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_extremes_tie_break_and_nulls(spark):
    rows = [(90001, 100), (90002, 900), (90003, 900), (90004, 900), (90005, 50), (90006, None), (90007, 50),
            (90008, 500)]
    df = spark.createDataFrame(rows, "zip_code int, median_income bigint")
    top = [r[0] for r in top_k(df.where("median_income is not null"), [F.desc("median_income"), F.asc("zip_code")], 2)
           .select("zip_code").collect()]
    assert top == [90002, 90003]
    got = sorted(r[0] for r in extremes(df, "median_income", "zip_code", 3).collect())
    # top 3: 90002, 90003, 90004 (ties by zip); bottom 3: 90005, 90007, 90001; NULL never selected
    assert got == [90001, 90002, 90003, 90004, 90005, 90007]
    assert sorted(r[0] for r in extremes(df, "median_income", "zip_code", 10).collect()) == [
        90001, 90002, 90003, 90004, 90005, 90007, 90008]


def test_fits_bounds_bytes_as_well_as_rows(spark):
    wide = spark.createDataFrame([(i, "x" * 1000) for i in range(10)], "id long, s string")
    assert jn.bounded_count(wide, 100, max_bytes=None) == 10
    assert jn.bounded_count(wide, 100, max_bytes=100_000) == 10
    assert jn.bounded_count(wide, 100, max_bytes=5_000) is None
    assert jn.bounded_count(wide, 5, max_bytes=None) is None
    nested = spark.createDataFrame([([1, 2, 3], {"a": 1})], "a array<int>, m map<string,int>")
    assert jn.bounded_count(nested, 10) == 1


def test_cluster_conf():
    from precinct.session import cluster_conf

    c = cluster_conf(4000)
    assert c["spark.sql.shuffle.partitions"] == "12000" and c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert cluster_conf(8, input_bytes=100 << 40)["spark.sql.shuffle.partitions"] == str(100 << 10)


def test_an_ignored_broadcast_is_reported(spark):
    with pytest.warns(UserWarning, match="no broadcast"):
        assert jn.checked_broadcast(spark.range(50), 5).count() == 50


def test_the_size_check_shuffles_no_rows(spark):
    plan = spark.range(100).agg(F.count(F.lit(1)), F.sum(jn._row_bytes(spark.range(1))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "LocalLimit" not in text and "partial_count" in text


def test_unique_by(spark):
    st = spark.createDataFrame([(1, "a"), (2, "b")], "prec int, division string")
    assert sorted(tuple(r) for r in jn.unique_by(st, "prec").collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="prec is not unique"):
        jn.unique_by(st.union(st), "prec").collect()
