"""Type inference, quarantine, incremental loads and interval joins."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from precinct.functions.temporal import day_part_py
from precinct.operators.exact import exact_sums, mean_of, merged
from precinct.operators.intervals import HIGHEST, LOWEST, Cells, interval_join
from precinct.plans import reports as rp
from precinct.sources import csv as src_csv
from precinct.sources import inference, quarantine
from precinct.sources import testdata as td
from precinct.sources.incremental import Store, plain_path
from tests.conftest import SF0001


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as file:
        file.write(text)


# ------------------------------------------------------------ inference


def types_of(df):
    return {r["column"]: (r["type"], r["n_values"], r["rejects"]) for r in df.collect()}


def test_types_of_texts(spark):
    columns = {
        "i": ["1", " -2 ", "+3", "", None], "big": ["1", "9999999999", "0", None, " "], "d": ["1", ".5", "2e3", "-4.", None],
        "date": ["2020-01-01", "1999-12-31", None, None, ""], "odd": ["2020-02-30", "1", "x", "", None],
        "ts": ["01/02/2020 12:00:00 AM", "12/31/1999 11:59:59 PM", None, None, None], "b": ["true", "FALSE", None, "", ""],
        "none": [None, "", "  ", None, None], "nan": ["NaN", "1", "2", "3", "4"], "f": ["1f", "2d", "3", "4", "5"],
    }
    raw = spark.createDataFrame(list(zip(*columns.values(), strict=True)), [f"{c} string" for c in columns] and ", ".join(f"{c} string" for c in columns))
    got = types_of(inference.infer_types(raw))
    assert {c: t for c, (t, _, _) in got.items()} == {
        "i": "int", "big": "bigint", "d": "double", "date": "date", "odd": "string", "ts": "timestamp", "b": "boolean",
        "none": "string", "nan": "string", "f": "string",
    }
    assert got["i"] == ("int", 3, 0) and got["none"] == ("string", 0, 0)
    tolerant = types_of(inference.infer_types(raw, 0.4))
    assert tolerant["nan"] == ("int", 5, 1) and tolerant["f"] == ("int", 5, 2) and tolerant["big"] == ("int", 3, 1)
    assert types_of(inference.infer_types(raw.where("false")))["i"] == ("string", 0, 0)


def test_types_over_files_with_different_headers(spark, tmp_path):
    folder = str(tmp_path / "mixed")
    put(folder, "a.csv", "x,AREA ,only a\n1,7,z\n2,8,\n")
    put(folder, "b.csv", "AREA,x\n9.5,3\n,99999999999\n")
    put(folder, "c.csv", "")
    assert types_of(inference.infer_csv(spark, folder)) == {"x": ("bigint", 4, 0), "AREA": ("double", 3, 0), "only a": ("string", 1, 0)}
    rows = inference.read_csv_inferred(spark, folder)
    assert dict(rows.dtypes) == {"x": "bigint", "AREA": "double", "only a": "string"}
    assert Counter(map(str, rows.select("x", "AREA", "only a").collect())) == Counter(
        map(str, spark.createDataFrame([(1, 7.0, "z"), (2, 8.0, None), (3, 9.5, None), (99999999999, None, None)], rows.select("x", "AREA", "only a").schema).collect())
    )
    put(str(tmp_path / "none"), "c.csv", "")
    assert inference.infer_csv(spark, str(tmp_path / "none")).count() == 0
    assert inference.read_csv_inferred(spark, str(tmp_path / "none")).count() == 0


def test_inference_is_one_aggregation(spark):
    raw = td.incidents(spark, SF0001).select(F.col("incident_id").cast("string"), "premis")
    plan = inference.infer_types(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Scan parquet" in plan and plan.count("Scan parquet") == 1


# ------------------------------------------------------------ quarantine

HEAD = "DR_NO,DATE OCC,TIME OCC,AREA ,LAT,LON,Vict Descent\n"


def test_quarantine(spark, tmp_path):
    folder = str(tmp_path / "dirty")
    put(folder, "a.csv", HEAD + "1,01/02/2020 12:00:00 AM,1200,3,34.0,-118.0,W\n2,nonsense,12h,3,,-118.0,\n")
    put(folder, "b.csv", "AREA,DR_NO\nx,3\n4,\n")
    got = quarantine.load_with_quarantine(spark, folder)
    assert {tuple(r) for r in got.rejections.collect()} == {
        (2, "occ_date", "nonsense", "not a date"), (2, "time_occ", "12h", "not a int"), (3, "area", "x", "not a int"),
    }
    assert got.counts == {c: 0 for c in src_csv.INCIDENT_SCHEMA} | {"rows": 4, "rejected_rows": 2, "occ_date": 1, "time_occ": 1, "area": 1}
    assert sorted(r.incident_id for r in got.rows.where("incident_id is not null").collect()) == [1, 2, 3]
    assert Counter(r.incident_id for r in got.clean.collect()) == Counter([1, None])
    assert got.rows.columns == list(src_csv.INCIDENT_SCHEMA) == got.clean.columns
    want = Counter(map(str, src_csv.read_incidents_csv(spark, folder).collect()))
    assert Counter(map(str, got.rows.collect())) == want
    put(str(tmp_path / "none"), "c.csv", "")
    none = quarantine.load_with_quarantine(spark, str(tmp_path / "none"))
    assert none.rows.count() == none.rejections.count() == none.counts["rows"] == 0


# ------------------------------------------------------------ incremental


def test_updates_read_new_and_changed_files_only(spark, tmp_path):
    source, reads = str(tmp_path / "in"), []

    def read(session, paths):
        reads.append(sorted(os.path.basename(p) for p in paths))
        return session.read.schema("g string, d float").csv(paths)

    store = Store(spark, str(tmp_path / "store"), read, [F.col("g")], [exact_sums("d").alias("s")])

    def means():
        whole = store.current(source).groupBy("g").agg(merged("s").alias("s"))
        return {r.g: (r.n, r.m) for r in whole.select("g", F.col("s.n").alias("n"), mean_of("s").alias("m")).collect()}

    os.makedirs(source)
    assert store.update(source) == [] and store.current(source) is None
    put(source, "a b+c%.csv", "x,1\nx,2\ny,5\n")
    assert [os.path.basename(p) for p in store.update(source)] == ["a b+c%.csv"]
    assert means() == {"x": (2, 1.5), "y": (1, 5.0)}
    put(os.path.join(source, "sub"), "two.csv", "x,6\n")
    store.update(source)
    assert means() == {"x": (3, 3.0), "y": (1, 5.0)}
    assert store.update(source) == []
    put(source, "a b+c%.csv", "y,7\ny,8\ny,9\nz,1\n")  # another length
    store.update(source)
    assert means() == {"x": (1, 6.0), "y": (3, 8.0), "z": (1, 1.0)}
    os.remove(os.path.join(source, "sub", "two.csv"))
    store.update(source)
    assert means() == {"y": (3, 8.0), "z": (1, 1.0)}
    assert reads == [["a b+c%.csv"], ["two.csv"], ["a b+c%.csv"]]


def test_partials_without_a_manifest_do_not_count(spark, tmp_path):
    """A crash between the two writes leaves partial results of no generation."""
    source = str(tmp_path / "in")
    put(source, "a.csv", "x,1\n")
    store = Store(spark, str(tmp_path / "store"), lambda s, p: s.read.schema("g string, d float").csv(p), [F.col("g")], [F.count(F.lit(1)).alias("n")])
    lost = spark.createDataFrame([("nowhere", "x", 99)], "file string, g string, n bigint")
    lost.write.parquet(str(tmp_path / "store" / "partials" / "generation=gdead"))
    store.update(source)
    assert [(r.g, r.n) for r in store.current(source).collect()] == [("x", 1)]


def test_paths_have_one_spelling(spark):
    df = spark.createDataFrame([("file:///a%20b/c+d%25.csv", "file:/a b/c+d%.csv")], "e string, p string")
    a, b = df.select(plain_path(F.col("e"), True), plain_path(F.col("p"), False)).first()
    assert a == b == "file:/a b/c+d%.csv"


# ------------------------------------------------------------ intervals


def cases(seed, n):
    rng = random.Random(seed)
    ends = [None, None, LOWEST, HIGHEST, 0, -1, *[rng.randrange(-50, 50) for _ in range(12)], rng.randrange(-(10**15), 10**15)]
    intervals = [(rng.choice(ends), rng.choice(ends), f"i{k}", k) for k in range(n)]
    values = [None, LOWEST, HIGHEST, *range(-52, 52), *[e for e in ends if e is not None]]
    return intervals + intervals[:1], [(k, v) for k, v in enumerate(values)]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("max_index", [0, 1000])
@pytest.mark.parametrize("case", [(1, 0), (2, 1), (3, 25)])
def test_interval_join(spark, case, max_index, how):
    intervals, values = cases(*case)
    table = spark.createDataFrame(intervals if case[1] else [], "low bigint, high bigint, label string, band int")
    rows = spark.createDataFrame(values, "width int, v bigint")
    got = interval_join(rows, "v", table, how=how, max_index=max_index)
    want = Counter()
    for k, v in values:
        held = [
            (label, b) for low, high, label, b in (intervals if case[1] else [])
            if v is not None and (low is None or low <= v) and (high is None or v <= high)
        ]
        want.update((k, v, *h) for h in (held or ([(None, None)] if how == "left" else [])))
    assert Counter(map(tuple, got.collect())) == want


def test_cells_hold_what_contains_them():
    intervals = [(0, 5), (None, 2), (4, None), (3, 1), (2, 2)]
    cells = Cells(intervals)
    for v in range(-3, 9):
        assert cells.of(v) == [k for k, (a, b) in enumerate(intervals) if (a is None or a <= v) and (b is None or v <= b)]


def test_day_parts_from_a_table(spark):
    rows = spark.createDataFrame([(t,) for t in (None, *range(-5, 2405))], "time_occ int")
    got = {r.time_occ: r.day_part for r in rp.with_day_part_of(rows, rp.day_part_table(spark)).collect()}
    assert got == {t: day_part_py(t) for t in (None, *range(-5, 2405))}
    plan = rp.with_day_part_of(rows, rp.day_part_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
