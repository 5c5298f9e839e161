"""Source-layout CSV ingestion on hand-written files."""

import datetime as dt

from pyspark.sql import functions as F

from precinct.plans import reports as rp
from precinct.sources import csv as src

OLD_FILE = """DR_NO,Date Rptd,DATE OCC,TIME OCC,AREA ,Premis Desc,Weapon Used Cd,Vict Descent,LAT,LON
1,03/01/2015 12:00:00 AM,03/01/2015 12:00:00 AM,0459,1,STREET,100,H,34.0,-118.0
2,03/02/2015 12:00:00 PM,03/02/2015 12:00:00 PM,1200,2,STREET,,W,34.1,-118.1
3,13/45/2015 01:00:00 AM,not a date,,3,DWELLING,199,,0,-118.2
4,12/31/2015 11:59:59 PM,12/31/2015 11:59:59 PM,2100,1,STREET,200,B,34.0,0
"""

NEW_FILE = """LON,LAT,AREA,DATE OCC,Date Rptd,TIME OCC,Premis Desc,Vict Descent,Weapon Used Cd,DR_NO,Extra
-118.3,34.3,4,01/05/2021 08:15:00 AM,01/06/2021 09:00:00 AM,815,STREET,O,150,5,ignored
-118.4,34.4,5,02/05/2021 10:15:00 PM,02/06/2021 09:00:00 AM,2215,PARKING LOT,H,99,6,ignored
"""


def _write(tmp_path, name, text):
    d = tmp_path / name
    d.mkdir()
    (d / "part-0.csv").write_text(text)
    return str(d)


def test_union_of_files_with_different_headers(spark, tmp_path):
    p1, p2 = _write(tmp_path, "old", OLD_FILE), _write(tmp_path, "new", NEW_FILE)
    df = src.load_incidents(spark, [p1, p2])
    assert df.columns == list(src.INCIDENT_SCHEMA)
    assert dict(df.dtypes) == {k: t for k, (t, _) in src.INCIDENT_SCHEMA.items()}
    got = {r["incident_id"]: r for r in df.collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    assert got[1]["occ_date"] == dt.date(2015, 3, 1) and got[1]["time_occ"] == 459 and got[1]["area"] == 1
    assert got[2]["occ_date"] == dt.date(2015, 3, 2) and got[2]["weapon_cd"] is None
    assert got[3]["occ_date"] is None and got[3]["reported_date"] is None and got[3]["time_occ"] is None
    assert got[3]["descent"] is None and got[3]["lat"] == 0.0
    assert got[4]["occ_date"] == dt.date(2015, 12, 31)
    assert got[5]["area"] == 4 and got[5]["lat"] == 34.3 and got[5]["reported_date"] == dt.date(2021, 1, 6)
    assert got[6]["premis"] == "PARKING LOT" and got[6]["weapon_cd"] == 99


def test_reports_run_on_csv_input(spark, tmp_path):
    p1, p2 = _write(tmp_path, "old", OLD_FILE), _write(tmp_path, "new", NEW_FILE)
    inc = src.load_incidents(spark, [p1, p2])
    parts = dict(tuple(r) for r in rp.daypart_counts(inc, "STREET").collect())
    assert parts == {"night": 2, "afternoon": 1, "morning": 1}
    months = [tuple(r) for r in rp.month_top3(inc).collect()]
    assert (None, None, 1, 1) in months  # unparseable date: its own NULL group


def test_missing_id_column_is_generated_unique(spark, tmp_path):
    text = "DATE OCC,TIME OCC,AREA,LAT,LON\n01/01/2020 01:00:00 AM,100,1,34.0,-118.0\n" \
           "01/02/2020 01:00:00 AM,200,2,34.0,-118.0\n"
    a, b = _write(tmp_path, "a", text), _write(tmp_path, "b", text)
    df = src.load_incidents(spark, [a, b])
    ids = [r[0] for r in df.select("incident_id").collect()]
    assert len(ids) == 4 and len(set(ids)) == 4


def test_dimension_files(spark, tmp_path):
    geo = _write(tmp_path, "geo", "LAT,LON,ZIPcode\n34.0,-118.0,90001\n34.1,-118.1,90002-1234\n")
    income = _write(tmp_path, "inc", 'Zip Code,Estimated Median Income\n90001,"$9,887"\n90002,"$110,887"\n'
                                     '90003,"$33,887"\n90004,unknown\n')
    st = _write(tmp_path, "st", "X,Y,FID,DIVISION,LOCATION,PREC\n-118.2,34.05,1,CENTRAL,x,1\n"
                                "-118.3,34.1,2,RAMPART,y,2\n")
    g = src.read_revgeo_csv(spark, geo)
    assert [tuple(r) for r in g.collect()] == [(34.0, -118.0, "90001"), (34.1, -118.1, "90002-1234")]
    i = src.read_income_csv(spark, income)
    assert [tuple(r) for r in i.orderBy(F.desc("median_income")).collect()] == [
        (90002, 110887), (90003, 33887), (90001, 9887), (90004, None)]
    cents = _write(tmp_path, "cents", 'Zip Code,Estimated Median Income\n90001-1234,"$33,887.75"\n90002,"$33,887.25"\n')
    got = [(z, float(m)) for z, m in src.read_income_csv(spark, cents).orderBy(F.desc("median_income")).collect()]
    assert got == [(90001, 33887.75), (90002, 33887.25)]
    s = src.read_stations_csv(spark, st)
    assert s.columns == ["y", "x", "division", "prec"]
    assert [tuple(r) for r in s.collect()] == [(34.05, -118.2, "CENTRAL", 1), (34.1, -118.3, "RAMPART", 2)]


def test_round_trip_of_canonical_incidents(spark, tmp_path):
    rows = [(1, dt.date(2015, 3, 1), 459, 1, "STREET", 100, "H", 34.123456789, -118.987654321),
            (2, None, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "incident_id long, occ_date date, time_occ int, area int, premis string, "
                                     "weapon_cd int, descent string, lat double, lon double")
    path = str(tmp_path / "rt")
    src.write_incidents_csv(df, path, area_header="AREA ")
    back = src.read_incidents_csv(spark, path).drop("reported_date")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_mixed_headers_in_one_folder(spark, tmp_path):
    folder = _write(tmp_path, "mixed", "DR_NO,AREA \n1,5\n")
    (tmp_path / "mixed" / "part-1.csv").write_text("AREA,DR_NO\n7,2\n")
    got = src.read_incidents_csv(spark, folder).select("incident_id", "area").orderBy("incident_id").collect()
    assert [tuple(r) for r in got] == [(1, 5), (2, 7)]


def test_generated_ids_never_meet_real_ones(spark, tmp_path):
    a = _write(tmp_path, "ids", "DR_NO,AREA\n0,1\n1,2\nx7,3\n")
    b = _write(tmp_path, "noids", "AREA\n4\n5\n")
    df = src.load_incidents(spark, [a, b])
    ids = sorted(r[0] for r in df.select("incident_id").collect())
    assert len(set(ids)) == 5 and ids[-2:] == [0, 1] and all(i < 0 for i in ids[:3])
    assert ids == sorted(r[0] for r in df.select("incident_id").collect())
    raw = src.read_csv_raw(spark, a)
    counts = src.rejected_counts(raw, src.INCIDENT_HEADERS, src.INCIDENT_SCHEMA).first().asDict()
    assert counts["incident_id"] == 1 and counts["area"] == 0


def test_schema_inference_is_opt_in(spark, tmp_path):
    p = _write(tmp_path, "inf", "A,B\n1,x\n2,y\n")
    assert dict(src.read_csv_raw(spark, p).dtypes) == {"A": "string", "B": "string"}
    assert dict(src.read_csv_raw(spark, p, infer_schema=True).dtypes) == {"A": "int", "B": "string"}
