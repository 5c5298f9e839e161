"""Reports on seeded random tables (NULLs, duplicates, ties, hot keys)
against plain-Python brute force of the same semantics."""

import datetime as dt
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from precinct.functions.temporal import day_part_py
from precinct.plans import reports as rp

COORDS = [(34.0, -118.0), (34.1, -118.2), (34.2, -118.1), (34.05, -118.3), (0.0, -118.0), (34.0, 0.0),
          (34.3, -118.25), (34.15, -118.05)]


def _hav(lat1, lon1, lat2, lon2):
    p1, l1, p2, l2 = map(math.radians, (lat1, lon1, lat2, lon2))
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
    return 6371.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(max(0.0, 1 - a)))


def _maybe(rng, value, p=0.08):
    return None if rng.random() < p else value


def make_tables(seed):
    rng = random.Random(seed)
    inc = []
    for i in range(400):
        hot = rng.random() < 0.33  # a third of the rows on one coordinate / area / day
        lat, lon = COORDS[0] if hot else rng.choice(COORDS)
        day = dt.date(2015, 6, 1) if hot else dt.date(2014, 1, 1) + dt.timedelta(days=rng.randrange(3 * 365))
        inc.append((
            i, _maybe(rng, day), _maybe(rng, rng.randint(-10, 2500)), 1 if hot else _maybe(rng, rng.randrange(6)),
            rng.choice(["STREET", "HOME", None]), _maybe(rng, rng.randint(90, 210)),
            _maybe(rng, rng.choice(["H", "W", "B", "O"])), _maybe(rng, lat, 0.03), _maybe(rng, lon, 0.03),
        ))
    geo = []
    for k, (lat, lon) in enumerate(COORDS[:-1]):
        for j in range(rng.choice([1, 1, 2])):  # some coordinates twice
            z = 90001 + (k + j) % 5
            geo.append((lat, lon, f"{z}-00{j}" if rng.random() < 0.5 else str(z)))
    income = [(90001, 500), (90002, 500), (90003, 20), (90004, None), (90005, 700), (90002, 90), (90006, 20),
              (90007, 1000)]
    stations = [(34.02, -118.05, "A", 0), (34.12, -118.22, "B", 1), (34.2, -118.1, "C", 2),
                (None, -118.0, "N", 3), (34.31, -118.27, "D", 4), (34.0, -118.4, "E", 5), (34.2, -118.1, "C2", 6)]
    return inc, geo, income, stations


INC_SCHEMA = ("incident_id long, occ_date date, time_occ int, area int, premis string, weapon_cd int, "
              "descent string, lat double, lon double")


def frames(spark, seed):
    inc, geo, income, st = make_tables(seed)
    return (inc, geo, income, st,
            spark.createDataFrame(inc, INC_SCHEMA),
            spark.createDataFrame(geo, "lat double, lon double, zip string"),
            spark.createDataFrame(income, "zip_code int, median_income bigint"),
            spark.createDataFrame(st, "y double, x double, division string, prec int"))


def brute_month_top3(inc):
    counts = Counter((d.year, d.month) if d else (None, None) for _, d, *_ in inc)
    by_year = defaultdict(list)
    for (y, m), n in counts.items():
        by_year[y].append((m, n))
    out = set()
    for y, ms in by_year.items():
        for m, n in ms:
            rank = 1 + sum(1 for _, n2 in ms if n2 > n)
            if rank <= 3:
                out.add((y, m, n, rank))
    return out


def brute_daypart(inc, premis):
    return dict(Counter(day_part_py(t) for _, _, t, _, p, *_ in inc if p == premis))


def brute_descent(inc, geo, income, year, k):
    known = [(z, m) for z, m in income if m is not None]
    top = [z for z, _ in sorted(known, key=lambda r: (-r[1], r[0]))[:k]]
    bottom = [z for z, _ in sorted(known, key=lambda r: (r[1], r[0]))[:k]]
    sel = set(top) | set(bottom)
    out = Counter()
    for _, d, _, _, _, _, desc, lat, lon in inc:
        if d is None or d.year != year or desc is None or lat is None or lon is None:
            continue
        for glat, glon, z in geo:
            if (glat, glon) != (lat, lon):
                continue
            z5 = int(z[:5]) if z[:5].isdigit() else None
            for iz, _ in income:
                if iz == z5 and iz in sel:
                    out[desc] += 1
    return dict(out)


def _firearm(inc):
    for row in inc:
        _, d, _, area, _, w, _, lat, lon = row
        if lat is None or lon is None or lat == 0.0 or lon == 0.0 or w is None or not (100 <= w < 200):
            continue
        yield row


def _f32(x):
    return float(np.float32(x))


def _stats(groups):
    return {g: (sum(v) / len(v), len(v)) for g, v in groups.items()}


def brute_responsible(inc, st, by):
    groups = defaultdict(list)
    for _, d, _, area, _, _, _, lat, lon in _firearm(inc):
        for y, x, div, prec in st:
            if prec == area and y is not None and x is not None:
                groups[(d.year if d else None) if by == "year" else div].append(_f32(_hav(lat, lon, y, x)))
            elif prec == area:
                groups.setdefault((d.year if d else None) if by == "year" else div, [])
    return {g: (sum(v) / len(v) if v else None, len(v)) for g, v in groups.items()}


def brute_nearest(inc, st, by):
    valid = [(y, x, div, prec) for y, x, div, prec in st if y is not None and x is not None]
    groups = defaultdict(list)
    for _, d, _, _, _, _, _, lat, lon in _firearm(inc):
        dist, prec, div = min((_hav(lat, lon, y, x), prec, div) for y, x, div, prec in valid)
        groups[(d.year if d else None) if by == "year" else div].append(_f32(dist))
    return _stats(groups)


def _cmp_stats(got_rows, want):
    got = {r[0]: (r[1], r[2]) for r in got_rows}
    assert set(got) == set(want)
    for g, (avg, n) in want.items():
        assert got[g][1] == n, g
        if avg is None:
            assert got[g][0] is None
        else:
            assert got[g][0] == pytest.approx(avg, abs=6e-5), g


@pytest.mark.parametrize("seed", [11, 12])
def test_reports_match_brute_force(spark, seed):
    inc, geo, income, st, inc_df, geo_df, income_df, st_df = frames(spark, seed)

    got = {tuple(r) for r in rp.month_top3(inc_df).collect()}
    assert got == brute_month_top3(inc)
    assert {tuple(r) for r in rp.month_top3_sql(spark, inc_df).collect()} == got

    want = brute_daypart(inc, "STREET")
    assert dict(tuple(r) for r in rp.daypart_counts(inc_df, "STREET").collect()) == want
    assert dict(tuple(r) for r in rp.daypart_counts_rdd(inc_df, "STREET").collect()) == want

    for k in (1, 2, 3):
        want = brute_descent(inc, geo, income, 2015, k)
        got = dict(tuple(r) for r in rp.descent_by_income(inc_df, geo_df, income_df, 2015, k).collect())
        assert got == want, k

    _cmp_stats(rp.distance_by_year_area(inc_df, st_df).collect(), brute_responsible(inc, st, "year"))
    _cmp_stats(rp.distance_by_division_area(inc_df, st_df).collect(), brute_responsible(inc, st, "division"))
    _cmp_stats(rp.distance_by_year_nearest(inc_df, st_df).collect(), brute_nearest(inc, st, "year"))
    _cmp_stats(rp.distance_by_division_nearest(inc_df, st_df).collect(), brute_nearest(inc, st, "division"))
