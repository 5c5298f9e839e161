"""Registry of named queries and their DuckDB oracle SQL.

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver's tables
(through the adapters in :mod:`precinct.sources.testdata`). Each oracle is the
same question in DuckDB SQL over the base tables, starting from the same
adapter CTEs. Computed columns carry the same alias on both sides; floating
results are rounded to 4 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.functions.geo import haversine_km_f32, haversine_sql
from precinct.functions.temporal import DAY_PART_SQL, SOURCE_TS_FORMAT, parse_date
from precinct.operators import filters as flt
from precinct.operators import joins as jn
from precinct.operators.exact import exact_mean_sql
from precinct.operators.intervals import interval_join
from precinct.operators.nearest import nearest_station
from precinct.operators.preview import preview
from precinct.operators.ranking import top_k
from precinct.operators.skew import skewed_join
from precinct.plans import reports as rp
from precinct.plans.study import NODES, study
from precinct.session import scratch_path
from precinct.sources import csv as src_csv
from precinct.sources import formats, inference, quarantine
from precinct.sources import testdata as td
from precinct.sources.testdata import with_adapters

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered report instances (the source data spans
# 1995-2001, so the single-year report looks at 1997).
PREMIS = "1-URGENT"
REPORT_YEAR = 1997
TOP_K = 3
ISIN_ZIPS = (90001, 90003, 90010)
UNION_CUTOFF = "1999-01-01"

INCIDENT_COLS = ["incident_id", "occ_date", "time_occ", "area", "premis", "weapon_cd", "descent", "lat", "lon"]
INCIDENT_SQL_COLS = ", ".join(INCIDENT_COLS)


def _tables(spark: SparkSession, sf: str, *names: str) -> list[DataFrame]:
    """The canonical tables ``names`` (only those are opened)."""
    return [getattr(td, n)(spark, sf) for n in names]


def _r4(col) -> F.Column:
    return F.round(F.col(col).cast("float").cast("double"), 4)


QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ------------------------------------------------------------------ Q1 parts

# The oracle's rank is one more than the number of busier months of the year.
_MONTHS = """months AS (
  SELECT CAST(date_part('year', occ_date) AS INTEGER) AS year, CAST(date_part('month', occ_date) AS INTEGER) AS month,
         count(*) AS crime_total
  FROM incidents GROUP BY 1, 2)"""
_RANKED = """SELECT m.year, m.month, m.crime_total,
       CAST(1 + (SELECT count(*) FROM months o
                 WHERE o.year IS NOT DISTINCT FROM m.year AND o.crime_total > m.crime_total) AS INTEGER) AS rank
FROM months m"""


@register("month_counts", with_adapters("SELECT * FROM months", "incidents", extra=(_MONTHS,)))
def q_month_counts(spark, sf):
    return rp.month_counts(td.incidents(spark, sf))


@register("month_rank", with_adapters(_RANKED, "incidents", extra=(_MONTHS,)))
def q_month_rank(spark, sf):
    return rp.month_rank(td.incidents(spark, sf))


_TOP3_SQL = with_adapters(
    f"SELECT * FROM placed WHERE rank <= {TOP_K} ORDER BY year, crime_total DESC, month",
    "incidents",
    extra=(_MONTHS, f"placed AS ({_RANKED})"),
)


@register("month_top3_df", _TOP3_SQL)
def q_month_top3_df(spark, sf):
    return rp.month_top3(td.incidents(spark, sf), TOP_K)


@register("month_top3_sql", _TOP3_SQL)
def q_month_top3_sql(spark, sf):
    return rp.month_top3_sql(spark, td.incidents(spark, sf), TOP_K)


@register("month_top3_view", _TOP3_SQL)
def q_month_top3_view(spark, sf):
    return rp.month_top3_view(td.incidents(spark, sf), TOP_K, "incidents_of_the_report")


# ------------------------------------------------------------------ Q2 parts


@register(
    "daypart_label",
    with_adapters(f"SELECT incident_id, time_occ, {DAY_PART_SQL.format(t='time_occ')} AS day_part FROM incidents",
                  "incidents"),
)
def q_daypart_label(spark, sf):
    return rp.with_day_part(td.incidents(spark, sf)).select("incident_id", "time_occ", "day_part")


_DAYPART_SQL = with_adapters(
    f"SELECT {DAY_PART_SQL.format(t='time_occ')} AS day_part, count(*) AS crime_count FROM incidents "
    f"WHERE premis = '{PREMIS}' GROUP BY 1 ORDER BY crime_count DESC, day_part",
    "incidents",
)


@register("daypart_df", _DAYPART_SQL)
def q_daypart_df(spark, sf):
    return rp.daypart_counts(td.incidents(spark, sf), PREMIS)


@register("daypart_rdd", _DAYPART_SQL)
def q_daypart_rdd(spark, sf):
    return rp.daypart_counts_rdd(td.incidents(spark, sf), PREMIS)


@register("daypart_intervals", ORACLE["daypart_label"])
def q_daypart_intervals(spark, sf):
    """The part of day by a table of intervals."""
    return rp.with_day_part_of(td.incidents(spark, sf), rp.day_part_table(spark)).select("incident_id", "time_occ", "day_part")


@register(
    "shift_bands",
    with_adapters(
        "SELECT s.s_suppkey AS shift, count(*) AS crime_total FROM incidents i JOIN supplier s "
        "ON i.time_occ >= s.s_suppkey * 379 % 2400 AND i.time_occ <= s.s_suppkey * 379 % 2400 + s.s_suppkey % 240 GROUP BY 1",
        "incidents",
    ),
)
def q_shift_bands(spark, sf):
    """Incidents within each supplier's shift, clock intervals that overlap and
    grow in number with the data: counted per clock value first, then joined by
    dyadic bands."""
    s = F.col("s_suppkey")
    start = s * 379 % 2400
    shifts = td._table(spark, sf, "supplier").select(s.alias("shift"), start.alias("low"), (start + s % 240).alias("high"))
    clock = td.incidents(spark, sf).groupBy("time_occ").agg(F.count(F.lit(1)).alias("n"))
    held = interval_join(clock, "time_occ", shifts, max_index=0)
    return held.groupBy("shift").agg(F.sum("n").alias("crime_total"))


# ------------------------------------------------------------------- filters


def _incident_filter_sql(where: str) -> str:
    return with_adapters(f"SELECT {INCIDENT_SQL_COLS} FROM incidents WHERE {where}", "incidents")


@register("filter_premise_eq", _incident_filter_sql(f"premis = '{PREMIS}'"))
def q_filter_premise_eq(spark, sf):
    return flt.filter_equals(td.incidents(spark, sf), "premis", PREMIS)


@register("filter_year", _incident_filter_sql(f"year(occ_date) = {REPORT_YEAR}"))
def q_filter_year(spark, sf):
    return flt.filter_year(td.incidents(spark, sf), "occ_date", REPORT_YEAR)


@register("filter_not_null", _incident_filter_sql("descent IS NOT NULL"))
def q_filter_not_null(spark, sf):
    return flt.filter_not_null(td.incidents(spark, sf), "descent")


@register("filter_code_range", _incident_filter_sql("weapon_cd >= 100 AND weapon_cd < 200"))
def q_filter_code_range(spark, sf):
    return flt.filter_code_range(td.incidents(spark, sf), "weapon_cd", 100, 200)


@register("filter_null_island", _incident_filter_sql("lat <> 0 AND lon <> 0"))
def q_filter_null_island(spark, sf):
    return flt.filter_null_island(td.incidents(spark, sf))


_ZIP5_SQL = "TRY_CAST(substr(zip, 1, 5) AS INTEGER)"


@register(
    "filter_isin",
    with_adapters(
        f"SELECT lat, lon, zip, zip_code FROM (SELECT *, {_ZIP5_SQL} AS zip_code FROM revgeo) g "
        f"WHERE zip_code IN ({', '.join(map(str, ISIN_ZIPS))})",
        "revgeo",
    ),
)
def q_filter_isin(spark, sf):
    return flt.filter_isin(jn.with_zip_code(td.revgeo(spark, sf)), "zip_code", ISIN_ZIPS)


# --------------------------------------------------------------------- joins

_COORD_JOIN_SQL = with_adapters(
    "SELECT i.incident_id, i.lat, i.lon, g.zip FROM incidents i JOIN revgeo g ON i.lat = g.lat AND i.lon = g.lon",
    "incidents",
    "revgeo",
)


@register("join_coords_expr", _COORD_JOIN_SQL)
def q_join_coords_expr(spark, sf):
    inc, geo = _tables(spark, sf, "incidents", "revgeo")
    return jn.join_coords_expr(inc.select("incident_id", "lat", "lon"), geo).select("incident_id", "lat", "lon", "zip")


@register("join_coords_using", _COORD_JOIN_SQL)
def q_join_coords_using(spark, sf):
    inc, geo = _tables(spark, sf, "incidents", "revgeo")
    return jn.join_coords_using(inc.select("incident_id", "lat", "lon"), geo).select("incident_id", "lat", "lon", "zip")


@register("join_coords_skewed", _COORD_JOIN_SQL)
def q_join_coords_skewed(spark, sf):
    """A third of all incidents may have one coordinate: its rows are spread."""
    inc, geo = _tables(spark, sf, "incidents", "revgeo")
    joined = skewed_join(inc.select("incident_id", "lat", "lon"), geo, ["lat", "lon"], hint="merge")
    return joined.select("incident_id", "lat", "lon", "zip")


@register(
    "join_zip_income",
    with_adapters(
        f"SELECT i.incident_id, m.zip_code, m.median_income FROM incidents i "
        f"JOIN revgeo g ON i.lat = g.lat AND i.lon = g.lon "
        f"JOIN income m ON {_ZIP5_SQL.replace('zip', 'g.zip')} = m.zip_code",
        "incidents",
        "revgeo",
        "income",
    ),
)
def q_join_zip_income(spark, sf):
    inc, geo, income = _tables(spark, sf, "incidents", "revgeo", "income")
    located = jn.with_zip_code(jn.join_coords_using(inc.select("incident_id", "lat", "lon"), geo))
    return jn.join_zip_income(located, income).select("incident_id", "zip_code", "median_income")


@register(
    "join_area_station",
    with_adapters(
        "SELECT i.incident_id, i.area, s.prec, s.division FROM incidents i JOIN stations s ON i.area = s.prec",
        "incidents",
        "stations",
    ),
)
def q_join_area_station(spark, sf):
    inc, st = _tables(spark, sf, "incidents", "stations")
    return jn.join_area_station(inc, st).select("incident_id", "area", "prec", "division")


# ---------------------------------------------------------- Q3 and its parts

_SELECTED_ZIPS_SQL = f"""selected AS (
  SELECT zip_code FROM (SELECT zip_code FROM income WHERE median_income IS NOT NULL
                        ORDER BY median_income DESC, zip_code LIMIT {TOP_K}) top_zips
  UNION
  SELECT zip_code FROM (SELECT zip_code FROM income WHERE median_income IS NOT NULL
                        ORDER BY median_income ASC, zip_code LIMIT {TOP_K}) bottom_zips)"""

_DESCENT_SQL = with_adapters(
    f"""SELECT i.descent, count(*) AS crime_count
FROM incidents i
JOIN revgeo g ON i.lat = g.lat AND i.lon = g.lon
JOIN income m ON {_ZIP5_SQL.replace('zip', 'g.zip')} = m.zip_code
WHERE i.occ_date >= DATE '{REPORT_YEAR}-01-01' AND i.occ_date < DATE '{REPORT_YEAR + 1}-01-01'
  AND i.descent IS NOT NULL
  AND m.zip_code IN (SELECT zip_code FROM selected)
GROUP BY i.descent
ORDER BY crime_count DESC, i.descent""",
    "incidents",
    "revgeo",
    "income",
    extra=(_SELECTED_ZIPS_SQL,),
)


@register("zip_normalise", with_adapters(f"SELECT lat, lon, zip, {_ZIP5_SQL} AS zip_code FROM revgeo", "revgeo"))
def q_zip_normalise(spark, sf):
    return jn.with_zip_code(td.revgeo(spark, sf))


@register(
    "zip_top_k",
    with_adapters(
        f"SELECT zip_code, median_income FROM income WHERE median_income IS NOT NULL "
        f"ORDER BY median_income DESC, zip_code LIMIT {TOP_K}",
        "income",
    ),
)
def q_zip_top_k(spark, sf):
    inc = td.income(spark, sf).where(F.col("median_income").isNotNull())
    return top_k(inc, [F.desc("median_income"), F.asc("zip_code")], TOP_K)


@register(
    "zip_bottom_k",
    with_adapters(
        f"SELECT zip_code, median_income FROM income WHERE median_income IS NOT NULL "
        f"ORDER BY median_income ASC, zip_code LIMIT {TOP_K}",
        "income",
    ),
)
def q_zip_bottom_k(spark, sf):
    inc = td.income(spark, sf).where(F.col("median_income").isNotNull())
    return top_k(inc, [F.asc("median_income"), F.asc("zip_code")], TOP_K)


@register(
    "zip_extremes",
    with_adapters("SELECT zip_code FROM selected", "income", extra=(_SELECTED_ZIPS_SQL,)),
)
def q_zip_extremes(spark, sf):
    return rp.selected_zips(td.income(spark, sf), TOP_K)


@register(
    "semi_join_selected_zips",
    with_adapters(
        f"SELECT lat, lon, zip, zip_code FROM (SELECT *, {_ZIP5_SQL} AS zip_code FROM revgeo) g "
        f"WHERE zip_code IN (SELECT zip_code FROM selected)",
        "revgeo",
        "income",
        extra=(_SELECTED_ZIPS_SQL,),
    ),
)
def q_semi_join_selected_zips(spark, sf):
    geo, income = _tables(spark, sf, "revgeo", "income")
    return jn.semi_join(jn.with_zip_code(geo), rp.selected_zips(income, TOP_K), "zip_code", bounded=True)


@register("descent_by_income", _DESCENT_SQL)
def q_descent_by_income(spark, sf):
    inc, geo, income = _tables(spark, sf, "incidents", "revgeo", "income")
    return rp.descent_by_income(inc, geo, income, REPORT_YEAR, TOP_K)


def _hinted_descent(hint: str) -> Query:
    def q(spark, sf):
        inc, geo, income = _tables(spark, sf, "incidents", "revgeo", "income")
        return rp.descent_by_income(inc, geo, income, REPORT_YEAR, TOP_K, hint=hint)

    return q


# The cartesian hint stays a parameter (a plan test covers it); a cross join of
# a growing table is not registered as a query.
for _h in ("broadcast", "merge", "shuffle_hash"):
    register(f"join_hint_{_h}", _DESCENT_SQL)(_hinted_descent(_h))


# ------------------------------------------------------------ Q4 and parts

_FIRE_WHERE = "i.lat <> 0 AND i.lon <> 0 AND i.weapon_cd >= 100 AND i.weapon_cd < 200"
_HAV_IS = haversine_sql("i.lat", "i.lon", "s.y", "s.x")
_F32 = f"CAST({_HAV_IS} AS FLOAT)"


@register(
    "haversine_km",
    with_adapters(
        f"SELECT i.incident_id, s.prec, round(CAST({_F32} AS DOUBLE), 4) AS distance_km "
        f"FROM incidents i JOIN stations s ON i.area = s.prec",
        "incidents",
        "stations",
    ),
)
def q_haversine_km(spark, sf):
    inc, st = _tables(spark, sf, "incidents", "stations")
    j = jn.join_area_station(inc, st)
    return j.select("incident_id", "prec", F.round(haversine_km_f32("lat", "lon", "y", "x").cast("double"), 4)
                    .alias("distance_km"))


_RESP_BASE = f"""SELECT {{key}}, {_F32} AS d
FROM incidents i JOIN stations s ON i.area = s.prec
WHERE {_FIRE_WHERE}"""

_BY_YEAR_AREA_SQL = with_adapters(
    f"SELECT year, round(avg(d), 4) AS avg_distance_km, count(d) AS crime_count FROM ("
    f"{_RESP_BASE.format(key='CAST(year(i.occ_date) AS INTEGER) AS year')}) t GROUP BY year ORDER BY year",
    "incidents",
    "stations",
)


@register("distance_by_year_area", _BY_YEAR_AREA_SQL)
def q_distance_by_year_area(spark, sf):
    inc, st = _tables(spark, sf, "incidents", "stations")
    return rp.distance_by_year_area(inc, st)


def _exact_sql(sql: str) -> str:
    """A station report's SQL with the mean as it is, of sums of integers."""
    return sql.replace("round(avg(d), 4) AS avg_distance_km", f"{exact_mean_sql('d')} AS avg_distance_km")


@register("distance_by_year_merged", _exact_sql(_BY_YEAR_AREA_SQL))
def q_distance_by_year_merged(spark, sf):
    """The exact means per year from partial sums per year and station."""
    inc, st = _tables(spark, sf, "incidents", "stations")
    parts = rp.distance_sums(rp.responsible_distances(inc, st), "year", "prec")
    return rp.merged_stats(parts, "year", places=None).orderBy("year")


@register(
    "distance_by_division_area",
    with_adapters(
        f"SELECT division, round(avg(d), 4) AS avg_distance_km, count(d) AS crime_count FROM ("
        f"{_RESP_BASE.format(key='s.division')}) t GROUP BY division ORDER BY crime_count DESC, division",
        "incidents",
        "stations",
    ),
)
def q_distance_by_division_area(spark, sf):
    inc, st = _tables(spark, sf, "incidents", "stations")
    return rp.distance_by_division_area(inc, st)


@register(
    "distance_formatted",
    with_adapters(
        f"SELECT year, round(avg(d), 4) AS avg_distance_km, count(d) AS crime_count, "
        f"format('{{:,.4f}}', round(avg(d), 4)) AS average_distance FROM ("
        f"{_RESP_BASE.format(key='CAST(year(i.occ_date) AS INTEGER) AS year')}) t GROUP BY year ORDER BY year",
        "incidents",
        "stations",
    ),
)
def q_distance_formatted(spark, sf):
    inc, st = _tables(spark, sf, "incidents", "stations")
    return rp.distance_formatted(rp.distance_by_year_area(inc, st))


_NEAREST_BASE = f"""SELECT i.incident_id, i.occ_date, s.prec, s.division, {_F32} AS d,
       row_number() OVER (PARTITION BY i.incident_id ORDER BY {_HAV_IS}, s.prec) AS rn
FROM incidents i CROSS JOIN stations s
WHERE {_FIRE_WHERE}"""


@register(
    "nearest_distance",
    with_adapters(
        f"SELECT incident_id, round(CAST(d AS DOUBLE), 4) AS distance_km FROM ({_NEAREST_BASE}) t WHERE rn = 1",
        "incidents",
        "stations",
    ),
)
def q_nearest_distance(spark, sf):
    inc, st = _tables(spark, sf, "incidents", "stations")
    near = nearest_station(flt.firearm_incidents(inc).select("incident_id", "lat", "lon"), st)
    return near.select("incident_id", _r4("near_km").alias("distance_km"))


_NEAREST_STATION_SQL = with_adapters(
    f"SELECT incident_id, prec, division, round(CAST(d AS DOUBLE), 4) AS distance_km "
    f"FROM ({_NEAREST_BASE}) t WHERE rn = 1",
    "incidents",
    "stations",
)


def _nearest_station_query(**options) -> Query:
    def q(spark, sf):
        inc, st = _tables(spark, sf, "incidents", "stations")
        pts = flt.firearm_incidents(inc).select("incident_id", "lat", "lon")
        near = nearest_station(pts, st, **options)
        return near.select(
            "incident_id", F.col("near_prec").alias("prec"), F.col("near_division").alias("division"),
            _r4("near_km").alias("distance_km"),
        )

    return q


# The stations in one block, with the division joined to the answer, in four
# blocks, and in 16 regions of a space-filling curve.
register("nearest_station", _NEAREST_STATION_SQL)(_nearest_station_query())
register("nearest_station_join", _NEAREST_STATION_SQL)(_nearest_station_query(hint="merge"))


@register("nearest_station_blocks", _NEAREST_STATION_SQL)
def q_nearest_station_blocks(spark, sf):
    quarter = -(-td.stations(spark, sf).count() // 4)
    return _nearest_station_query(method="blocks", block_rows=max(1, quarter))(spark, sf)


register("nearest_station_regions", _NEAREST_STATION_SQL)(_nearest_station_query(method="regions", regions=16))


@register(
    "distance_by_year_nearest",
    with_adapters(
        f"SELECT CAST(year(occ_date) AS INTEGER) AS year, round(avg(d), 4) AS avg_distance_km, "
        f"count(d) AS crime_count FROM ({_NEAREST_BASE}) t WHERE rn = 1 GROUP BY year(occ_date) ORDER BY year",
        "incidents",
        "stations",
    ),
)
def q_distance_by_year_nearest(spark, sf):
    inc, st = _tables(spark, sf, "incidents", "stations")
    return rp.distance_by_year_nearest(inc, st)


_BY_DIVISION_NEAREST_SQL = with_adapters(
    f"SELECT division, round(avg(d), 4) AS avg_distance_km, count(d) AS crime_count "
    f"FROM ({_NEAREST_BASE}) t WHERE rn = 1 GROUP BY division ORDER BY crime_count DESC, division",
    "incidents",
    "stations",
)


@register("distance_by_division_nearest", _BY_DIVISION_NEAREST_SQL)
def q_distance_by_division_nearest(spark, sf):
    inc, st = _tables(spark, sf, "incidents", "stations")
    return rp.distance_by_division_nearest(inc, st)


# The station reports with means that are not rounded.
def _exact_report(report: Callable) -> Query:
    def q(spark, sf):
        inc, st = _tables(spark, sf, "incidents", "stations")
        return report(inc, st, places=None)

    return q


for _report in (
    rp.distance_by_year_area, rp.distance_by_division_area, rp.distance_by_year_nearest, rp.distance_by_division_nearest,
):
    register(f"{_report.__name__}_exact", _exact_sql(ORACLE[_report.__name__]))(_exact_report(_report))


# The station reports under each join strategy.
def _hinted_stations(report: Callable, hint: str) -> Query:
    def q(spark, sf):
        inc, st = _tables(spark, sf, "incidents", "stations")
        return report(inc, st, hint=hint)

    return q


for _h in ("broadcast", "merge", "shuffle_hash"):
    register(f"distance_by_year_area_{_h}", _BY_YEAR_AREA_SQL)(_hinted_stations(rp.distance_by_year_area, _h))
    register(f"distance_by_division_area_{_h}", ORACLE["distance_by_division_area"])(
        _hinted_stations(rp.distance_by_division_area, _h)
    )
    register(f"distance_by_division_nearest_{_h}", _BY_DIVISION_NEAREST_SQL)(
        _hinted_stations(rp.distance_by_division_nearest, _h)
    )


# ------------------------------------------------------- ingestion & actions

_CANONICAL_CSV_SQL = with_adapters(
    "SELECT incident_id, occ_date AS reported_date, occ_date, time_occ, area, premis, weapon_cd, descent, lat, lon "
    "FROM incidents",
    "incidents",
)


@register("csv_scan_typed", _CANONICAL_CSV_SQL)
def q_csv_scan_typed(spark, sf):
    """Whole incident table → source-layout CSV → typed canonical read."""
    path = scratch_path(spark, "incidents-csv")
    src_csv.write_incidents_csv(td.incidents(spark, sf), path)
    return src_csv.read_incidents_csv(spark, path)


@register("load_incidents_union", _CANONICAL_CSV_SQL)
def q_load_incidents_union(spark, sf):
    """Incidents split at a date into two source files with different header
    spelling (``AREA `` / ``AREA``) and column order, in one folder, loaded back."""
    inc = td.incidents(spark, sf)
    early = inc.where(F.col("occ_date") < F.lit(UNION_CUTOFF).cast("date"))
    late = inc.where(~(F.col("occ_date") < F.lit(UNION_CUTOFF).cast("date")) | F.col("occ_date").isNull())
    path = scratch_path(spark, "incidents-union")
    src_csv.write_incidents_csv(early, path, area_header="AREA ")
    late_order = ["LON", "LAT", "Vict Descent", "Weapon Used Cd", "Premis Desc", "AREA", "TIME OCC",
                  "DATE OCC", "Date Rptd", "DR_NO"]
    src_csv.write_incidents_csv(late, path, area_header="AREA", column_order=late_order, mode="append")
    return src_csv.load_incidents(spark, path)


# Columns of the dirty copy that the next three keys load: one text in 211 of
# some columns is no value of its type.
_DIRTY = {
    "time_occ": "n/a", "weapon_cd": "12x", "lat": "34,05", "occ_date": "2015-13-45",
}


def _dirty_csv(spark, sf) -> str:
    """The incidents in the source layout, some texts replaced, in two folders'
    worth of files with different headers."""
    inc = td.incidents(spark, sf)
    path = scratch_path(spark, "incidents-dirty")
    half = F.col("incident_id") % 2 == 0
    for part, area in ((half, "AREA "), (~half, "AREA")):
        src_csv.write_incidents_csv(inc.where(part), path, area_header=area, mode="append", replaced=_faulty)
    return path


def _faulty(canon: str, text: F.Column) -> F.Column:
    k = list(_DIRTY).index(canon) if canon in _DIRTY else None
    return text if k is None else F.when(F.col("incident_id") % 211 == k, F.lit(_DIRTY[canon])).otherwise(text)


def _dirty_sql(canon: str, shown: str) -> str:
    """The text of a column in the dirty copy, as DuckDB SQL."""
    if canon not in _DIRTY:
        return shown
    return f"CASE WHEN incident_id % 211 = {list(_DIRTY).index(canon)} THEN '{_DIRTY[canon]}' ELSE {shown} END"


_SHOWN = {c: f"CAST({c} AS VARCHAR)" for c in INCIDENT_COLS} | {"occ_date": "strftime(occ_date, '%m/%d/%Y %I:%M:%S %p')"}
_HEADER = {canon: header for header, canon in src_csv.INCIDENT_HEADERS.items()}
_DIRTY_TEXTS = "texts AS (\n  " + "\n  UNION ALL ".join(
    f"SELECT incident_id, '{_HEADER[c]}' AS header, '{c}' AS canon, {_dirty_sql(c, _SHOWN[c])} AS text FROM incidents"
    for c in INCIDENT_COLS
) + f"\n  UNION ALL SELECT incident_id, 'Date Rptd', 'reported_date', {_SHOWN['occ_date']} FROM incidents)"
# Each type's own test of a text, narrow to wide.
_ACCEPTS = {
    "int": "regexp_full_match(text, '[+-]?[0-9]+') AND TRY_CAST(text AS INTEGER) IS NOT NULL",
    "bigint": "regexp_full_match(text, '[+-]?[0-9]+') AND TRY_CAST(text AS BIGINT) IS NOT NULL",
    "double": "regexp_full_match(text, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')",
    "timestamp": "try_strptime(text, '%m/%d/%Y %I:%M:%S %p') IS NOT NULL",
}
#: Share of a column's texts that its inferred type may reject.
TOLERANCE = 0.01


@register(
    "csv_inferred_types",
    with_adapters(
        "SELECT header AS column, "
        + "CASE " + " ".join(f"WHEN n_values - {t} <= n_values * {TOLERANCE} THEN '{t}'" for t in _ACCEPTS) + " ELSE 'string' END AS type, "
        + "n_values, "
        + "CASE " + " ".join(f"WHEN n_values - {t} <= n_values * {TOLERANCE} THEN n_values - {t}" for t in _ACCEPTS) + " ELSE 0 END AS rejects "
        + "FROM (SELECT header, count(*) AS n_values, "
        + ", ".join(f"count(*) FILTER (WHERE {test}) AS {t}" for t, test in _ACCEPTS.items())
        + " FROM texts WHERE text IS NOT NULL GROUP BY header) counted",
        "incidents",
        extra=(_DIRTY_TEXTS,),
    ),
)
def q_csv_inferred_types(spark, sf):
    """Types of the dirty copy's columns, found in one pass over its files."""
    return inference.infer_csv(spark, _dirty_csv(spark, sf), TOLERANCE)


_REJECTED_SQL = with_adapters(
    "SELECT incident_id, canon AS column, text, 'not a ' || CASE canon WHEN 'occ_date' THEN 'date' WHEN 'lat' THEN 'double' "
    "ELSE 'int' END AS reason FROM texts WHERE text IN (" + ", ".join(f"'{t}'" for t in _DIRTY.values()) + ")",
    "incidents",
    extra=(_DIRTY_TEXTS,),
)


@register("csv_rejections", _REJECTED_SQL)
def q_csv_rejections(spark, sf):
    """Every text of the dirty copy that its column's conversion rejects."""
    return quarantine.load_with_quarantine(spark, _dirty_csv(spark, sf)).rejections


@register(
    "csv_rejected_counts",
    with_adapters(
        "SELECT n.name, coalesce(c.n, 0) AS n FROM (SELECT unnest(["
        + ", ".join(f"'{c}'" for c in ("rows", "rejected_rows", *src_csv.INCIDENT_SCHEMA))
        + "]) AS name) n LEFT JOIN (SELECT 'rows' AS name, count(*) AS n FROM incidents UNION ALL "
        + "SELECT 'rejected_rows', count(DISTINCT incident_id) FROM rejected UNION ALL "
        + "SELECT \"column\", count(*) FROM rejected GROUP BY ALL) c USING (name)",
        "incidents",
        extra=(_DIRTY_TEXTS, "rejected AS (SELECT incident_id, canon AS column FROM texts WHERE text IN ("
               + ", ".join(f"'{t}'" for t in _DIRTY.values()) + "))"),
    ),
)
def q_csv_rejected_counts(spark, sf):
    """Rows and rejections by column, as observed in the loading pass."""
    counts = quarantine.load_with_quarantine(spark, _dirty_csv(spark, sf)).counts
    return spark.createDataFrame(list(counts.items()), "name string, n bigint")


@register("month_top3_incremental", _TOP3_SQL)
def q_month_top3_incremental(spark, sf):
    """Q1 from partial results kept per file: files come in two batches, and the
    second update reads only the second."""
    inc, source = td.incidents(spark, sf), scratch_path(spark, "incidents-arriving")
    store = rp.month_store(spark, scratch_path(spark, "month-store"))
    early = F.col("occ_date") < F.lit(UNION_CUTOFF).cast("date")
    for batch in (early, ~early | early.isNull()):
        src_csv.write_incidents_csv(inc.where(batch), source, mode="append")
        store.update(source)
    return rp.month_top3_of(store.current(source), TOP_K)


@register(
    "parse_report_ts",
    "SELECT o_orderkey AS incident_id, CAST(o_orderdate AS DATE) AS occ_date FROM orders",
)
def q_parse_report_ts(spark, sf):
    orders = td._table(spark, sf, "orders")
    text = F.date_format(F.col("o_orderdate"), SOURCE_TS_FORMAT)
    return orders.select(F.col("o_orderkey").alias("incident_id"), parse_date(text).alias("occ_date"))


@register(
    "parse_mixed_formats",
    "SELECT o_orderkey AS incident_id, CAST(o_orderdate AS DATE) AS occ_date FROM orders",
)
def q_parse_mixed_formats(spark, sf):
    """Dates of files with the month first and files with the day first, each
    parsed under the format that its texts elect."""
    orders, path = td._table(spark, sf, "orders"), scratch_path(spark, "stamps")
    for k, layout in enumerate(formats.FORMATS[:2]):
        stamp = F.date_format("o_orderdate", layout).alias("stamp")
        part = orders.where(F.col("o_orderkey") % 2 == k).select(F.col("o_orderkey").alias("incident_id"), stamp)
        part.write.mode("append").option("header", "true").csv(path)
    raw = spark.read.option("header", "true").schema("incident_id bigint, stamp string").csv(path)
    found = formats.parsed(raw.withColumn("file", F.input_file_name()), "stamp", "file", "occ")
    return found.select("incident_id", F.col("occ").cast("date").alias("occ_date"))


@register(
    "preview_incidents",
    with_adapters(
        f"SELECT {INCIDENT_SQL_COLS} FROM incidents ORDER BY md5(CAST(incident_id AS VARCHAR)), incident_id LIMIT 20",
        "incidents",
    ),
)
def q_preview_incidents(spark, sf):
    return preview(td.incidents(spark, sf), ["incident_id"])


@register(
    "join_study",
    "SELECT report, hint, asked, true AS ran, n_rows FROM (VALUES ('broadcast', 'BroadcastHashJoin'), "
    "('merge', 'SortMergeJoin'), ('shuffle_hash', 'ShuffledHashJoin')) h(hint, asked) CROSS JOIN ("
    f"SELECT 'descent_by_income' AS report, (SELECT count(*) FROM ({_DESCENT_SQL}) q) AS n_rows UNION ALL "
    f"SELECT 'distance_by_year_area', (SELECT count(*) FROM ({_BY_YEAR_AREA_SQL}) q)) r",
)
def q_join_study(spark, sf):
    """Q3 and Q4-1a under each join strategy: whether the node that the hint asks
    for is in the plan that ran, and the report's rows."""
    inc, geo, income, st = _tables(spark, sf, "incidents", "revgeo", "income", "stations")
    reports = {
        "descent_by_income": lambda hint: rp.descent_by_income(inc, geo, income, REPORT_YEAR, TOP_K, hint=hint),
        "distance_by_year_area": lambda hint: rp.distance_by_year_area(inc, st, hint=hint),
    }
    found = study(spark, reports, NODES)
    asked = F.create_map(*[F.lit(x) for pair in NODES.items() for x in pair])[F.col("hint")]
    return found.select("report", "hint", asked.alias("asked"), F.map_contains_key("joins", asked).alias("ran"), "n_rows")


@register("incident_row_count", with_adapters("SELECT count(*) AS row_count FROM incidents", "incidents"))
def q_incident_row_count(spark, sf):
    return td.incidents(spark, sf).agg(F.count(F.lit(1)).alias("row_count"))


_DUCK_TO_SPARK_TYPE = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date' ELSE lower(column_type) END"""

_PROFILE_SQL = (
    f"SELECT d.column_name, {_DUCK_TO_SPARK_TYPE} AS data_type, c.value_count FROM (DESCRIBE "
    + with_adapters("SELECT * FROM incidents", "incidents")
    + ") d JOIN (UNPIVOT ("
    + with_adapters(
        "SELECT " + ", ".join(f"count({c}) AS {c}" for c in INCIDENT_COLS) + " FROM incidents", "incidents"
    )
    + ") ON COLUMNS(*) INTO NAME column_name VALUE value_count) c ON d.column_name = c.column_name"
)


@register("schema_profile", _PROFILE_SQL)
def q_schema_profile(spark, sf):
    """Column name, type and non-NULL count of every incident column, in
    one aggregation pass over the table."""
    inc = td.incidents(spark, sf)
    counts = inc.agg(*[F.count(c).alias(c) for c in inc.columns])
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"), F.col(c).alias("value_count"))
        for c, t in inc.dtypes
    ]
    return counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
