"""The four incident reports (and their SQL / RDD twins) as DataFrame plans.

Every report takes canonical DataFrames and returns a DataFrame; nothing is
collected. Plans are shaped for a large fact table:

* aggregations are partial/final (map-side combine), so a hot key — one
  month, one coordinate, one area with a third of all rows — becomes one row
  per task before any shuffle;
* small dimensions are joined by broadcast only behind a size check;
* the fact meets small sides first and is aggregated after, and nearest
  stations are found in the partitions the fact is read in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.functions.geo import haversine_km_f32
from precinct.functions.temporal import DAY_PART_LABELS, DAY_PARTS, UNCLASSIFIED, day_part, day_part_py
from precinct.functions.text import format_fixed, zip5
from precinct.lifetimes import named_view
from precinct.operators.exact import exact_sums, mean_of, merged
from precinct.operators.filters import filter_equals, filter_not_null, filter_year, firearm_incidents
from precinct.operators.intervals import interval_join
from precinct.operators.joins import checked_broadcast, hinted, join_area_station
from precinct.operators.nearest import nearest_station
from precinct.operators.ranking import extremes, top_k_per_group
from precinct.sources.csv import read_incidents_csv
from precinct.sources.incremental import Store

# ---------------------------------------------------------------- Q1: months


def month_counts(incidents: DataFrame) -> DataFrame:
    """Incidents per (year, month) of occurrence."""
    return incidents.groupBy(
        F.year("occ_date").alias("year"), F.month("occ_date").alias("month")
    ).agg(F.count(F.lit(1)).alias("crime_total"))


def month_rank(incidents: DataFrame) -> DataFrame:
    """Every (year, month) with its ``rank`` by count inside the year."""
    from precinct.operators.ranking import rank_within

    return rank_within(month_counts(incidents), ["year"], [F.desc("crime_total")])


def month_top3(incidents: DataFrame, k: int = 3) -> DataFrame:
    """Q1: the k busiest months of every year (``rank``: ties all kept)."""
    ranked = top_k_per_group(month_counts(incidents), ["year"], [F.desc("crime_total")], k)
    return ranked.orderBy("year", F.desc("crime_total"), "month")


BUSIEST_MONTHS_SQL = """
WITH per_month AS (
    SELECT year(occ_date) AS year, month(occ_date) AS month, count(*) AS crime_total
    FROM {incidents}
    GROUP BY ALL
), placed AS (
    SELECT *, rank() OVER (PARTITION BY year ORDER BY crime_total DESC) AS rank
    FROM per_month
)
SELECT year, month, crime_total, rank
FROM placed
WHERE rank <= :k
ORDER BY year, crime_total DESC, month
"""


def month_top3_sql(spark: SparkSession, incidents: DataFrame, k: int = 3) -> DataFrame:
    """Q1 in SQL (same plan as :func:`month_top3`); the table is an argument
    of the statement, no view is left behind."""
    return spark.sql(BUSIEST_MONTHS_SQL, {"k": int(k)}, incidents=incidents)


def month_store(spark: SparkSession, folder: str) -> Store:
    """Counts per file, year and month of incident files, kept in ``folder``."""
    keys = [F.year("occ_date").alias("year"), F.month("occ_date").alias("month")]
    return Store(spark, folder, read_incidents_csv, keys, [F.count(F.lit(1)).alias("crime_total")])


def month_top3_of(counts: DataFrame, k: int = 3) -> DataFrame:
    """Q1 of partial counts (year, month, crime_total) that are yet to be added."""
    months = counts.groupBy("year", "month").agg(F.sum("crime_total").alias("crime_total"))
    return top_k_per_group(months, ["year"], [F.desc("crime_total")], k).orderBy("year", F.desc("crime_total"), "month")


def month_top3_view(incidents: DataFrame, k: int = 3, view: str = "incidents") -> DataFrame:
    """Q1 in SQL over a named view. The view is there while the statement is
    built; its plan then holds the table itself."""
    with named_view(incidents, view):
        return incidents.sparkSession.sql(BUSIEST_MONTHS_SQL.format(incidents=view), {"k": int(k)})


# -------------------------------------------------------------- Q2: day part


def with_day_part(incidents: DataFrame, labels=DAY_PART_LABELS) -> DataFrame:
    return incidents.withColumn("day_part", day_part("time_occ", labels))


def day_part_table(spark: SparkSession, labels=DAY_PART_LABELS) -> DataFrame:
    """The parts of the day as a table of intervals of the clock."""
    rows = [(low, high, labels[part]) for part, low, high in DAY_PARTS]
    return spark.createDataFrame(rows, "low int, high int, day_part string")


def with_day_part_of(incidents: DataFrame, parts: DataFrame, labels=DAY_PART_LABELS) -> DataFrame:
    """``day_part`` from a table of intervals (low, high, day_part) that do not
    overlap; times outside all of them, and NULL, are unclassified."""
    held = interval_join(incidents, "time_occ", parts, how="left")
    return held.withColumn("day_part", F.coalesce("day_part", F.lit(labels[UNCLASSIFIED])))


def daypart_counts(incidents: DataFrame, premis: str, labels=DAY_PART_LABELS) -> DataFrame:
    """Q2: incidents at one premise type per part of day, busiest first."""
    rows = filter_equals(incidents, "premis", premis)
    return (
        rows.select(day_part("time_occ", labels).alias("day_part"))
        .groupBy("day_part")
        .agg(F.count(F.lit(1)).alias("crime_count"))
        .orderBy(F.desc("crime_count"), "day_part")
    )


def daypart_counts_rdd(incidents: DataFrame, premis: str, labels=DAY_PART_LABELS) -> DataFrame:
    """Q2 on the RDD API: the cross-check of :func:`daypart_counts`.

    The DataFrame counts per (premis, time_occ) first, combined map-side, so what
    reaches Python is a row for each pair that occurs, however many incidents
    share it. The chain on the RDD then filters, maps, reduces by key and sorts.
    """
    from pyspark import cloudpickle

    import precinct

    labs = dict(labels)
    counted = incidents.groupBy("premis", "time_occ").agg(F.count(F.lit(1)).alias("n"))
    cloudpickle.register_pickle_by_value(precinct)  # workers need not import the package
    try:
        pairs = (
            counted.rdd.filter(lambda row: row[0] == premis)
            .map(lambda row: (day_part_py(row[1], labs), row[2]))
            .reduceByKey(lambda a, b: a + b)
            .sortBy(lambda pair: (-pair[1], pair[0]), numPartitions=1)  # a row for each label
        )
        return incidents.sparkSession.createDataFrame(pairs, "day_part string, crime_count bigint")
    finally:
        cloudpickle.unregister_pickle_by_value(precinct)


# --------------------------------------------------- Q3: descent by income


#: Selected ZIPs up to which they are broadcast without a count.
MAX_SELECTED = 10_000


def selected_zips(income: DataFrame, k: int = 3) -> DataFrame:
    """ZIPs of the k richest and k poorest income rows (at most 2k rows)."""
    return extremes(income, "median_income", "zip_code", k)


def descent_by_income(
    incidents: DataFrame,
    revgeo: DataFrame,
    income: DataFrame,
    year: int,
    k: int = 3,
    hint: str | None = None,
) -> DataFrame:
    """Q3: victim descent counts for incidents of ``year`` located in the k
    richest and k poorest ZIPs, as one histogram.

    Same rows as "incidents JOIN revgeo ON (lat, lon) JOIN income USING zip,
    filtered to the selected ZIPs, count by descent", computed as:

    1. selected ZIPs (<= 2k rows) with the number of income rows per selected
       ZIP (the multiplicity an inner join adds);
    2. per coordinate, the summed multiplicity over its selected geocode rows;
    3. the year's incidents joined to these few coordinates, then
       sum(multiplicity) per descent, combined map-side. With near-unique
       coordinates aggregating the incidents first would shuffle every row.
       Without a hint the coordinates are broadcast behind the size check, so
       the incidents are joined where they are read; beyond its bounds the
       join is left to the planner.
    """
    known_income = income.select("zip_code", "median_income")
    sel = selected_zips(known_income, k)
    small = F.broadcast if 2 * k <= MAX_SELECTED else (lambda df: df)
    zip_weight = (
        known_income.join(small(sel), "zip_code", "left_semi")
        .groupBy("zip_code")
        .agg(F.count(F.lit(1)).alias("w_zip"))
    )  # <= 2k rows
    geo = revgeo.select("lat", "lon", zip5("zip").alias("zip_code"))
    geo_weight = (
        geo.join(small(zip_weight) if hint in (None, "broadcast") else hinted(zip_weight, hint), "zip_code", "inner")
        .groupBy("lat", "lon")
        .agg(F.sum("w_zip").alias("w"))
    )
    facts = filter_not_null(filter_year(incidents, "occ_date", year), "descent").select("lat", "lon", "descent")
    places = revgeo.select("lat", "lon")  # not fewer than those of the selected ZIPs
    side = checked_broadcast(geo_weight, within=places) if hint is None else hinted(geo_weight, hint, within=places)
    return (
        facts.join(side, ["lat", "lon"], "inner")
        .groupBy("descent")
        .agg(F.sum("w").alias("crime_count"))
        .orderBy(F.desc("crime_count"), "descent")
    )


# ------------------------------------------------ Q4: distance to stations


def distance_sums(df: DataFrame, *by, dist: str = "distance_km") -> DataFrame:
    """The exact sums of a group's distances, ``distance``: partial results that
    :func:`merged_stats` brings together."""
    return df.groupBy(*by).agg(exact_sums(dist).alias("distance"))


def _means(sums: DataFrame, by: str, places: int | None) -> DataFrame:
    mean = mean_of("distance")
    shown = mean if places is None else F.round(mean, places)
    return sums.select(by, shown.alias("avg_distance_km"), F.col("distance")["n"].alias("crime_count"))


def merged_stats(sums: DataFrame, by: str, places: int | None = 4) -> DataFrame:
    """:func:`distance_stats` of partial results."""
    return _means(sums.groupBy(by).agg(merged("distance").alias("distance")), by, places)


def distance_stats(df: DataFrame, group_col, dist: str = "distance_km", places: int | None = 4) -> DataFrame:
    """Mean distance, rounded to ``places`` (None: not at all), and count of
    non-NULL distances. The 32-bit distances are summed exactly, so the mean has
    the same bits however the rows are dealt."""
    return _means(distance_sums(df, group_col, dist=dist), group_col, places)


def responsible_distances(incidents: DataFrame, stations: DataFrame, hint: str | None = "broadcast") -> DataFrame:
    """Firearm incidents with their responsible station and ``distance_km`` to
    it. The small station side is broadcast (after the size check) or joined
    under the hint; without one, the planner and AQE choose, and AQE splits a hot
    area."""
    j = join_area_station(firearm_incidents(incidents), stations, hint)
    return j.select(
        F.year("occ_date").alias("year"), "division", "prec", haversine_km_f32("lat", "lon", "y", "x").alias("distance_km")
    )


def _responsible_stats(incidents: DataFrame, stations: DataFrame, by: str, hint: str | None, places: int | None) -> DataFrame:
    """Q4-1 core: the mean over incidents, one formula whatever the join."""
    return distance_stats(responsible_distances(incidents, stations, hint), by, places=places)


def distance_by_year_area(
    incidents: DataFrame, stations: DataFrame, hint: str | None = "broadcast", places: int | None = 4
) -> DataFrame:
    """Q4-1a: mean distance to the responsible station, per year."""
    return _responsible_stats(incidents, stations, "year", hint, places).orderBy("year")


def distance_by_division_area(
    incidents: DataFrame, stations: DataFrame, hint: str | None = "broadcast", places: int | None = 4
) -> DataFrame:
    """Q4-1b: mean distance to the responsible station, per division."""
    stats = _responsible_stats(incidents, stations, "division", hint, places)
    return stats.orderBy(F.desc("crime_count"), "division")


def distance_by_year_nearest(incidents: DataFrame, stations: DataFrame, places: int | None = 4) -> DataFrame:
    """Q4-2a: mean distance to the nearest station, per year. Points are solved
    where they are read; only the few groups are shuffled."""
    points = firearm_incidents(incidents).select("lat", "lon", F.year("occ_date").alias("year"))
    near = nearest_station(points, stations).withColumn("distance_km", F.col("near_km").cast("float"))
    return distance_stats(near, "year", places=places).orderBy("year")


def distance_by_division_nearest(
    incidents: DataFrame, stations: DataFrame, hint: str | None = None, places: int | None = 4
) -> DataFrame:
    """Q4-2b: mean distance to the nearest station, per that station's
    division; with ``hint`` the division comes from a join under that strategy."""
    points = firearm_incidents(incidents).select("lat", "lon")
    near = nearest_station(points, stations, hint=hint).withColumn("distance_km", F.col("near_km").cast("float"))
    near = near.withColumnRenamed("near_division", "division")
    return distance_stats(near, "division", places=places).orderBy(F.desc("crime_count"), "division")


def distance_formatted(stats: DataFrame, col: str = "avg_distance_km", out: str = "average_distance") -> DataFrame:
    """Display column: the mean as text with 4 decimals and thousands commas."""
    return stats.withColumn(out, format_fixed(col, 4))
