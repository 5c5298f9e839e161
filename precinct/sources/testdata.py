"""Canonical incident tables derived from the driver's parquet tables.

The incident data model has one fact (``incidents``) and three dimensions
(``revgeo``, ``income``, ``stations``). The driver ships TPC-H-like tables, so
each canonical table is a pure projection of one of them (FIXTURES.md §C).
Every adapter is lazy: Catalyst pushes filters and column pruning through the
projections into the parquet scans.

The same rules are written once more as DuckDB SQL (``ADAPTER_SQL``) so the
oracle queries start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the adapter rules (FIXTURES.md §C).
BASE_LAT = 33.7
BASE_LON = -118.6
# A customer's place: two coprime step counts, so places repeat only after
# 30 million customers.
LAT_FACTOR, LAT_STEPS = 37, 6007
LON_FACTOR, LON_STEPS = 53, 5003
PLACE_SCALE = 10000.0
ZIP_BASE = 90000


# Columns of the driver tables the adapters use. Reading with an explicit
# schema skips footer-based schema inference (a job per read).
BASE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
    "supplier": "s_suppkey bigint, s_name string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in BASE_SCHEMAS:
        reader = reader.schema(BASE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lat(key: Column) -> Column:
    return F.lit(BASE_LAT) + (key * LAT_FACTOR % LAT_STEPS).cast("double") / F.lit(PLACE_SCALE)


def _lon(key: Column) -> Column:
    return F.lit(BASE_LON) + (key * LON_FACTOR % LON_STEPS).cast("double") / F.lit(PLACE_SCALE)


def incidents_from_orders(orders: DataFrame, areas: Column | int = 1) -> DataFrame:
    """``incidents``: one row per order (15,000 at sf0.01), its area one of
    ``areas`` (their number, or a scalar subquery that gives it)."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    null_island = k % 97 == 0
    return orders.select(
        k.alias("incident_id"),
        F.col("o_orderdate").cast("date").alias("occ_date"),
        ((k * 37) % 2400).cast("int").alias("time_occ"),
        (c % areas).cast("int").alias("area"),
        F.col("o_orderpriority").alias("premis"),
        F.when(k % 5 == 0, F.lit(None).cast("int"))
        .otherwise(((k * 13) % 400).cast("int")).alias("weapon_cd"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("o_orderstatus")).alias("descent"),
        F.when(null_island, F.lit(0.0)).otherwise(_lat(c)).alias("lat"),
        F.when(null_island, F.lit(0.0)).otherwise(_lon(c)).alias("lon"),
    )


def revgeo_from_customer(customer: DataFrame) -> DataFrame:
    """``revgeo``: distinct (lat, lon, zip); zip is text, ZIP+4 for even keys."""
    c = F.col("c_custkey")
    zip5 = (F.lit(ZIP_BASE) + (c % 300) % 25).cast("string")
    return customer.select(
        _lat(c).alias("lat"),
        _lon(c).alias("lon"),
        F.concat(zip5, F.when(c % 2 == 0, F.lit("-0001")).otherwise(F.lit(""))).alias("zip"),
    ).distinct()


def income_from_customer(customer: DataFrame) -> DataFrame:
    """``income``: one row per nation: zip_code, median_income (whole units).

    The money sum runs over integer cents so the result does not depend on
    the order in which partitions are added.
    """
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    return (
        customer.groupBy("c_nationkey")
        .agg(F.sum(cents).alias("_cents"))
        .select(
            (F.lit(ZIP_BASE) + F.col("c_nationkey")).cast("int").alias("zip_code"),
            F.floor(F.col("_cents").cast("double") / F.lit(100.0)).cast("bigint").alias("median_income"),
        )
    )


def stations_from_supplier(supplier: DataFrame) -> DataFrame:
    """``stations``: every supplier is a precinct."""
    s = F.col("s_suppkey")
    return supplier.select(
        (F.lit(BASE_LAT) + ((s * 379) % 601).cast("double") / F.lit(1000.0)).alias("y"),
        (F.lit(BASE_LON) + ((s * 211) % 503).cast("double") / F.lit(1000.0)).alias("x"),
        F.col("s_name").alias("division"),
        s.cast("int").alias("prec"),
    )


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = _table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)))
    return incidents_from_orders(_table(spark, sf_dir, "orders"), areas.scalar())


def revgeo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revgeo_from_customer(_table(spark, sf_dir, "customer"))


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return income_from_customer(_table(spark, sf_dir, "customer"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations_from_supplier(_table(spark, sf_dir, "supplier"))


# The same four rules as DuckDB CTEs, for the oracle queries.
ADAPTER_SQL = {
    "incidents": """incidents AS (
  SELECT o_orderkey AS incident_id,
         CAST(o_orderdate AS DATE) AS occ_date,
         CAST((o_orderkey * 37) % 2400 AS INTEGER) AS time_occ,
         CAST(o_custkey % (SELECT count(*) FROM supplier) AS INTEGER) AS area,
         o_orderpriority AS premis,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST((o_orderkey * 13) % 400 AS INTEGER) END AS weapon_cd,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS descent,
         CASE WHEN o_orderkey % 97 = 0 THEN CAST(0 AS DOUBLE)
              ELSE CAST(33.7 AS DOUBLE) + CAST(o_custkey * 37 % 6007 AS DOUBLE) / CAST(10000 AS DOUBLE) END AS lat,
         CASE WHEN o_orderkey % 97 = 0 THEN CAST(0 AS DOUBLE)
              ELSE CAST(-118.6 AS DOUBLE) + CAST(o_custkey * 53 % 5003 AS DOUBLE) / CAST(10000 AS DOUBLE) END AS lon
  FROM orders)""",
    "revgeo": """revgeo AS (
  SELECT DISTINCT
         CAST(33.7 AS DOUBLE) + CAST(c_custkey * 37 % 6007 AS DOUBLE) / CAST(10000 AS DOUBLE) AS lat,
         CAST(-118.6 AS DOUBLE) + CAST(c_custkey * 53 % 5003 AS DOUBLE) / CAST(10000 AS DOUBLE) AS lon,
         concat(CAST(90000 + (c_custkey % 300) % 25 AS VARCHAR),
                CASE WHEN c_custkey % 2 = 0 THEN '-0001' ELSE '' END) AS zip
  FROM customer)""",
    "income": """income AS (
  SELECT CAST(90000 + c_nationkey AS INTEGER) AS zip_code,
         CAST(floor(CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS DOUBLE) / CAST(100 AS DOUBLE)) AS BIGINT)
           AS median_income
  FROM customer GROUP BY c_nationkey)""",
    "stations": """stations AS (
  SELECT CAST(33.7 AS DOUBLE) + CAST((s_suppkey * 379) % 601 AS DOUBLE) / CAST(1000 AS DOUBLE) AS y,
         CAST(-118.6 AS DOUBLE) + CAST((s_suppkey * 211) % 503 AS DOUBLE) / CAST(1000 AS DOUBLE) AS x,
         s_name AS division,
         CAST(s_suppkey AS INTEGER) AS prec
  FROM supplier)""",
}


def with_adapters(sql: str, *names: str, extra: tuple[str, ...] = ()) -> str:
    """Prefix ``sql`` with the adapter CTEs it needs (in the given order),
    followed by any ``extra`` CTEs (``name AS (...)`` text)."""
    ctes = ",\n".join([ADAPTER_SQL[n] for n in names] + list(extra))
    return f"WITH {ctes}\n{sql}"
