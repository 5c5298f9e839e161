"""CSV ingestion of the source files into the canonical schema.

The source files carry display headers (``DATE OCC``, ``AREA `` with a
trailing space in the older incident file, ``Zip Code`` ...), 12-hour clock
timestamps as text and money as ``$33,887``. Files are read with the header
only — every field as text, no inference pass over the data — and each known
header is mapped by name (case and surrounding spaces ignored) to a
canonical column with an explicit, non-throwing conversion. Column order and
header spelling may therefore differ between files of the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.functions.temporal import SOURCE_TS_FORMAT, parse_date
from precinct.functions.text import parse_money, zip5

# Source header → canonical column, per table.
INCIDENT_HEADERS = {
    "DR_NO": "incident_id",
    "Date Rptd": "reported_date",
    "DATE OCC": "occ_date",
    "TIME OCC": "time_occ",
    "AREA": "area",
    "Premis Desc": "premis",
    "Weapon Used Cd": "weapon_cd",
    "Vict Descent": "descent",
    "LAT": "lat",
    "LON": "lon",
}
REVGEO_HEADERS = {"LAT": "lat", "LON": "lon", "ZIPcode": "zip"}
INCOME_HEADERS = {"Zip Code": "zip_code", "Estimated Median Income": "median_income"}
STATION_HEADERS = {"Y": "y", "X": "x", "DIVISION": "division", "PREC": "prec"}


def _num(t: str) -> Callable[[Column], Column]:
    return lambda c: F.trim(c).try_cast(t)


def _text(c: Column) -> Column:
    return c


def _date(c: Column) -> Column:
    return parse_date(F.trim(c), SOURCE_TS_FORMAT)


def _money(c: Column) -> Column:
    return parse_money(c).cast("decimal(14,2)")


# Canonical column → (type, converter from text). Order = canonical order.
INCIDENT_SCHEMA = {
    "incident_id": ("bigint", _num("bigint")),
    "reported_date": ("date", _date),
    "occ_date": ("date", _date),
    "time_occ": ("int", _num("int")),
    "area": ("int", _num("int")),
    "premis": ("string", _text),
    "weapon_cd": ("int", _num("int")),
    "descent": ("string", _text),
    "lat": ("double", _num("double")),
    "lon": ("double", _num("double")),
}
REVGEO_SCHEMA = {
    "lat": ("double", _num("double")),
    "lon": ("double", _num("double")),
    "zip": ("string", lambda c: F.trim(c)),
}
INCOME_SCHEMA = {"zip_code": ("int", lambda c: zip5(F.trim(c))), "median_income": ("decimal(14,2)", _money)}
STATION_SCHEMA = {
    "y": ("double", _num("double")),
    "x": ("double", _num("double")),
    "division": ("string", _text),
    "prec": ("int", _num("int")),
}


def _norm(name: str) -> str:
    return name.strip().upper()


def read_csv_raw(spark: SparkSession, paths: str | Sequence[str], infer_schema: bool = False) -> DataFrame:
    """Header CSV as-is. ``infer_schema=True`` opts into Spark's inference
    (one extra full pass over the files); the default reads text."""
    return (
        spark.read.option("header", "true")
        .option("inferSchema", "true" if infer_schema else "false")
        .option("mode", "PERMISSIVE")
        .csv(list(paths) if not isinstance(paths, str) else paths)
    )


def header_groups(spark: SparkSession, paths: str | Sequence[str]) -> list[list[str]]:
    """The files below ``paths``, those with the same header line together.
    Only the first line of each file is read, through Spark's file system."""
    files = spark.read.text(list(paths) if not isinstance(paths, str) else paths).inputFiles()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    groups: dict[str, list[str]] = {}
    for file in sorted(files):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream = path.getFileSystem(conf).open(path)
        codec = codecs.getCodec(path)
        lines = jvm.java.io.BufferedReader(
            jvm.java.io.InputStreamReader(stream if codec is None else codec.createInputStream(stream), "UTF-8")
        )
        line = lines.readLine()
        lines.close()
        if line is not None:  # an empty file has no rows
            groups.setdefault(line, []).append(file)
    return list(groups.values())


def canonicalise(
    raw: DataFrame, headers: Mapping[str, str], schema: Mapping[str, tuple[str, Callable[[Column], Column]]]
) -> DataFrame:
    """Map display headers to canonical typed columns.

    Known headers are matched ignoring case and surrounding spaces; columns
    the file lacks become typed NULLs; unknown columns are dropped.
    """
    by_norm = {_norm(h): canon for h, canon in headers.items()}
    present: dict[str, str] = {}
    for c in raw.columns:
        canon = by_norm.get(_norm(c))
        if canon is not None and canon not in present:
            present[canon] = c
    cols = []
    for canon, (typ, conv) in schema.items():
        if canon in present:
            src = F.col(f"`{present[canon]}`").cast("string")
            cols.append(conv(src).cast(typ).alias(canon))
        else:
            cols.append(F.lit(None).cast(typ).alias(canon))
    return raw.select(*cols)


def rejected_counts(
    raw: DataFrame, headers: Mapping[str, str], schema: Mapping[str, tuple[str, Callable[[Column], Column]]]
) -> DataFrame:
    """One row: per canonical column, how many texts that are not empty failed
    their conversion and became NULL."""
    by_norm = {_norm(h): canon for h, canon in headers.items()}
    present = {by_norm[_norm(c)]: c for c in reversed(raw.columns) if _norm(c) in by_norm}
    counts = []
    for canon, (typ, conv) in schema.items():
        text = F.col(f"`{present[canon]}`").cast("string") if canon in present else F.lit(None).cast("string")
        counts.append(F.count_if((F.trim(text) != "") & conv(text).cast(typ).isNull()).alias(canon))
    return raw.agg(*counts)


def _read(
    spark: SparkSession, paths: str | Sequence[str], headers: Mapping[str, str],
    schema: Mapping[str, tuple[str, Callable[[Column], Column]]],
) -> DataFrame:
    """Files with any mix of headers as one canonical table, by name."""
    frames = [canonicalise(read_csv_raw(spark, files), headers, schema) for files in header_groups(spark, paths)]
    if not frames:
        return canonicalise(spark.createDataFrame([], "_none string"), headers, schema)
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def read_incidents_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Incident files, whatever their headers' order and spelling → canonical."""
    return _read(spark, paths, INCIDENT_HEADERS, INCIDENT_SCHEMA)


def load_incidents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Incident files as one canonical table, every row with an id.

    Ids in the files are not negative; rows without one, or with text that is
    no such number, get a negative id from their place in the files, which no
    id of a file can equal and which is the same at each evaluation.
    """
    own = F.col("incident_id")
    return read_incidents_csv(spark, paths).withColumn(
        "incident_id", F.when(own >= 0, own).otherwise(F.lit(-1) - F.monotonically_increasing_id())
    )


def read_revgeo_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return _read(spark, path, REVGEO_HEADERS, REVGEO_SCHEMA)


def read_income_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return _read(spark, path, INCOME_HEADERS, INCOME_SCHEMA)


def read_stations_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return _read(spark, path, STATION_HEADERS, STATION_SCHEMA)


def write_incidents_csv(
    incidents: DataFrame, path: str, area_header: str = "AREA", column_order: Sequence[str] | None = None,
    mode: str = "errorifexists", replaced: Callable[[str, Column], Column] | None = None,
) -> None:
    """Write canonical incidents in the source layout (display headers,
    12-hour clock text). ``reported_date`` falls back to ``occ_date``.
    ``replaced`` gets each canonical name and its text, and gives the text to
    write."""
    def stamp(c: str) -> Column:
        return F.date_format(F.col(c).cast("timestamp"), SOURCE_TS_FORMAT)

    rep = "reported_date" if "reported_date" in incidents.columns else "occ_date"
    cols = {
        "DR_NO": F.col("incident_id"),
        "Date Rptd": stamp(rep),
        "DATE OCC": stamp("occ_date"),
        "TIME OCC": F.col("time_occ"),
        area_header: F.col("area"),
        "Premis Desc": F.col("premis"),
        "Weapon Used Cd": F.col("weapon_cd"),
        "Vict Descent": F.col("descent"),
        "LAT": F.col("lat"),
        "LON": F.col("lon"),
    }
    if replaced is not None:
        canon = INCIDENT_HEADERS | {area_header: "area"}
        cols = {h: replaced(canon[h], c.cast("string")) for h, c in cols.items()}
    order = list(column_order) if column_order else list(cols)
    incidents.select(*[cols[h].alias(h) for h in order]).write.option("header", "true").mode(mode).csv(path)
