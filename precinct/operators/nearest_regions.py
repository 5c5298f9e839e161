"""Nearest station for station tables of any size: both sides are dealt along a
space-filling curve.

1. *Index.* Stations are points of the unit sphere, numbered along a Z-order
   curve through the cube around it and dealt into regions, ranges of the curve
   with about ``region_rows`` stations each. Of a region the plan knows the first
   number and the box of its stations, two small rows a region.
2. *Home.* A point goes to the region that its own number falls into; the tagged
   points are a table, so the fact is read once. A region with many points is
   cut into parts, each with a copy of the region's stations, so that no task has
   more than its share of the points; a part has at least as many points as
   stations, so copies never outnumber what asks for them.
3. *Solve.* A task takes the stations of its part, in leaves with boxes, then its
   points as a stream. A point is done when no other region's box is closer than
   the nearest station found: that bound proves the answer.
4. *Rings.* Points near a border are left over, with the regions whose boxes are
   closer, nearest first. They visit the first of them, then the next two, the
   next four and so on; what they find narrows the list, until it is empty. Rounds
   grow with the logarithm of the number of regions, leftovers shrink each time.

The semantics are those of :mod:`precinct.operators.nearest`, ties included.
Nothing is broadcast; the boxes and the numbers of parts travel with the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

import precinct
from precinct.functions.geo import known
from precinct.operators.nearest import SAFETY, Leaves, best_of, distinct_stations, lists, sphere
from precinct.session import scratch_path

#: Stations of a region.
REGION_ROWS = 65_536
#: Bits of an axis of the curve: cells of about 100 m.
BITS = 17
#: Points whose regions are looked for together; comparisons of points and boxes
#: that are made at once.
TILE, AT_ONCE = 256, 1 << 20

_STATION = "struct<prec:int,division:string,y:double,x:double>"
_TODO = "array<struct<d:double,region:int>>"


def curve(places: np.ndarray) -> np.ndarray:
    """Z-order numbers of points of the unit sphere."""
    cells = np.clip(((places + 1) * (1 << (BITS - 1))).astype(np.int64), 0, (1 << BITS) - 1)
    out = np.zeros(len(places), np.int64)
    for bit in range(BITS):
        for axis in range(3):
            out |= (cells[:, axis] >> bit & 1) << (3 * bit + axis)
    return out


def _by_value(make):
    """``make()`` with this package's functions sent by value."""
    cloudpickle.register_pickle_by_value(precinct)
    try:
        return make()
    finally:
        cloudpickle.unregister_pickle_by_value(precinct)


def _table(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Regions:
    """First curve numbers, station counts and boxes of the regions, in order."""

    def __init__(self, rows: list):
        self.numbers = np.array([r["region"] for r in rows], np.int64)
        self.stations = {r["region"]: r["n"] for r in rows}
        self.first = np.array([r["first"] for r in rows], np.int64)
        self.low = np.array([[r[f"low{k}"] for k in range(3)] for r in rows]).reshape(-1, 3)
        self.high = np.array([[r[f"high{k}"] for k in range(3)] for r in rows]).reshape(-1, 3)

    def home(self, places: np.ndarray) -> np.ndarray:
        return self.numbers[np.maximum(np.searchsorted(self.first, curve(places), side="right") - 1, 0)]

    def closer(self, places: np.ndarray, chord: np.ndarray, home: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each point the regions other than ``home`` whose boxes are no
        farther than ``chord``, nearest first: how many, their distances and
        numbers, one point after the other."""
        low, high, reach = places.min(0), places.max(0), chord.max() * (1 + SAFETY) + SAFETY
        gap = np.sqrt((np.maximum(0, np.maximum(self.low - high, low - self.high)) ** 2).sum(1))
        some = np.flatnonzero((gap <= reach) & (self.numbers != home))
        counts, distances, numbers = [], [], []
        step = max(1, AT_ONCE // max(1, len(some)))
        for at in range(0, len(places), step):
            p, c = places[at : at + step, None], chord[at : at + step, None]
            d = np.sqrt((np.maximum(0, np.maximum(self.low[some] - p, p - self.high[some])) ** 2).sum(2))
            who, which = np.nonzero(d <= c * (1 + SAFETY) + SAFETY)
            order = np.lexsort((which, d[who, which], who))
            counts.append(np.bincount(who, minlength=len(p)))
            distances.append(d[who, which][order])
            numbers.append(self.numbers[some[which]][order])
        return np.concatenate(counts), np.concatenate(distances), np.concatenate(numbers)


def _index(stations: DataFrame, region_rows: int, regions: int | None) -> tuple[DataFrame, Regions] | None:
    """The stations with ``region``, and the regions; None without a station."""
    def placed(y: pd.Series, x: pd.Series) -> pd.DataFrame:
        places = sphere(y.to_numpy(), x.to_numpy())
        return pd.DataFrame({"code": curve(places), **{f"p{k}": places[:, k] for k in range(3)}})

    rows = distinct_stations(stations)
    on_curve = F.pandas_udf(placed, "code bigint, p0 double, p1 double, p2 double")
    rows = _table(rows.withColumn("at", _by_value(lambda: on_curve("y", "x"))).select("*", "at.*").drop("at"), "stations-on-curve")
    n = rows.count()
    if not n:
        return None
    count = max(1, regions or -(-n // region_rows))
    dealt = _table(
        rows.repartitionByRange(count, "code").withColumn("region", F.spark_partition_id()), "stations-by-region"
    )
    axes = [f(f"p{k}").alias(f"{name}{k}") for k in range(3) for f, name in ((F.min, "low"), (F.max, "high"))]
    boxes = dealt.groupBy("region").agg(F.min("code").alias("first"), F.count(F.lit(1)).alias("n"), *axes).orderBy("first").collect()
    return dealt.select("region", F.struct("prec", "division", "y", "x").alias("station")), Regions(boxes)


def _solved(points: DataFrame, stations: DataFrame, regions: Regions, tasks: int) -> DataFrame:
    """``points`` (region, uid, lat, lon, ...) with ``best`` of their region's
    stations, its ``chord``, and ``todo``, the other regions that could hold a
    nearer one. Equal coordinates of a batch are solved once."""
    counts = {r["region"]: r["n"] for r in points.groupBy("region").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = max(1, -(-sum(counts.values()) // tasks))
    last = int(regions.numbers.max())
    parts = [-(-counts.get(k, 0) // max(share, regions.stations.get(k, 0))) for k in range(last + 1)]
    before = np.concatenate([[0], np.cumsum(parts)[:-1]]).tolist()
    of = lambda values: F.element_at(F.lit(values).cast("array<bigint>"), F.col("region") + 1)
    names = [c for c in points.columns if c != "region"]
    none = [F.lit(None).cast(points.schema[c].dataType).alias(c) for c in names]
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), of(parts) - 1))
    copies = stations.where(of(parts) > 0).select("*", part.alias("part"))
    known_places = copies.select((of(before) + F.col("part")).cast("int").alias("task"), "region", "station", *none)
    own = (of(before) + F.pmod(F.col("uid"), of(parts))).cast("int").alias("task")
    asked = points.select(own, "region", F.lit(None).cast(_STATION).alias("station"), *names)
    stream = (
        known_places.unionByName(asked)
        .repartitionById(max(1, sum(parts)), F.col("task"))
        .sortWithinPartitions("task", F.col("station").isNull())
    )
    schema = points.select("region", *names).schema
    for name, kind in (("near", f"array<{_STATION}>"), ("chord", "double"), ("todo", _TODO)):
        schema = schema.add(name, T._parse_datatype_string(kind))
    fields = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, leaves = [], None
        for batch in batches:
            station = batch.column("station")
            if station.null_count < len(station):
                parts.append(station.drop_null())
            batch = batch.filter(station.is_null())
            if not batch.num_rows:
                continue
            if leaves is None:  # a task has one part, and its stations come first
                cells = pa.concat_arrays(parts)
                leaves = Leaves(sphere(*(cells.field(c).to_numpy(zero_copy_only=False) for c in ("y", "x"))))
            where = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("lat", "lon")], 1)
            distinct, back = np.unique(where, axis=0, return_inverse=True)
            places, home = sphere(distinct[:, 0], distinct[:, 1]), batch.column("region")[0].as_py()
            offsets, members, chord = leaves.search(places)
            closer = [
                regions.closer(places[at : at + TILE], chord[at : at + TILE], home) for at in range(0, len(places), TILE)
            ]
            counts, d, number = (np.concatenate(column) for column in zip(*closer, strict=True))
            near, kind = fields.field("near").type, fields.field("todo").type
            to = pa.StructArray.from_arrays([pa.array(d), pa.array(number, pa.int32())], fields=list(kind.value_type))
            made = [
                lists(offsets, cells.take(pa.array(members)), near),
                pa.array(chord),
                lists(np.concatenate([[0], np.cumsum(counts)]), to, kind),
            ]
            back = pa.array(back.ravel())
            columns = [*[batch.column(c) for c in ("region", *names)], *[column.take(back) for column in made]]
            yield pa.RecordBatch.from_arrays(columns, schema=fields)

    found = _by_value(lambda: stream.mapInArrow(run, schema))
    return found.select(*names, best_of("near", "lat", "lon").alias("best"), "chord", "todo")


def solve_by_regions(
    points: DataFrame,
    stations: DataFrame,
    lat: str,
    lon: str,
    best: str,
    region_rows: int = REGION_ROWS,
    regions: int | None = None,
) -> DataFrame | None:
    """The points with known coordinates and ``best``, the struct of their
    nearest station; None without a known station. ``regions``: their number,
    instead of their size. Tables are written while the plan is built."""
    index = _index(stations, region_rows, regions)
    if index is None:
        return None
    places, boxes = index
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def home(lat: pd.Series, lon: pd.Series) -> pd.Series:
        return pd.Series(boxes.home(sphere(lat.to_numpy(), lon.to_numpy())), dtype="int32")

    at_home = F.pandas_udf(home, "int")
    given = points.where(known(lat) & known(lon)).select(
        F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("row"),
        F.col(lat).cast("double").alias("lat"),
        F.col(lon).cast("double").alias("lon"),
        F.monotonically_increasing_id().alias("uid"),
    )
    tagged = _table(given.withColumn("region", _by_value(lambda: at_home("lat", "lon"))), "points-by-region")
    # Of regions to visit only those stay that what was found does not rule out.
    reach = F.col("chord") * (1 + SAFETY) + SAFETY
    still = F.filter("todo", lambda x: x["d"] <= reach)
    open_ = _table(_solved(tagged, places, boxes, tasks), "points-solved")
    done = [open_.where(F.size("todo") == 0).select("row", "best")]
    open_, ring = open_.where(F.size("todo") > 0), 1
    while not open_.isEmpty():
        visits = open_.select("uid", "lat", "lon", F.explode(F.slice("todo", 1, ring)).alias("to"))
        visits = _table(visits.select("uid", "lat", "lon", F.col("to.region").alias("region")), "points-visiting")
        met = _solved(visits, places, boxes, tasks).groupBy("uid").agg(F.min("best").alias("other"), F.min("chord").alias("near"))
        rest = F.slice("todo", ring + 1, F.greatest(F.size("todo") - ring, F.lit(0)))
        open_ = (
            open_.join(met, "uid")
            .withColumn("todo", rest)
            .withColumn("best", F.least("best", "other"))
            .withColumn("chord", F.least("chord", "near"))
            .withColumn("todo", still)
            .drop("other", "near")
        )
        open_ = _table(open_, "points-solved")
        done.append(open_.where(F.size("todo") == 0).select("row", "best"))
        open_, ring = open_.where(F.size("todo") > 0), 2 * ring
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("row.*", F.col("best").alias(best))


__all__ = ["REGION_ROWS", "Regions", "curve", "solve_by_regions"]
