"""Nearest station (k = 1 nearest neighbour under great-circle distance).

Semantics: for every point with known coordinates, the station with the
smallest distance; exact ties go to the smallest ``prec``. A coordinate that is
NULL, NaN or infinite is unknown: such stations are ignored, such points get no
row, nor does any point if there is no station. Coordinates beyond the usual
ranges (latitude and longitude swapped, say) are points like any other: the
great-circle formula is periodic in both.

Two methods, with the same answers:

* A station dimension of at most ``block_rows``, the bound of what is collected
  and broadcast, goes to the tasks as one block (below). More stations are dealt
  along a space-filling curve together with the points
  (:mod:`precinct.operators.nearest_regions`), which reads the points once for
  any number of stations. ``method="blocks"`` sends any number of stations block
  by block instead, a pass over the points for each; a point keeps the best.
* In a task, a block's stations are points of the unit sphere, halved along
  their widest axis into leaves of a few stations, a tree of bounding boxes. The
  points of a batch, made distinct, go down the tree together: each first to the
  leaf it falls into, whose nearest station bounds its answer, then to the boxes
  within that bound. A point compares the stations of a few leaves, however many
  stations there are. Chord length and distance on the sphere have the same order.
* The chord only selects: all stations within rounding error of the smallest
  chord are handed on, and Spark's own expression of the distance decides
  between them, ties included.

With a block, points are solved in place, in the partitions they come in: no
shuffle, no second scan, no join back, and a hot coordinate is one row of its
batch.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

import precinct
from precinct.functions._cols import unused
from precinct.functions.geo import haversine_km, known
from precinct.lifetimes import sent
from precinct.operators.joins import hinted

OUT_COLS = ("near_prec", "near_division", "near_y", "near_x", "near_km")

#: Stations of a block, the bound of what is broadcast at once.
BLOCK_ROWS = 200_000
#: Stations of a leaf at most; pairs of points and boxes that are held at once.
LEAF, AT_ONCE = 32, 1 << 16
#: Chords this close to the smallest are decided by the distance itself.
SAFETY = 1e-9

_STATIONS = "array<struct<prec:int,division:string,y:double,x:double>>"


def sphere(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Points of the unit sphere, one row each."""
    p, q = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(p) * np.cos(q), np.cos(p) * np.sin(q), np.sin(p)], 1)


class Leaves:
    """Places in groups of at most ``LEAF`` that lie close together, below a
    binary tree of boxes: node k of a level has the children 2k and 2k + 1."""

    def __init__(self, places: np.ndarray):
        groups: list[np.ndarray] = [np.arange(len(places))]
        #: Axis and place of each node's cut, level by level.
        self.cuts: list[tuple[np.ndarray, np.ndarray]] = []
        while len(groups[-1]) > LEAF:  # the last group of a level is its largest
            axes, at, halves = [], [], []
            for own in groups:
                axis, half = int(np.ptp(places[own], axis=0).argmax()), len(own) // 2
                own = own[np.argpartition(places[own, axis], half)]
                axes.append(axis)
                at.append(places[own[half], axis])
                halves += [own[:half], own[half:]]
            self.cuts.append((np.array(axes), np.array(at)))
            groups = halves
        width = max(map(len, groups))
        #: Members of the leaves; short ones are filled up with places that are never near.
        self.members = np.zeros((len(groups), width), np.int64)
        self.places = np.full((len(groups), width, 3), np.inf)
        for k, own in enumerate(groups):
            self.members[k, : len(own)], self.places[k, : len(own)] = own, places[own]
        low, high = np.array([places[g].min(0) for g in groups]), np.array([places[g].max(0) for g in groups])
        #: Corners of the boxes, level by level from the root's children down.
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []
        for _ in self.cuts:
            self.boxes.insert(0, (low, high))
            low, high = np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2])
        self.low, self.high = low[0], high[0]  # the root's
        self.compared = 0  # pairs of points and places so far

    def _chords(self, points: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """Chords of each point to the members of its leaf."""
        out = np.empty((len(leaves), self.members.shape[1]))
        step = max(1, AT_ONCE * 4 // out.shape[1])
        for at in range(0, len(leaves), step):
            gap = self.places[leaves[at : at + step]]
            gap -= points[at : at + step, None]
            out[at : at + step] = np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))
        self.compared += out.size
        return out

    def _inside(self, points: np.ndarray) -> np.ndarray:
        """The leaf on whose side of every cut a point is."""
        node = np.zeros(len(points), np.int64)
        for axes, at in self.cuts:
            node = 2 * node + (points[np.arange(len(points)), axes[node]] >= at[node])
        return node

    def _facing(self, points: np.ndarray) -> np.ndarray:
        """The leaf found by going to the nearer box, for points outside of all."""
        node = np.zeros(len(points), np.int64)
        for level in range(len(self.cuts)):
            first, second = (self._gaps(level, 2 * node + k, points) for k in (0, 1))
            node = 2 * node + (second < first)
        return node

    def _gaps(self, level: int, node: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Distances of points and boxes below ``level``."""
        low, high = self.boxes[level]
        gap = np.maximum(0, np.maximum(low[node] - points, points - high[node]))
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def nearest(self, points: np.ndarray) -> list[np.ndarray]:
        """For each point the members nearest to it, within ``SAFETY``."""
        offsets, members, _ = self.search(points)
        return np.split(members, offsets[1:-1])

    def search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same as offsets, the members one point after the other, and the
        least chords."""
        least = np.full(len(points), np.inf)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        step = max(1, AT_ONCE // self.members.shape[1])
        for at in range(0, len(points), step):
            part = points[at : at + step]
            chord = self._chords(part, self._inside(part)).min(1)
            outside = np.flatnonzero(((part < self.low) | (part > self.high)).any(1))
            chord[outside] = np.minimum(chord[outside], self._chords(part[outside], self._facing(part[outside])).min(1))
            least[at : at + step] = chord
        todo = [(0, np.arange(at, min(at + step, len(points))), np.zeros(min(step, len(points) - at), np.int64))
                for at in range(0, len(points), step)]
        while todo:
            level, who, node = todo.pop()
            if len(who) > AT_ONCE // (1 if level < len(self.cuts) else self.members.shape[1]):
                half = len(who) // 2
                todo += [(level, who[half:], node[half:]), (level, who[:half], node[:half])]
                continue
            if level == len(self.cuts):
                chord = self._chords(points[who], node)
                np.minimum.at(least, who, chord.min(1))
                row, column = np.nonzero(chord <= (least[who] * (1 + SAFETY) + SAFETY)[:, None])
                found.append((who[row], self.members[node[row], column], chord[row, column]))
                continue
            who, node = np.repeat(who, 2), np.repeat(2 * node, 2)
            node[1::2] += 1
            near = self._gaps(level, node, points[who]) <= least[who] * (1 + SAFETY) + SAFETY
            if near.any():
                todo.append((level + 1, who[near], node[near]))
        who, member, chord = (np.concatenate(parts) for parts in zip(*found, strict=True))
        near = chord <= least[who] * (1 + SAFETY) + SAFETY
        who, member = who[near], member[near]
        member = member[np.argsort(who, kind="stable")]
        return np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(points)))]), member, least


def lists(offsets: np.ndarray, values: pa.Array, kind: pa.ListType) -> pa.Array:
    """``values`` as lists from each offset to the next."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values.cast(kind.value_type), type=kind)


def distinct_stations(stations: DataFrame) -> DataFrame:
    """(prec, division, y, x) of the known stations; of equal coordinates only
    the smallest ``prec`` can be an answer."""
    return (
        stations.where(known("y") & known("x"))
        .groupBy(F.col("y").cast("double").alias("y"), F.col("x").cast("double").alias("x"))
        .agg(F.min(F.struct(F.col("prec").cast("int").alias("prec"), "division")).alias("s"))
        .select("s.prec", "s.division", "y", "x")
    )


def _blocks(stations: DataFrame, block_rows: int) -> Iterator[pa.Array]:
    """The known stations, one block after the other."""
    rows = distinct_stations(stations)
    kind = pa.struct(to_arrow_schema(rows.schema))
    iterator = rows.toLocalIterator()
    while block := list(itertools.islice(iterator, block_rows)):
        columns = [pa.array(values, field.type) for values, field in zip(zip(*block, strict=True), kind, strict=True)]
        yield pa.StructArray.from_arrays(columns, fields=list(kind))


def _candidates(points: DataFrame, block: pa.Array, lat: str, lon: str, near: str) -> DataFrame:
    """``points`` with ``near``: the block's stations nearest to each."""
    stations = sent(points.sparkSession, block)
    schema = T.StructType([*points.schema.fields, T.StructField(near, T._parse_datatype_string(_STATIONS))])
    kind = to_arrow_schema(T.StructType([schema.fields[-1]])).field(0).type
    i, j = points.columns.index(lat), points.columns.index(lon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, leaves = stations.value, None
        for batch in batches:
            if leaves is None:
                leaves = Leaves(sphere(*(cells.field(c).to_numpy(zero_copy_only=False) for c in ("y", "x"))))
            where = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in (i, j)], 1)
            distinct, back = np.unique(where, axis=0, return_inverse=True)
            offsets, members, _ = leaves.search(sphere(distinct[:, 0], distinct[:, 1]))
            column = lists(offsets, cells.take(pa.array(members)), kind).take(pa.array(back.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=schema.fieldNames())

    cloudpickle.register_pickle_by_value(precinct)  # for the time of pickling
    try:
        return points.mapInArrow(run, schema)
    finally:
        cloudpickle.unregister_pickle_by_value(precinct)


def best_of(near: str, lat: str, lon: str) -> Column:
    """The smallest (distance, prec) of an array of stations, with the rest."""

    def measured(s: Column) -> Column:
        d = haversine_km(F.col(lat), F.col(lon), s["y"], s["x"])
        return F.struct(d.alias("d"), s["prec"].alias("prec"), s["division"].alias("division"), s["y"].alias("y"), s["x"].alias("x"))

    return F.array_min(F.transform(F.col(near), measured))


def _by_blocks(points: DataFrame, stations: DataFrame, lat: str, lon: str, block_rows: int, best: str) -> DataFrame | None:
    """The points with known coordinates and ``best``, None without a known
    station: a pass over the points for each block of stations."""
    todo, found, near = points.where(known(lat) & known(lon)), None, unused("near", [*points.columns, best])
    for block in _blocks(stations, block_rows):
        todo = _candidates(todo, block, lat, lon, near)
        own = best_of(near, lat, lon)
        found = own if found is None else F.least(F.col(best), own)
        todo = todo.select(*points.columns, found.alias(best))
    return None if found is None else todo


def nearest_station(
    points: DataFrame,
    stations: DataFrame,
    lat: str = "lat",
    lon: str = "lon",
    hint: str | None = None,
    block_rows: int = BLOCK_ROWS,
    method: str = "auto",
    regions: int | None = None,
) -> DataFrame:
    """Add ``near_prec, near_division, near_y, near_x, near_km`` to each point;
    every other column of ``points`` is kept as it is. With ``hint`` the
    station's division comes from a join on its key and place under that
    strategy. ``method``: "blocks", "regions" (``regions`` of them, or as many as
    the stations fill), or "auto": one block if the stations fit, else regions.
    The stations are read while the plan is built."""
    if method not in ("auto", "blocks", "regions"):
        raise ValueError(f"unknown method {method!r}")
    if method == "auto":
        method = "blocks" if stations.limit(block_rows + 1).count() <= block_rows else "regions"
    best = unused("best", points.columns)
    if method == "blocks":
        todo = _by_blocks(points, stations, lat, lon, block_rows, best)
    else:
        from precinct.operators.nearest_regions import solve_by_regions

        todo = solve_by_regions(points, stations, lat, lon, best, regions=regions)
    if todo is None:  # no station
        none = F.lit(None).cast("struct<d:double,prec:int,division:string,y:double,x:double>")
        todo = points.where(F.lit(False)).withColumn(best, none)
    b = F.col(best)
    out = todo.select(
        *points.columns,
        b["prec"].alias("near_prec"),
        b["division"].alias("near_division"),
        b["y"].alias("near_y"),
        b["x"].alias("near_x"),
        b["d"].alias("near_km"),
    )
    if hint is None:
        return out
    side = stations.select(
        F.col("prec").cast("int").alias("near_prec"),
        F.col("y").cast("double").alias("near_y"),
        F.col("x").cast("double").alias("near_x"),
        F.col("division").alias("near_division"),
    ).dropDuplicates(["near_prec", "near_y", "near_x"])
    joined = out.drop("near_division").join(hinted(side, hint), ["near_prec", "near_y", "near_x"], "inner")
    return joined.select(*points.columns, *OUT_COLS)
