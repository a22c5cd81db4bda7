"""Points near other points or inside regions (problem 4).

Latitude is cut into strips.  A point belongs to the one strip that holds it; a
place (a circle of a radius, or a region) is copied to every strip it overlaps,
so each pair has exactly one owner, the strip of its point.  Points and places
of a strip are sorted by longitude and swept: a place becomes active where its
longitude interval starts and is dropped where it ends, and the points met in
between are verified exactly.  The sort spills and the sweep streams, so a task
holds the active places and one Arrow batch, whatever the size of its strip.

A strip with many points is divided into chunks by a hash of the point's id, and
its places are copied to each chunk, so no location, however crowded, ends in
one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import asin, cos, degrees, pi, radians, sin

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreweave.functions.geo import EARTH_KM
from oreweave.functions.wkb import BOUNDARY, IN, OUT, parse_parts, side_of

STRIP_DEG = 0.25
CHUNK_ROWS = 200_000
#: Pairs of a point and a place's interval that are compared at once.
MET = 1_000_000

_SHAPE = "place_kind string, place_id long, start double, stop double, low double, high double, lat double, lon double, km double, part int, shape binary"


def circles(places: DataFrame, kind: str, radius_km: float, key: str, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Places as circles; those without valid coordinates are left out.

    A circle over the 180th meridian gets a second interval on the other side;
    one that holds a pole spans all longitudes.
    """
    r = radius_km / EARTH_KM

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for pid, la, lo in zip(b["place_id"], b["lat"], b["lon"]):
                low, high = la - degrees(r) - 1e-9, la + degrees(r) + 1e-9
                if abs(la) + degrees(r) >= 90 or r >= pi / 2:
                    spans = [(-180.0, 180.0)]
                else:
                    half = degrees(asin(min(1.0, sin(r) / cos(radians(la))))) + 1e-9
                    spans = [(lo - half, lo + half)]
                    if lo - half < -180:
                        spans.append((lo - half + 360, 180.0))
                    if lo + half > 180:
                        spans.append((-180.0, lo + half - 360))
                rows += [(kind, pid, a, z, low, high, la, lo, radius_km, 0, None) for a, z in spans]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _SHAPE.split(", ")])

    valid = places.where(F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180) & F.col(key).isNotNull())
    return valid.select(
        F.col(key).cast("long").alias("place_id"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon")
    ).mapInPandas(build, _SHAPE)


def regions(layer: DataFrame, kind: str, key: str, geometry: str = "geometry") -> DataFrame:
    """Parts of polygons and multipolygons with their bounds; null geometries are left out."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for pid, data in zip(b["place_id"], b["shape"]):
                for k, rings in enumerate(parse_parts(bytes(data))):
                    (x0, y0), (x1, y1) = rings[0].min(axis=0), rings[0].max(axis=0)
                    rows.append((kind, pid, x0, x1, y0, y1, None, None, None, k, data))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _SHAPE.split(", ")])

    return (
        layer.where(F.col(geometry).isNotNull() & F.col(key).isNotNull())
        .select(F.col(key).cast("long").alias("place_id"), F.col(geometry).alias("shape"))
        .mapInPandas(build, _SHAPE)
    )


def _great_circle(lat1: np.ndarray, lon1: np.ndarray, lat2: float, lon2: float) -> np.ndarray:
    p1, p2 = np.radians(lat1), radians(lat2)
    a = np.sin((p1 - p2) / 2) ** 2 + np.cos(p1) * cos(p2) * np.sin(np.radians(lon1 - lon2) / 2) ** 2
    return 2 * EARTH_KM * np.arcsin(np.sqrt(np.minimum(1.0, a)))


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by strip, chunk, event; places (point null) before points at equal events."""
    here: tuple | None = None
    active: list[tuple] = []
    for b in batches:
        strip, chunk = b["strip"].to_numpy(), b["chunk"].to_numpy()
        cuts = np.flatnonzero((np.diff(strip) != 0) | (np.diff(chunk) != 0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(b)]):
            if hi <= lo:
                continue
            if (strip[lo], chunk[lo]) != here:
                here, active = (strip[lo], chunk[lo]), []
            piece = b.iloc[lo:hi]
            is_place = piece["is_place"].to_numpy()
            new = piece[is_place]
            active += list(
                zip(new["event"], new["stop"], new["place_kind"], new["place_id"], new["lat"], new["lon"], new["km"], new["part"], new["shape"])
            )
            points = piece[~is_place]
            x, y = points["lon"].to_numpy(), points["lat"].to_numpy()
            if len(x):
                ids = points["point"].to_numpy()
                first = np.searchsorted(x, [a[0] for a in active], "left")
                last = np.searchsorted(x, [a[1] for a in active], "right")
                # points are taken in runs that meet about MET places' intervals at most, so the pairs held at once are bounded
                opened, closed = np.bincount(first, minlength=len(x) + 1), np.bincount(last, minlength=len(x) + 1)
                met = np.cumsum(np.cumsum(opened - closed)[: len(x)])
                # equal points lie side by side and stay together
                fresh = np.flatnonzero(np.append((x[1:] != x[:-1]) | (ids[1:] != ids[:-1]), True)) + 1
                step = np.unique(fresh[np.searchsorted(fresh, np.flatnonzero(np.diff(met // MET)) + 1)])[: len(x)]
                for lo_, hi_ in zip([0, *step], [*step, len(x)]):
                    out = _meet(active, np.maximum(first, lo_), np.minimum(last, hi_), x, y, ids)
                    if out is not None:
                        yield out
                reached = x[-1]
                active = [a for a in active if a[1] >= reached]


def _meet(active: list[tuple], first: np.ndarray, last: np.ndarray, x: np.ndarray, y: np.ndarray, ids: np.ndarray) -> pd.DataFrame | None:
    """The pairs of each active place and the points first to last."""
    found: list[tuple] = []
    for k in np.flatnonzero(first < last):
        (_, _, kind, place, la, lo, km, part, data), i, j = active[k], first[k], last[k]
        if data is None:
            far = _great_circle(y[i:j], x[i:j], la, lo)
            hit = far <= km
            found.append((ids[i:j][hit], kind, place, far[hit], np.full(hit.sum(), IN, "i1")))
        else:
            side = side_of(parse_parts(bytes(data))[int(part)], x[i:j], y[i:j])
            hit = side != OUT
            found.append((ids[i:j][hit], kind, place, np.full(hit.sum(), np.nan), side[hit]))
    found = [f for f in found if len(f[0])]
    if not found:
        return None
    sizes = [len(f[0]) for f in found]
    kinds, places = pd.factorize(np.array([f[1] for f in found], dtype=object)), np.array([f[2] for f in found])
    out = pd.DataFrame(
        {
            "point": np.concatenate([f[0] for f in found]),
            "place_kind": pd.Categorical.from_codes(np.repeat(kinds[0], sizes), kinds[1]),
            "place_id": np.repeat(places, sizes),
            "km": np.concatenate([f[3] for f in found]),
            "side": np.concatenate([f[4] for f in found]),
        }
    )
    lo, hi = first[first < last].min(), last.max()
    if any(a[8] is not None for a in active) or len({(a[2], a[3]) for a in active}) < len(active) or len(set(ids[lo:hi])) < hi - lo:
        # a place can meet a point by two intervals or parts; the strongest side counts
        out = out.sort_values("side", ascending=False, kind="stable").drop_duplicates(["point", "place_kind", "place_id"])
    return out.astype({"place_kind": object})


def _tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of the pairs of _sweep, the number and the least point of each place."""
    for out in _sweep(batches):
        places = out.groupby(["place_kind", "place_id"], sort=False)["point"]
        yield places.agg(n="size", least="min").reset_index()


def in_strips(points: DataFrame, shapes: DataFrame, strip_deg: float = STRIP_DEG, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Points (point, lat, lon and more) in their strips and chunks, and places (start, low, high and more) in all that they overlap.

    Both carry strip, chunk, event and is_place, and are null in what only the
    others have.  Points without a key or valid coordinates are left out.
    """
    kept = points.where(F.col("point").isNotNull() & F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)).withColumn(
        "strip", F.floor(F.col("lat") / strip_deg).cast("int")
    )
    # at most 180 / strip_deg + 1 rows, whatever the data: that bound allows the broadcast
    chunks = F.broadcast(kept.groupBy("strip").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("chunks")))
    left = kept.join(chunks, "strip").select(
        "strip",
        F.pmod(F.xxhash64("point"), F.col("chunks")).cast("int").alias("chunk"),
        F.col("lon").alias("event"),
        F.lit(False).alias("is_place"),
        *points.columns,
    )
    overlapped = F.sequence(
        F.floor(F.greatest("low", F.lit(-90.0)) / strip_deg).cast("int"), F.floor(F.least("high", F.lit(90.0)) / strip_deg).cast("int")
    )
    right = (
        shapes.withColumn("strip", F.explode(overlapped))
        .join(chunks, "strip")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("strip", "chunk", F.col("start").alias("event"), F.lit(True).alias("is_place"), *[c for c in shapes.columns if c not in ("start", "low", "high")])
    )
    return left.unionByName(right, allowMissingColumns=True)


def locate(
    points: DataFrame,
    shapes: DataFrame,
    key: str,
    lat: str = "latitude",
    lon: str = "longitude",
    strip_deg: float = STRIP_DEG,
    chunk_rows: int = CHUNK_ROWS,
    tally: bool = False,
) -> DataFrame:
    """(key, place_kind, place_id, km, inside): every pair of a point and a place that holds it.

    ``shapes`` from :func:`circles` and :func:`regions`, unioned as wished.  km is
    null for regions; inside is false for points on a region's boundary.  Points
    without a key or valid coordinates meet nothing; repeated rows are kept as
    often as they occur, except that equal keys within one location count once.
    Empty inputs give an empty result.  Other columns are not read.  With
    ``tally`` the result is (place_kind, place_id, n, least): the number of pairs
    and the least key of each place that holds a point, counted in the sweep.
    """
    kind = points.schema[key].dataType
    kept = points.select(F.col(key).alias("point"), F.col(lat).alias("lat"), F.col(lon).alias("lon"))
    ordered = in_strips(kept, shapes, strip_deg, chunk_rows).repartition("strip", "chunk").sortWithinPartitions("strip", "chunk", "event", F.col("is_place").desc(), "point")
    point, place = T.StructField("point", kind), [T.StructField("place_kind", T.StringType()), T.StructField("place_id", T.LongType())]
    if tally:
        counted = ordered.mapInPandas(_tally, T.StructType([*place, T.StructField("n", T.LongType()), T.StructField("least", kind)]))
        return counted.groupBy("place_kind", "place_id").agg(F.sum("n").alias("n"), F.min("least").alias("least"))
    swept = ordered.mapInPandas(_sweep, T.StructType([point, *place, T.StructField("km", T.DoubleType()), T.StructField("side", T.ByteType())]))
    return swept.select(
        F.col("point").alias(key), "place_kind", "place_id", F.nanvl("km", F.lit(None)).alias("km"), (F.col("side") == IN).alias("inside")
    )


__all__ = ["BOUNDARY", "IN", "OUT", "circles", "in_strips", "locate", "regions"]
