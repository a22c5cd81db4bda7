import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from oreweave.functions.geo import EARTH_KM
from oreweave.functions.wkb import BOUNDARY, IN, OUT, multipolygon_wkb, parse_parts, polygon_wkb, side_of
from oreweave.operators import proximity
from oreweave.operators.proximity import circles, locate, regions


def far(lat1, lon1, lat2, lon2):
    a = np.sin(np.radians(lat1 - lat2) / 2) ** 2 + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * np.sin(np.radians(lon1 - lon2) / 2) ** 2
    return 2 * EARTH_KM * np.arcsin(np.sqrt(a))


def test_against_brute_force_with_poles_dateline_and_hot_spot(spark):
    rng = np.random.default_rng(3)
    n = 3000
    lat = np.concatenate([rng.uniform(-90, 90, n), rng.uniform(89.5, 90, 200), rng.uniform(-1, 1, 400), np.full(1500, 10.0)])
    lon = np.concatenate([rng.uniform(-180, 180, n), rng.uniform(-180, 180, 200), rng.choice([-1, 1], 400) * rng.uniform(179.5, 180, 400), np.full(1500, 20.0)])
    points = [(i, float(a), float(o)) for i, (a, o) in enumerate(zip(lat, lon))]
    places = [(1, 10.0, 20.3), (2, 0.0, 179.99), (3, 0.1, -179.99), (4, 89.9, 0.0), (5, -90.0, 0.0), (6, 45.0, 45.0), (7, None, 1.0)]
    df = spark.createDataFrame(points, "id long, latitude double, longitude double")
    shapes = circles(spark.createDataFrame(places, "k int, latitude double, longitude double"), "c", 60.0, "k")
    got = {(r["id"], r["place_id"]) for r in locate(df, shapes, "id", chunk_rows=100).collect()}
    want = {(i, k) for k, a, o in places if a is not None for i in np.flatnonzero(far(lat, lon, a, o) <= 60.0)}
    assert got == want and len(got) > 1500


def test_regions_holes_parts_and_boundaries(spark):
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    hole = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]
    far_part = [(178.0, 0.0), (180.0, 0.0), (180.0, 2.0), (178.0, 2.0), (178.0, 0.0)]
    other_side = [(-180.0, 0.0), (-178.0, 0.0), (-178.0, 2.0), (-180.0, 2.0), (-180.0, 0.0)]
    layer = spark.createDataFrame(
        [(1, bytearray(polygon_wkb([square, hole[::-1]]))), (2, bytearray(multipolygon_wkb([[far_part], [other_side]]))), (3, None), (4, bytearray(polygon_wkb([square[::-1]])))],
        "unit_id int, geometry binary",
    )
    points = [(1, 3.0, 3.0), (2, 1.5, 1.5), (3, 0.0, 2.0), (4, 1.0, 179.0), (5, 1.0, -179.0), (6, 5.0, 5.0), (7, None, 1.0), (8, 91.0, 1.0), (9, 1.0, 1.0)]
    df = spark.createDataFrame([(a, b, c, "x") for a, b, c in points], "id long, latitude double, longitude double, place_id string")
    got = {(r["id"], r["place_id"], r["inside"]) for r in locate(df, regions(layer, "unit", "unit_id"), "id").collect()}
    assert got == {(1, 1, True), (1, 4, True), (2, 4, True), (3, 1, False), (3, 4, False), (4, 2, True), (5, 2, True), (9, 1, False), (9, 4, True)}


def test_empty_inputs_and_bad_geometry(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0)], "id long, latitude double, longitude double")
    shapes = circles(df, "c", 5.0, "id")
    assert locate(df.limit(0), shapes, "id").count() == 0
    assert locate(df, shapes.limit(0), "id").count() == 0
    with pytest.raises(ValueError):
        parse_parts(b"\x01\x03\x00\x00\x00\x01\x00")
    side = side_of(parse_parts(polygon_wkb([[(0, 0), (2, 0), (0, 2), (0, 0)]]))[0], np.array([0.5, 1.0, 2.0]), np.array([0.5, 1.0, 2.0]))
    assert side.tolist() == [IN, BOUNDARY, OUT]


def test_a_crowded_batch_is_met_in_bounded_runs(monkeypatch):
    monkeypatch.setattr(proximity, "MET", 1000)
    rng = np.random.default_rng(8)
    lat, lon = rng.uniform(10, 10.2, 700), np.sort(np.append(np.full(200, 20.0), rng.uniform(19.9, 20.1, 500)))
    rows = [(40, 0, 19.0, True, None, 21.0, "c", k, 10.1, 20.0, 12.0, 0, None) for k in range(60)]
    rows += [(40, 0, o, False, float(i), np.nan, None, 0, a, np.nan, np.nan, 0, None) for i, (a, o) in enumerate(zip(lat, lon))]
    b = pd.DataFrame(rows, columns="strip chunk event is_place point stop place_kind place_id lat lon km part shape".split())
    b.loc[~b["is_place"], "lon"] = lon
    parts = list(proximity._sweep(iter([b])))
    near = np.flatnonzero(far(lat, lon, 10.1, 20.0) <= 12.0)
    got = pd.concat(parts)
    assert max(map(len, parts)) <= 1100 and len(near) > 100
    assert set(zip(got["point"], got["place_id"])) == {(float(i), k) for i in near for k in range(60)} and len(got) == 60 * len(near)


def test_tally_counts_the_pairs(spark):
    df = spark.createDataFrame([(i, 10.0 + i % 7 / 10, 179.8 + i % 5 / 10 - 360 * (i % 5 > 2)) for i in range(200)], "id long, latitude double, longitude double")
    shapes = circles(df.where("id < 20"), "c", 40.0, "id")
    want = locate(df, shapes, "id").groupBy("place_id").agg(F.count("*"), F.min("id"))
    got = locate(df, shapes, "id", chunk_rows=20, tally=True).select("place_id", "n", "least")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 20
