"""Polygon layers: shapefile, GeoJSON and GeoPackage, as WKB with the geology attributes."""

from __future__ import annotations

import json
import os
import re
import sqlite3
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from oreweave.functions.constants import GEOLOGY_ALIASES
from oreweave.functions.wkb import multipolygon_wkb, polygon_wkb
from oreweave.operators.registry import any_case_alias
from oreweave.session import cut_lineage

GEOGRAPHIC = ("WGS_1984", "WGS 84", "WGS84", "NORTH_AMERICAN_1983", "NAD83", "CRS84")


def check_crs(text: str | None) -> None:
    """Accepts no CRS, WGS84 and NAD83 in degrees (taken as WGS84, 1-2 m apart); raises for others."""
    if text and (text.strip().upper().startswith("PROJ") or not any(g.upper() in text.upper() for g in GEOGRAPHIC)):
        raise ValueError(f"unsupported coordinate reference system: {text[:80]}")


def _signed_area(ring: list[tuple[float, float]]) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1])) / 2


def _inside(point: tuple[float, float], ring: list[tuple[float, float]]) -> bool:
    x, y = point
    odd = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            odd = not odd
    return odd


def rings_to_wkb(rings: list[list[tuple[float, float]]]) -> bytes | None:
    """Shapefile rings (outer clockwise, holes counter-clockwise) as WKB."""
    outer = [[r] for r in rings if _signed_area(r) <= 0]
    for hole in (r for r in rings if _signed_area(r) > 0):
        home = next((p for p in outer if _inside(hole[0], p[0])), None)
        (home.append(hole) if home else outer.append([hole]))
    if not outer:
        return None
    return polygon_wkb(outer[0]) if len(outer) == 1 else multipolygon_wkb(outer)


def read_shapes(data: bytes) -> Iterator[bytes | None]:
    at = 100
    while at + 12 <= len(data):
        size = 2 * struct.unpack_from(">i", data, at + 4)[0]
        kind = struct.unpack_from("<i", data, at + 8)[0]
        if kind in (5, 15, 25):
            parts, points = struct.unpack_from("<ii", data, at + 44)
            starts = [*struct.unpack_from(f"<{parts}i", data, at + 52), points]
            xy = at + 52 + 4 * parts
            every = [struct.unpack_from("<dd", data, xy + 16 * i) for i in range(points)]
            yield rings_to_wkb([every[a:z] for a, z in zip(starts, starts[1:])])
        else:
            yield None
        at += 8 + size


def read_attributes(data: bytes, encoding: str) -> tuple[list[str], Iterator[list[str | None]]]:
    count, header, size = struct.unpack_from("<IHH", data, 4)
    fields = []
    for at in range(32, header - 1, 32):
        if data[at] == 0x0D:
            break
        fields.append((data[at : at + 11].split(b"\0")[0].decode("ascii", "ignore"), data[at + 16]))

    def rows() -> Iterator[list[str | None]]:
        for i in range(count):
            at = header + i * size + 1
            row = []
            for _, width in fields:
                row.append(data[at : at + width].decode(encoding, "replace").strip() or None)
                at += width
            yield row

    return [n for n, _ in fields], rows()


class ShapefileSource(DataSource):
    """format("shapefile"): attributes as text and ``geometry`` as WKB, one partition per file."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def _paths(self) -> list[str]:
        path = self.options["path"].removeprefix("file:")
        return sorted(os.path.join(path, f) for f in os.listdir(path) if f.endswith(".shp")) if os.path.isdir(path) else [path]

    def schema(self) -> StructType:
        with open(self._paths()[0][:-4] + ".dbf", "rb") as f:
            names, _ = read_attributes(f.read(32 * 256), "latin-1")
        return StructType([*[StructField(n, StringType()) for n in names], StructField("geometry", BinaryType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _ShapefileReader(self._paths())


class _ShapefileReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        base = partition.value[:-4]
        if os.path.exists(base + ".prj"):
            check_crs(open(base + ".prj").read())
        encoding = open(base + ".cpg").read().strip() if os.path.exists(base + ".cpg") else "latin-1"
        with open(base + ".shp", "rb") as f, open(base + ".dbf", "rb") as g:
            _, rows = read_attributes(g.read(), encoding)
            for shape, row in zip(read_shapes(f.read()), rows):
                yield (*row, shape)


def geojson_wkb(geometry: str | None) -> bytes | None:
    g = json.loads(geometry) if geometry else None
    if not g or g.get("type") not in ("Polygon", "MultiPolygon"):
        return None
    pairs = lambda ring: [(float(x[0]), float(x[1])) for x in ring]
    if g["type"] == "Polygon":
        return polygon_wkb([pairs(r) for r in g["coordinates"]])
    return multipolygon_wkb([[pairs(r) for r in p] for p in g["coordinates"]])


def _read_geojson(spark: SparkSession, path: str) -> DataFrame:
    wkb = F.pandas_udf(lambda g: g.map(geojson_wkb), BinaryType())
    whole = spark.read.text(path, wholetext=True)
    crs = F.get_json_object("value", "$.crs.properties.name")
    for row in whole.select(crs.alias("c")).where("c is not null").distinct().limit(10).collect():
        check_crs(row["c"])
    features = F.from_json(F.get_json_object("value", "$.features"), "array<struct<properties:map<string,string>,geometry:string>>")
    rows = whole.select(F.explode(features).alias("f")).select("f.properties", wkb("f.geometry").alias("geometry"))
    keys = [r[0] for r in rows.select(F.explode(F.map_keys("properties"))).distinct().collect()]
    return rows.select(*[F.col("properties")[k].alias(k) for k in sorted(keys)], "geometry")


def gpkg_wkb(blob: bytes | None) -> bytes | None:
    """WKB inside a GeoPackage geometry blob."""
    if not blob or blob[:2] != b"GP":
        return None
    envelope = (0, 32, 48, 48, 64)[(blob[3] >> 1) & 7]
    return bytes(blob[8 + envelope :])


class GeopackageSource(DataSource):
    """format("geopackage"): attributes as text and ``geometry`` as WKB of one table, in partitions of row ids."""

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def _open(self) -> tuple[sqlite3.Connection, str, str]:
        path = self.options["path"]
        db = sqlite3.connect(f"file:{path.removeprefix('file:')}?mode=ro", uri=True)
        found = db.execute("select table_name, column_name, srs_id from gpkg_geometry_columns").fetchall()
        table = self.options.get("table")
        name, column, srs = next((f for f in found if table in (None, "", f[0])), (None, None, None))
        if name is None or not re.fullmatch(r"[\w .-]+", name):
            raise ValueError(f"no geometry table in {path}")
        if srs not in (4326, 4269, 0, -1):
            raise ValueError(f"unsupported coordinate reference system: EPSG {srs}")
        return db, name, column

    def schema(self) -> StructType:
        db, name, column = self._open()
        names = [d[0] for d in db.execute(f'select * from "{name}" limit 0').description]
        db.close()
        return StructType([StructField("geometry" if n == column else n, BinaryType() if n == column else StringType()) for n in names])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _GeopackageReader(self)


class _GeopackageReader(DataSourceReader):
    ROWS = 20_000

    def __init__(self, source: GeopackageSource):
        self.source = source

    def partitions(self) -> list[InputPartition]:
        db, name, _ = self.source._open()
        low, high = db.execute(f'select min(rowid), max(rowid) from "{name}"').fetchone()
        db.close()
        return [InputPartition((at, at + self.ROWS)) for at in range(low or 0, (high or 0) + 1, self.ROWS)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        db, name, column = self.source._open()
        cursor = db.execute(f'select * from "{name}" where rowid >= ? and rowid < ? order by rowid', partition.value)
        shape = [d[0] for d in cursor.description].index(column)
        for row in cursor:
            yield tuple(gpkg_wkb(v) if i == shape else None if v is None else str(v) for i, v in enumerate(row))
        db.close()


def read_layer(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """Any supported layer with its own attribute columns and ``geometry``."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind == "gpkg":
        spark.dataSource.register(GeopackageSource)
        return spark.read.format("geopackage").option("table", table or "").load(path)
    if kind in ("geojson", "json"):
        return _read_geojson(spark, path)
    if kind == "parquet":
        return spark.read.parquet(path)
    spark.dataSource.register(ShapefileSource)
    return spark.read.format("shapefile").load(path)


def load_geology(spark: SparkSession, path: str) -> DataFrame:
    """(unit_id, geometry, geologic_unit, geology_description, geologic_age_raw, lithology_raw): attributes by alias."""
    layer = read_layer(spark, path)
    picked = [any_case_alias(layer, a).cast("string").alias(f) for f, a in GEOLOGY_ALIASES.items()]
    # read more than once by the joins, with other columns each time: numbered once
    return cut_lineage(layer.select(F.monotonically_increasing_id().alias("unit_id"), "geometry", *picked))
