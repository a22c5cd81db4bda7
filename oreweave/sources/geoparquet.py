"""GeoParquet scan and sink, and CSV."""

from __future__ import annotations

import csv
import io
import json
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, MapType, StructType

from oreweave.functions.geo import in_range
from oreweave.functions.udfs import point, point_place

_cache: dict[tuple[int, str], DataFrame] = {}


def with_points(df: DataFrame) -> DataFrame:
    """The frame with ``geometry`` made of valid longitude and latitude, null elsewhere."""
    ok = in_range(F.col("latitude"), F.col("longitude"))
    return df.withColumn("geometry", point(F.when(ok, F.col("longitude")), F.when(ok, F.col("latitude"))))


def with_coordinates(df: DataFrame) -> DataFrame:
    """The frame with ``longitude`` and ``latitude`` of its WKB points, null for other geometries."""
    place = point_place(F.col("geometry"))
    return df.withColumns({"longitude": place["x"], "latitude": place["y"]})


def geo_metadata(types: list[str]) -> bytes:
    column = {"encoding": "WKB", "geometry_types": types}
    return json.dumps({"version": "1.0.0", "primary_column": "geometry", "columns": {"geometry": column}}).encode()


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a local folder or a URI such as hdfs:// or s3://."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path.removeprefix("file:"))


def write_geoparquet(df: DataFrame, path: str, single_file: bool = False, types: tuple[str, ...] = ("Point",)) -> DataFrame:
    """Writes parts with the ``geo`` footer that Spark's own writer cannot set; returns (file, n) of the parts.

    ``path`` is a folder that all executors share, local or a URI.  Tasks write
    to a folder that readers skip; when all have ended, their parts are moved in
    and only then the old ones go, so a job that fails leaves the old data, and
    a table can be written onto the one it was read from.  A frame without rows
    gives one part without rows.  Longitude/latitude in WGS84, the format's default.
    """
    if "geometry" not in df.columns:
        df = with_points(df)
    run = uuid.uuid4().hex[:12]
    store, folder = _store(path)
    hidden = f"{folder}/_run-{run}"
    store.create_dir(hidden, recursive=True)
    footer = {b"geo": geo_metadata(list(types))}
    empty = to_arrow_schema(df.schema).with_metadata(footer)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at, _ = _store(path)
        name = f"part-{TaskContext.get().partitionId():05d}-{run}.parquet"
        mine = f"{hidden}/{name}.{TaskContext.get().taskAttemptId()}"
        writer, n = None, 0
        for b in batches:
            schema = b.schema.with_metadata({**(b.schema.metadata or {}), **footer})
            writer = writer or pq.ParquetWriter(mine, schema, compression="zstd", filesystem=at)
            writer.write_batch(b.cast(schema) if b.schema != schema else b)
            n += b.num_rows
        if writer:
            writer.close()
        yield pa.RecordBatch.from_pydict({"file": [mine if writer else None], "n": [n]}, schema=pa.schema([("file", pa.string()), ("n", pa.int64())]))

    parts = df.coalesce(1) if single_file else df
    written = [(r["file"], r["n"]) for r in parts.mapInArrow(write, "file string, n long").where("file is not null").toLocalIterator()]
    if not written:
        pq.write_table(empty.empty_table(), f"{hidden}/part-00000-{run}.parquet.0", filesystem=store)
        written = [(f"{hidden}/part-00000-{run}.parquet.0", 0)]
    old = [f.path for f in store.get_file_info(fs.FileSelector(folder)) if f.path.endswith(".parquet")]
    report = []
    for file, n in written:
        final = f"{folder}/{file.rsplit('/', 1)[1].rsplit('.', 1)[0]}"
        store.move(file, final)
        report.append((final, n))
    for file in old:
        store.delete_file(file)
    store.delete_dir(hidden)
    return df.sparkSession.createDataFrame(report, "file string, n long")


def read_geoparquet(spark: SparkSession, path: str) -> DataFrame:
    """A GeoParquet or plain Parquet table: points built where there is no geometry column, coordinates read where there are none."""
    df = spark.read.parquet(path)
    if "geometry" in df.columns:
        return df if {"latitude", "longitude"} <= set(df.columns) else with_coordinates(df)
    if not {"latitude", "longitude"} <= set(df.columns):
        raise ValueError(f"{path} has neither a geometry nor coordinates")
    return with_points(df)


def cached_table(spark: SparkSession, path: str) -> DataFrame:
    """The table of a path, cached until :func:`forget` is called for it."""
    key = (id(spark), path)
    if key not in _cache:
        _cache[key] = read_geoparquet(spark, path).cache()
    return _cache[key]


def forget(spark: SparkSession, path: str) -> None:
    df = _cache.pop((id(spark), path), None)
    if df is not None:
        df.unpersist()


def load_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The cached table, or None where the path does not exist."""
    try:
        return cached_table(spark, path)
    except Exception as e:  # Spark reports a missing path as an analysis error
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def flat_for_csv(df: DataFrame) -> DataFrame:
    """Without geometry, nested columns as JSON text."""
    flat = df.drop("geometry")
    nested = {f.name: F.to_json(f.name) for f in flat.schema if isinstance(f.dataType, (ArrayType, MapType, StructType))}
    return flat.withColumns(nested)


def write_csv(df: DataFrame, path: str) -> None:
    flat_for_csv(df).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def csv_bytes(df: DataFrame) -> bytes:
    """A download of all rows; the caller sees to it that they fit the driver, :func:`write_csv` has no such bound."""
    out = io.StringIO()
    flat = flat_for_csv(df)
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(flat.columns)
    writer.writerows(flat.toLocalIterator(prefetchPartitions=True))
    return out.getvalue().encode()


def geoparquet_bytes(df: DataFrame) -> bytes:
    """A download of all rows as one GeoParquet file, written part by part to memory."""
    df = df if "geometry" in df.columns else with_points(df)
    table = df.toArrow()
    out = io.BytesIO()
    pq.write_table(table.replace_schema_metadata({**(table.schema.metadata or {}), b"geo": geo_metadata(["Point"])}), out, compression="zstd")
    return out.getvalue()


def layer_of_upload(names: list[str]) -> str | None:
    """The last file of an upload that is a layer."""
    return next((n for n in reversed(names) if n.lower().endswith((".gpkg", ".geojson", ".json", ".shp"))), None)
