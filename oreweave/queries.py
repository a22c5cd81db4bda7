"""Queries of the core training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreweave.functions.geo import decimal
from oreweave.operators.packed import unpack_values
from oreweave.operators.proximity import circles, locate, regions
from oreweave.operators.units import agreeing_pairs, harmonise, stated_values
from oreweave.session import table
from oreweave.sql_units import PAIRS, STATED

Query = Callable[[SparkSession, str], DataFrame]


def p1_values(spark: SparkSession, d: str) -> DataFrame:
    return harmonise(table(spark, d, "deposit_statements"), table(spark, d, "source_list"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return agreeing_pairs(p1_values(spark, d))


def p1_stated(spark: SparkSession, d: str) -> DataFrame:
    """Stated numbers in common units, where evidence names a unit."""
    known = stated_values(table(spark, d, "deposit_statements"), table(spark, d, "source_list")).where("value is not null")
    return known.select("statement_id", "record_id", "field", "number", F.round(F.log10(F.nullif("value", F.lit(0.0))), 9).alias("log10_value"))


def _points(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "mrds_registry").select(
        "row_id", decimal(F.col("latitude")).alias("latitude"), decimal(F.col("longitude")).alias("longitude")
    )


def p4_stations(spark: SparkSession, d: str) -> DataFrame:
    found = locate(_points(spark, d), circles(table(spark, d, "stations"), "station", 10.0, "station_id"), "row_id")
    return found.select("row_id", F.col("place_id").alias("station_id"), F.round("km", 6).alias("km"))


def p4_located(spark: SparkSession, d: str) -> DataFrame:
    points = _points(spark, d)
    shapes = circles(table(spark, d, "stations"), "station", 10.0, "station_id").unionByName(
        regions(table(spark, d, "geology_units"), "unit", "unit_id")
    )
    return locate(points, shapes, "row_id")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_located(spark, d).where("inside").select("row_id", "place_kind", F.col("place_id").cast("int").alias("place_id"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return unpack_values(table(spark, d, "mrds_registry"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p1_values, p1_stated, p4_found, p4_located, p4_stations, p7_found)}


def oracle_sql() -> dict[str, str]:
    number = r"^\s*[+\-]?(\d+\.?\d*|\.\d+)([eE][+\-]?\d+)?\s*$"
    plain = lambda c: f"CASE WHEN regexp_matches({c}, '{number}') THEN try_cast(trim({c}) AS DOUBLE) END"
    return {
        "p1_found": PAIRS,
        "p1_stated": f"WITH {STATED} SELECT statement_id, rid AS record_id, field, number, round(log10(nullif(value, 0)), 9) AS log10_value FROM stated WHERE value IS NOT NULL",
        "p4_stations": f"""
WITH p AS (SELECT row_id, {plain('latitude')} AS lat, {plain('longitude')} AS lon FROM mrds_registry),
near AS (
  SELECT row_id, station_id::BIGINT AS station_id, 2 * 6371.0088 * asin(sqrt(least(1, pow(sin(radians(s.latitude - lat) / 2), 2)
    + cos(radians(lat)) * cos(radians(s.latitude)) * pow(sin(radians(s.longitude - lon) / 2), 2)))) AS km
  FROM p JOIN stations s ON abs(s.latitude - lat) <= 0.0901 WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180)
SELECT row_id, station_id, round(km, 6) AS km FROM near WHERE km <= 10""",
    }
