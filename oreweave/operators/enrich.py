"""Geologic unit, rock and age of the polygon that holds each deposit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreweave.functions.geo import in_range
from oreweave.functions.text import collapse, extract_age, extract_lithology
from oreweave.operators.proximity import locate, regions

GEOLOGY = ("geologic_unit", "geology_description", "lithology", "geologic_age")
RAW = ("geologic_unit", "geology_description", "geologic_age_raw", "lithology_raw")


def join_predicate(deposits: DataFrame, layer: DataFrame, predicate: str, key: str = "_ord", unit: str = "unit_id") -> DataFrame:
    """(key, unit_id) of every deposit and polygon: ``within`` (interior) or ``intersects`` (boundary too)."""
    if predicate not in ("within", "intersects"):
        raise ValueError(predicate)
    met = locate(deposits.where(in_range(F.col("latitude"), F.col("longitude"))), regions(layer, "unit", unit), key)
    met = met.where("inside") if predicate == "within" else met
    return met.select(key, F.col("place_id").alias(unit))


def spatial_join(deposits: DataFrame, layer: DataFrame, key: str = "_ord", unit: str = "unit_id") -> DataFrame:
    """Deposits with geology: one row each, null geology where no polygon holds the point.

    Of several polygons one with a unit name counts before one without, one whose
    interior holds the point before one whose boundary does, then the lowest id.
    Geology columns already present are dropped and found again.
    """
    bare = deposits.drop(*GEOLOGY)
    met = locate(bare.where(in_range(F.col("latitude"), F.col("longitude"))), regions(layer, "unit", unit), key)
    texts = layer.select(F.col(unit).cast("long").alias("place_id"), *RAW)
    # an unnamed unit counts as missed by the interior test, so it is met again with the boundaries
    place: Column = F.struct(F.col("geologic_unit").isNull(), ~(F.col("inside") & F.col("geologic_unit").isNotNull()), F.col("place_id"))
    best = met.join(texts, "place_id").groupBy(key).agg(F.min_by(F.struct(*RAW), place).alias("g")).select(key, "g.*")
    described = best.select(
        key,
        collapse(F.col("geologic_unit")).alias("geologic_unit"),
        collapse(F.col("geology_description")).alias("geology_description"),
        F.coalesce(collapse(F.col("lithology_raw")), extract_lithology(F.col("geologic_unit"), F.col("geology_description"))).alias("lithology"),
        F.coalesce(collapse(F.col("geologic_age_raw")), extract_age(F.col("geologic_unit"), F.col("geology_description"))).alias("geologic_age"),
    )
    return bare.join(described, key, "left")


def ensure_geology(df: DataFrame) -> DataFrame:
    """The frame with any missing geology column as null."""
    return df.withColumns({c: F.lit(None).cast("string") for c in GEOLOGY if c not in df.columns})
