"""Registry rows and report records in fixed schemas; validity and constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreweave.functions.commodity import clean_list, commodity_at, commodity_codes, commodity_names, fused_names
from oreweave.functions.constants import REGISTRY_ALIASES
from oreweave.functions.geo import in_range
from oreweave.functions.text import clean_header, clean_scalar, coerce_double, optional_text, report_record_id

UNIFIED = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("site_name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("commodities", T.ArrayType(T.StringType())),
        T.StructField("source", T.StringType()),
        T.StructField("confidence_score", T.DoubleType()),
        T.StructField("grade", T.DoubleType()),
        T.StructField("tonnage", T.DoubleType()),
        T.StructField("source_url", T.StringType()),
    ]
)
RESPONSE = "deposits array<struct<site_name:string,latitude:double,longitude:double,commodities:array<string>,grade:double,tonnage:double>>"


def first_alias(df: DataFrame, aliases: tuple[str, ...]) -> Column:
    """The first alias that exists as a column, whatever it holds; a null column if none does."""
    return next((F.col(f"`{a}`") for a in aliases if a in df.columns), F.lit(None).cast("string"))


def any_case_alias(df: DataFrame, aliases: tuple[str, ...]) -> Column:
    """As first_alias, but each alias also matches a column in another case."""
    for a in aliases:
        if a in df.columns:
            return F.col(f"`{a}`")
        same = [c for c in df.columns if c.lower() == a.lower()]
        if same:
            return F.col(f"`{same[0]}`")
    return F.lit(None).cast("string")


def normalize_registry(raw: DataFrame, keep_order: str | None = None) -> DataFrame:
    """Typed registry rows of a frame of strings, valid or not.

    Header names are cleaned and looked up by alias; ``keep_order`` names a
    column of ``raw`` that is kept as ``_ord``.  Empty frames give the schema.
    """
    order = [F.col(f"`{keep_order}`").alias("_ord")] if keep_order else []
    renamed = raw.select(*order, *[F.col(f"`{c}`").alias(clean_header(c)) for c in raw.columns]) if keep_order else raw.toDF(
        *[clean_header(c) for c in raw.columns]
    )
    pick = {f: first_alias(renamed, a) for f, a in REGISTRY_ALIASES.items()}
    text = clean_scalar(pick["commodity_text"])

    def own(field: str, place: int) -> Column:
        present = any(a in renamed.columns for a in REGISTRY_ALIASES[field])
        return clean_scalar(pick[field]) if present else commodity_at(text, place)

    return renamed.select(
        *(["_ord"] if keep_order else []),
        *[clean_scalar(pick[f]).alias(f) for f in ("record_id", "site_name", "development_status", "source_url")],
        *[coerce_double(pick[f]).alias(f) for f in ("latitude", "longitude", "tonnage", "grade")],
        own("commod1", 0).alias("commod1"),
        own("commod2", 1).alias("commod2"),
        commodity_codes(text).alias("commodity_codes"),
        commodity_names(text).alias("commodities"),
    )


def drop_reason(df: DataFrame) -> Column:
    """Why a registry row is invalid: no_id, no_coordinates or out_of_range; null if it is valid."""
    return (
        F.when(df.record_id.isNull(), "no_id")
        .when(df.latitude.isNull() | df.longitude.isNull(), "no_coordinates")
        .when(~in_range(df.latitude, df.longitude), "out_of_range")
    )


def valid_registry(df: DataFrame) -> DataFrame:
    return df.where(F.col("record_id").isNotNull() & in_range(F.col("latitude"), F.col("longitude")))


def dropped_counts(df: DataFrame) -> DataFrame:
    """(reason, n) of the invalid rows."""
    return df.select(drop_reason(df).alias("reason")).where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


def enforce_schema(df: DataFrame, *extra: str) -> DataFrame:
    """The unified columns in order, absent ones null; numbers coerced, confidence 0 if unknown, names fused."""

    def column(field: T.StructField) -> Column:
        if field.name not in df.columns:
            value = F.lit(None).cast(field.dataType)
        elif isinstance(field.dataType, T.DoubleType):
            value = coerce_double(F.col(field.name))
        elif isinstance(field.dataType, T.ArrayType):
            value = fused_names(F.col(field.name))
        else:
            value = F.col(field.name).cast("string")
        if field.name == "confidence_score":
            value = F.coalesce(value, F.lit(0.0))
        if isinstance(field.dataType, T.ArrayType):
            value = F.coalesce(value, F.array().cast(field.dataType))
        return value.alias(field.name)

    return df.select(*extra, *[column(f) for f in UNIFIED])


def registry_to_unified(df: DataFrame, *extra: str) -> DataFrame:
    return enforce_schema(df.withColumns({"source": F.lit("mrds"), "confidence_score": F.lit(1.0)}), *extra)


def reports_to_unified(df: DataFrame, *extra: str) -> DataFrame:
    return enforce_schema(df.withColumn("source", F.lit("pdf")), *extra)


def empty_unified(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], UNIFIED)


def prepare_report_records(df: DataFrame, path: Column) -> DataFrame:
    """Typed report records with an id made of path and name, and the first two commodities."""
    name = optional_text(F.col("site_name"))
    names = fused_names(F.col("commodities"))
    return df.withColumns(
        {
            "record_id": report_record_id(name, path),
            "site_name": name,
            "commodities": names,
            "commod1": F.get(names, F.lit(0)),
            "commod2": F.get(names, F.lit(1)),
            **{c: coerce_double(F.col(c)) for c in ("latitude", "longitude", "grade", "tonnage", "confidence_score")},
            "source_url": path,
        }
    )


def constraints(df: DataFrame) -> Column:
    """Whether a record keeps the model's bounds; NaN keeps none."""
    bounded = lambda c, lo, hi: F.col(c).isNull() | F.col(c).between(lo, hi)
    return F.coalesce(
        (F.length("record_id") >= 1)
        & bounded("latitude", -90, 90)
        & bounded("longitude", -180, 180)
        & (F.col("tonnage").isNull() | ((F.col("tonnage") >= 0) & ~F.isnan("tonnage")))
        & bounded("confidence_score", 0, 1),
        F.lit(False),
    )


def model_record(df: DataFrame) -> DataFrame:
    """Text fields blank to null, name lists lower-case, code lists upper-case, each entry once."""
    texts = [c for c in ("site_name", "development_status", "commod1", "commod2", "source_url") if c in df.columns]
    out = {c: optional_text(F.col(c)) for c in texts}
    out |= {c: clean_list(F.col(c)) for c in ("commodities",) if c in df.columns}
    out |= {c: clean_list(F.col(c), upper=True) for c in ("commodity_codes",) if c in df.columns}
    return df.withColumns(out)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records within bounds, rejected records)."""
    ok = constraints(df)
    return df.where(ok), df.where(~ok)


def assert_valid(df: DataFrame) -> DataFrame:
    """The frame itself; raises if any record is out of bounds."""
    bad = df.where(~constraints(df)).limit(1).collect()
    if bad:
        raise ValueError(f"a record breaks the model's bounds: {bad[0]['record_id']!r}")
    return df
