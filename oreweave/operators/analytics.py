"""Summaries, facets, previews, map points and quality counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreweave.functions.commodity import commodity_color, commodity_label
from oreweave.functions.constants import MAP_COLUMNS, PREVIEW_COLUMNS, REQUIRED_COLUMNS
from oreweave.functions.geo import in_range
from oreweave.functions.helpers import trim_all
from oreweave.functions.text import site_key


def _has(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def _known(df: DataFrame, name: str) -> Column:
    return F.col(name).isNotNull() if name in df.columns else F.lit(False)


def summary(df: DataFrame) -> DataFrame:
    """total_deposits, matched_geology, matched_percent (2 digits, 0 if empty), rows_with_coordinates."""
    total, matched = F.count("*"), F.count_if(_known(df, "geologic_unit"))
    return df.agg(
        total.alias("total_deposits"),
        matched.alias("matched_geology"),
        F.coalesce(F.round(100 * matched / F.nullif(total, F.lit(0)), 2), F.lit(0.0)).alias("matched_percent"),
        F.count_if(_known(df, "latitude") & _known(df, "longitude")).alias("rows_with_coordinates"),
    )


def source_counts(df: DataFrame) -> DataFrame:
    if not _has(df, "source"):
        return df.select(F.lit(None).cast("string").alias("source"), F.lit(0).cast("long").alias("count")).limit(0)
    return df.groupBy("source").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "source")


def _tokens(df: DataFrame) -> DataFrame:
    return df.select(F.explode("commodities").alias("c")).select(F.lower(trim_all(F.col("c"))).alias("commodity")).where(F.col("commodity") != "")


def commodity_counts(df: DataFrame, limit: int = 15, order: str | None = None) -> DataFrame:
    """Most frequent commodities; ties by first appearance in ``order`` if given, else by name."""
    if not _has(df, "commodities"):
        return df.select(F.lit(None).cast("string").alias("commodity"), F.lit(0).cast("long").alias("count")).limit(0)
    if order is None:
        return _tokens(df).groupBy("commodity").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "commodity").limit(limit)
    placed = df.select(order, F.posexplode("commodities").alias("pos", "c")).select(order, "pos", F.lower(trim_all(F.col("c"))).alias("commodity"))
    counted = placed.where(F.col("commodity") != "").groupBy("commodity").agg(F.count("*").alias("count"), F.min(F.struct(order, "pos")).alias("seen"))
    return counted.orderBy(F.desc("count"), "seen").limit(limit).select("commodity", "count")


def distribution(df: DataFrame, column: str, limit: int = 15) -> DataFrame:
    """Most frequent known values of a column."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count")).orderBy(F.desc("count"), column).limit(limit)


def available_values(df: DataFrame, column: str, limit: int = 200) -> DataFrame:
    """Distinct non-blank values in order."""
    if not _has(df, column):
        return df.select(F.lit(None).cast("string").alias("value")).limit(0)
    text = F.col(column).cast("string")
    return df.select(text.alias("value")).where(trim_all(F.col("value")) != "").distinct().orderBy("value").limit(limit)


def available_commodities(df: DataFrame, limit: int = 200) -> DataFrame:
    return _tokens(df).select(F.col("commodity").alias("value")).distinct().orderBy("value").limit(limit)


def filter_facets(df: DataFrame, commodities: list[str] = (), ages: list[str] = (), lithologies: list[str] = ()) -> DataFrame:
    """Rows with any of the wanted values in each facet; an empty list or an absent column filters nothing."""
    if commodities and _has(df, "commodities"):
        wanted = F.array(*[F.lit(c.lower()) for c in commodities])
        have = F.transform("commodities", lambda x: F.lower(x))
        df = df.where(F.coalesce(F.arrays_overlap(F.filter(have, lambda x: x.isNotNull()), wanted), F.lit(False)))
    for column, values in (("geologic_age", ages), ("lithology", lithologies)):
        if values and _has(df, column):
            df = df.where(F.col(column).isin(*values))
    return df


def preview(df: DataFrame, limit: int = 1000, compact: bool = True, order: str | None = None) -> DataFrame:
    """First rows in ``order``, of the display columns that exist."""
    rows = df.orderBy(order) if order else df
    return (rows.select(*[c for c in PREVIEW_COLUMNS if c in df.columns]) if compact else rows).limit(limit)


def sample_rows(df: DataFrame, n: int, key: str = "record_id", seed: int = 42) -> DataFrame:
    """Exactly n rows (all if there are fewer), chosen by a hash of the key: the same rows on every run."""
    return df.orderBy(F.sha1(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)


def map_points(df: DataFrame, max_points: int, key: str = "record_id") -> DataFrame:
    """Points to draw: known coordinates, at most ``max_points``, with label and colour."""
    if not _has(df, "latitude", "longitude"):
        df = df.withColumns({c: F.lit(None).cast("double") for c in ("latitude", "longitude") if c not in df.columns})
    placed = df.where("latitude is not null and longitude is not null")
    missing = {c: F.lit(None).cast("array<string>" if c == "commodities" else "string") for c in MAP_COLUMNS if c not in df.columns}
    points = sample_rows(placed, max_points, key).withColumns(missing)
    extra = [] if key in MAP_COLUMNS else [key]
    return points.select(
        *extra, *MAP_COLUMNS, commodity_label(F.col("commodities")).alias("commodity_label"), commodity_color(F.col("commodities")).alias("color")
    )


def map_center(points: DataFrame) -> DataFrame:
    return points.agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))


def commodity_examples(df: DataFrame, n: int = 10, order: str = "record_id") -> DataFrame:
    """The first ``n`` commodity lists that are not empty."""
    return df.where(F.size("commodities") > 0).select(order, "commodities").orderBy(order, "commodities").limit(n)


def text_prefix(text: Column, n: int = 1400) -> Column:
    """The first characters of a report text, as shown beside its records."""
    return F.substring(text, 1, n)


def quality_report(df: DataFrame) -> DataFrame:
    """One row of data-quality counts; absent required columns are listed in ``missing_columns``."""
    missing = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    full = df.withColumns(
        {c: F.lit(None).cast("double" if c in ("latitude", "longitude", "confidence_score") else "array<string>" if c == "commodities" else "string") for c in missing}
    )
    both = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    placed = in_range(F.col("latitude"), F.col("longitude"))
    key = lambda c: F.when(placed, F.round(c, 4))
    named = F.coalesce(trim_all(F.col("site_name")) != "", F.lit(False))
    sites = full.groupBy(site_key(F.col("site_name")).alias("k"), key("latitude").alias("a"), key("longitude").alias("o")).count().agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_sites")
    )
    ids = full.groupBy("record_id").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_ids"))
    counts = full.agg(
        F.count("*").alias("rows"),
        F.count_if(both).alias("rows_with_coordinates"),
        F.count_if(F.col("geometry").isNotNull() if "geometry" in df.columns else F.lit(False)).alias("rows_with_geometry"),
        F.count_if(both & ~placed).alias("invalid_coordinates"),
        F.count_if(F.col("commodities").isNotNull()).alias("list_commodities"),
        F.count_if(F.coalesce(F.size("commodities") > 0, F.lit(False))).alias("filled_commodities"),
        F.count_if(~named).alias("missing_names"),
    )
    # one row each
    return counts.crossJoin(sites).crossJoin(ids).withColumn("missing_columns", F.lit(",".join(missing)))
