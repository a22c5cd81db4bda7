"""The pipelines: registry ingestion, report ingestion, fusion, enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreweave.operators.enrich import spatial_join
from oreweave.operators.fusion import build_unified, match_counts
from oreweave.operators.registry import dropped_counts, normalize_registry, prepare_report_records, registry_to_unified, reports_to_unified, split_valid, valid_registry
from oreweave.operators.reports import explode_mentions, merge_mentions
from oreweave.session import cut_lineage
from oreweave.sources.delimited import read_delimited
from oreweave.sources.documents import Extractor, chunk_documents, extract_responses, read_documents
from oreweave.sources.geoparquet import read_geoparquet, with_points, write_geoparquet
from oreweave.sources.vector import load_geology


def ingest_delimited(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """Valid, typed registry rows of a delimited file, with ``_ord``."""
    return valid_registry(normalize_registry(read_delimited(spark, path, sep), "_ord"))


def ingest_documents(spark: SparkSession, path: str, extractor: Extractor, max_tokens: int = 1500) -> DataFrame:
    """Valid report records, one per site and document."""
    return split_documents(spark, path, extractor, max_tokens)[0]


def split_documents(spark: SparkSession, path: str, extractor: Extractor, max_tokens: int = 1500) -> tuple[DataFrame, DataFrame]:
    """(valid report records, records rejected because they break the model's bounds)."""
    chunks = chunk_documents(read_documents(spark, path), "path", "text", max_tokens)
    mentions = explode_mentions(extract_responses(chunks, extractor), "path")
    prepared = prepare_report_records(merge_mentions(mentions, "path"), F.col("path"))
    return split_valid(prepared)


def ordered(df: DataFrame, *by: str) -> DataFrame:
    """The frame with ``_ord``, unique and ascending with the columns, without one global sort task.

    Written to the checkpoint folder once: another evaluation could cut the
    ranges elsewhere and number the rows anew.
    """
    return cut_lineage(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_ord", F.monotonically_increasing_id()))


def fuse(registry: DataFrame, reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(unified records, one row of counters); the registry carries ``_ord``, reports are put in path and cluster order."""
    if "_ord" not in reports.columns:
        reports = ordered(reports, *[c for c in ("path", "cluster") if c in reports.columns] or ["record_id"])
    unified, parts = build_unified(cut_lineage(registry_to_unified(registry, "_ord")), reports_to_unified(reports, "_ord"))
    return unified, match_counts(unified, parts)


def enrich(deposits: DataFrame, layer: DataFrame) -> DataFrame:
    # the numbers join rows across two evaluations, so they are written once
    keyed = deposits if "_ord" in deposits.columns else cut_lineage(deposits.withColumn("_ord", F.monotonically_increasing_id()))
    return spatial_join(keyed, layer).drop("_ord")


def dropped_rows(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """(reason, n) of the rows of a delimited file that ingestion drops."""
    return dropped_counts(normalize_registry(read_delimited(spark, path, sep)))


def run_ingest(spark: SparkSession, source: str, target: str) -> DataFrame:
    return write_geoparquet(with_points(ingest_delimited(spark, source).drop("_ord")), target)


def run_fusion(spark: SparkSession, csv: str, documents: str, extractor: Extractor, target: str) -> DataFrame:
    unified, counts = fuse(ingest_delimited(spark, csv), ingest_documents(spark, documents, extractor))
    write_geoparquet(with_points(unified), target)
    return counts


def run_enrich(spark: SparkSession, source: str, layer: str, target: str) -> DataFrame:
    return write_geoparquet(enrich(read_geoparquet(spark, source), load_geology(spark, layer)), target)
