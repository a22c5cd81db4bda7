"""Incremental ingestion of a landing folder of registry files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreweave.operators.registry import normalize_registry, valid_registry


def stream_registry(spark: SparkSession, folder: str, columns: list[str], sep: str = "\t") -> DataFrame:
    """Valid registry rows of the files that arrive in a folder; all columns are read as text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.readStream.schema(schema).csv(folder, sep=sep, header=True, quote='"', escape='"')
    return valid_registry(normalize_registry(raw))


def ingest_available(rows: DataFrame, target: str, checkpoint: str) -> None:
    """Appends all rows that are there, once each; rows whose record_id was written before are left out.

    A batch that is retried after a loss overwrites its own folder, so nothing is doubled.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.groupBy("record_id").agg(F.min_by(F.struct(*batch.columns), F.struct("site_name", "latitude", "longitude")).alias("r")).select("r.*")
        try:
            before = spark.read.parquet(target).where(F.col("batch") < number).select("record_id")
            fresh = fresh.join(before, "record_id", "left_anti")
        except Exception as e:  # nothing written yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        fresh.select(batch.columns).write.mode("overwrite").parquet(f"{target}/batch={number}")

    rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
