"""Delimited registries: delimiter choice and an all-string scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CANDIDATES = ("\t", ",", "|", ";")
HEAD_BYTES = 4096


def choose_delimiter(head: str) -> str:
    """The candidate that occurs most often in the first line outside quotes; the earlier of the list on a tie."""
    line = head.lstrip("﻿").splitlines()[0] if head.strip("﻿\r\n") else ""
    outside = "".join(part for i, part in enumerate(line.split('"')) if i % 2 == 0)
    counts = {c: outside.count(c) for c in CANDIDATES}
    best = max(counts, key=lambda c: counts[c])
    return best if counts[best] else "\t"


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """Delimiter of a file, or of the first file of a folder, read from its head only."""
    first = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").orderBy("path").first()
    if first is None:
        raise FileNotFoundError(path)
    lines = spark.read.text(first["path"]).limit(1).collect()
    return choose_delimiter(lines[0]["value"][:HEAD_BYTES] if lines else "")


def read_delimited(spark: SparkSession, path: str, sep: str | None = None, mode: str = "PERMISSIVE", multi_line: bool = False) -> DataFrame:
    """All columns as text, with ``_ord``, the order of rows in the file.

    A doubled quote inside a quoted field is a quote; empty fields stay '', short
    rows are filled with null.  ``mode`` is Spark's for malformed rows.
    Large files are read in splits; fields that hold line breaks need
    ``multi_line``, which makes each file one task.
    """
    rows = spark.read.csv(
        path, sep=sep or sniff_delimiter(spark, path), header=True, inferSchema=False, quote='"', escape='"', multiLine=multi_line,
        mode=mode, emptyValue="", nullValue="\u0000", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return rows.withColumn("_ord", F.monotonically_increasing_id())
