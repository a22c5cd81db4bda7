"""Report documents: text of PDF or text files, and deposits extracted from chunks."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreweave.functions.text import clean_report_text
from oreweave.functions.udfs import chunk_text


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): cleaned text of each file, pages joined by line breaks.

    PDF needs PyMuPDF, which is optional; files that do not start as a PDF are
    read as UTF-8 text.  Blank pages and pages that cannot be encoded are skipped.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b["path"], "text": [_text(bytes(c)) for c in b["content"]]})

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return raw.mapInPandas(read, "path string, text string").withColumn("text", clean_report_text(F.col("text")))


def _text(content: bytes) -> str:
    if not content.startswith(b"%PDF"):
        return content.decode("utf-8", "ignore")
    try:
        import fitz
    except ImportError as e:
        raise RuntimeError("reading PDF needs PyMuPDF") from e
    pages = []
    with fitz.open(stream=content, filetype="pdf") as pdf:
        for page in pdf:
            try:
                text = page.get_text("text").encode("utf-8").decode("utf-8")
            except UnicodeError:
                continue
            if text.strip():
                pages.append(text)
    return "\n".join(pages)


def chunk_documents(docs: DataFrame, key: str = "path", text: str = "text", max_tokens: int = 1500) -> DataFrame:
    """(key, chunk_no, chunk)."""
    return docs.select(key, F.posexplode(chunk_text(F.col(text), max_tokens)).alias("chunk_no", "chunk"))


class Extractor(Protocol):
    """Turns one chunk into a JSON response {"deposits": [...]}; must be picklable."""

    def __call__(self, chunk: str) -> str: ...


class RuleExtractor:
    """A small deterministic extractor for tests and dry runs: names before a type word, coordinates after them."""

    _SITE = re.compile(r"((?:[A-Z][\w’']+ ){1,3}(?:Mine|Prospect|District|Deposit|Pit|Lode))")
    _PLACE = re.compile(r"(-?\d{1,2}\.\d+)\s*°?\s*([NS]?)\s*,?\s+(-?\d{1,3}\.\d+)\s*°?\s*([EW]?)")
    _METALS = re.compile(r"\b(gold|silver|copper|lead|zinc|iron|tungsten|niobium)\b", re.IGNORECASE)

    def __call__(self, chunk: str) -> str:
        found = []
        sites = list(self._SITE.finditer(chunk))
        for m, nxt in zip(sites, [*sites[1:], None]):
            after = chunk[m.end() : nxt.start() if nxt else len(chunk)]
            place = self._PLACE.search(after)
            lat = lon = None
            if place:
                lat = float(place[1]) * (-1 if place[2] == "S" else 1)
                lon = float(place[3]) * (-1 if place[4] == "W" else 1)
            metals = list(dict.fromkeys(x.lower() for x in self._METALS.findall(after)))
            found.append({"site_name": m[1].strip(), "latitude": lat, "longitude": lon, "commodities": metals, "grade": None, "tonnage": None})
        return json.dumps({"deposits": found})


def extract_responses(chunks: DataFrame, extractor: Extractor, key: str = "path") -> DataFrame:
    """(key, chunk_no, chunk_id, response): one call per distinct non-blank chunk.

    Calls may be costly and tasks may be retried: write the result to a table
    keyed by chunk_id and anti-join against it before calling again.
    """

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"chunk_id": b["chunk_id"], "response": [extractor(c) if c and c.strip() else "[]" for c in b["chunk"]]})

    keyed = chunks.withColumn("chunk_id", F.sha1("chunk"))
    once = keyed.groupBy("chunk_id").agg(F.first("chunk").alias("chunk")).mapInPandas(call, "chunk_id string, response string")
    return keyed.select(key, "chunk_no", "chunk_id").join(once, "chunk_id").select(key, "chunk_no", "chunk_id", "response")
