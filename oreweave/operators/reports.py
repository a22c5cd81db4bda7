"""Mentions of deposits in report chunks: parsing, clustering per document, confidence."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreweave.functions.commodity import fused_names
from oreweave.functions.constants import SITE_SIMILARITY, WEIGHT_COMMODITIES, WEIGHT_COORDINATES, WEIGHT_NAME, WEIGHT_REPEATED
from oreweave.functions.geo import in_range
from oreweave.functions.helpers import let
from oreweave.functions.text import optional_text, site_key
from oreweave.operators.fusion import probe_keys, segment_keys
from oreweave.operators.registry import RESPONSE

_ITEM = "struct<site_name:string,latitude:double,longitude:double,commodities:array<string>,grade:double,tonnage:double>"


def parse_response(response: Column) -> Column:
    """Array of deposits of a JSON response; an object with a list or a bare list, anything else gives []."""
    inner = F.from_json(response, RESPONSE.replace(" ", " "))
    bare = F.from_json(response, f"array<{_ITEM}>")
    empty = F.array().cast(f"array<{_ITEM}>")
    as_list = F.filter(F.coalesce(bare, empty), lambda d: d.isNotNull())
    as_object = F.filter(F.coalesce(inner["deposits"], empty), lambda d: d.isNotNull())
    return let(F.ltrim(response), lambda r: F.coalesce(F.when(r.startswith("["), as_list), F.when(r.startswith("{"), as_object), empty))


def explode_mentions(responses: DataFrame, doc: str = "doc_id", chunk: str = "chunk_no", response: str = "response") -> DataFrame:
    """(doc, chunk, item, deposit fields): one row per extracted deposit, in order."""
    return responses.select(doc, chunk, F.posexplode(parse_response(F.col(response))).alias("item", "deposit")).select(
        doc, chunk, "item", "deposit.*"
    )


def confidence(appearances: Column) -> Column:
    """Weights of valid coordinates, commodities, a name and repetition, rounded to 2, at most 1."""
    part = lambda c, w: F.when(c, F.lit(w)).otherwise(0.0)
    score = (
        part(in_range(F.col("latitude"), F.col("longitude")), WEIGHT_COORDINATES)
        + part(F.coalesce(F.size("commodities") > 0, F.lit(False)), WEIGHT_COMMODITIES)
        + part(optional_text(F.col("site_name")).isNotNull(), WEIGHT_NAME)
        + part(appearances > 1, WEIGHT_REPEATED)
    )
    return F.least(F.round(score, 2), F.lit(1.0))


def merge_mentions(mentions: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, cluster, record fields, appearances, confidence_score): mentions of one site merged, per document.

    Mentions are taken in chunk and item order; one joins the first record so far
    with an equal key or a similarity of SITE_SIMILARITY (incoming against
    existing), and the record keeps its first numbers, all commodities and the
    longer name.  Records are found by segments of their keys, one of which a
    similar key keeps.  Nameless mentions are left out.  The order matters, so a
    document is one sequence; a document streams through its sorted partition and
    only its records so far are held, not its mentions.
    """
    clean = mentions.where(optional_text(F.col("site_name")).isNotNull()).select(
        F.col(doc).alias("doc"), F.col("chunk_no").alias("chunk"), "item", optional_text(F.col("site_name")).alias("site_name"),
        site_key(F.col("site_name")).alias("key"), "latitude", "longitude", fused_names(F.col("commodities")).alias("commodities"), "grade", "tonnage",
    )
    numbers = ("latitude", "longitude", "grade", "tonnage")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        @lru_cache(maxsize=1 << 16)
        def alike(new: str, old: str) -> bool:
            return new == old or SequenceMatcher(None, new, old).ratio() >= SITE_SIMILARITY

        def done(doc: Any, records: list[dict]) -> pd.DataFrame:
            return pd.DataFrame(
                [(doc, i, r["site_name"], r["latitude"], r["longitude"], r["commodities"], r["grade"], r["tonnage"], r["n"]) for i, r in enumerate(records)],
                columns=["doc", "cluster", "site_name", "latitude", "longitude", "commodities", "grade", "tonnage", "appearances"],
            )

        current: Any = None
        records: list[dict] = []
        # segments of the records' keys -> places of the records; a similar key has one of them
        shared: dict[str, list[int]] = {}
        signs = lru_cache(maxsize=1 << 14)(lambda k: segment_keys(k, SITE_SIMILARITY) if k else [""])
        probes = lru_cache(maxsize=1 << 14)(lambda k: probe_keys(k, SITE_SIMILARITY) if k else [""])

        def home_of(key: str) -> dict | None:
            places = sorted({i for s in probes(key) for i in shared.get(s, ())})
            return next((records[i] for i in places if alike(key, records[i]["key"])), None)

        def known(place: int) -> None:
            for s in signs(records[place]["key"]):
                shared.setdefault(s, []).append(place)

        for b in batches:
            for row in b.to_dict("records"):
                if row["doc"] != current:
                    if records:
                        yield done(current, records)
                    current, records, shared = row["doc"], [], {}
                value = {c: None if pd.isna(row[c]) else row[c] for c in numbers}
                names = [] if row["commodities"] is None else list(row["commodities"])
                home = home_of(row["key"])
                if home is None:
                    records.append({"site_name": row["site_name"], "key": row["key"], "commodities": names, "n": 1, "place": len(records), **value})
                    known(len(records) - 1)
                    continue
                home["n"] += 1
                for c in numbers:
                    if home[c] is None:
                        home[c] = value[c]
                home["commodities"] = list(dict.fromkeys([*home["commodities"], *names]))
                if len(row["site_name"]) > len(home["site_name"]):
                    home["site_name"], home["key"] = row["site_name"], row["key"]
                    known(home["place"])
        if records:
            yield done(current, records)

    kind = mentions.schema[doc].dataType.simpleString()
    merged = (
        clean.repartition("doc").sortWithinPartitions("doc", "chunk", "item")
        .mapInPandas(
            fold,
            f"doc {kind}, cluster int, site_name string, latitude double, longitude double, commodities array<string>, grade double, tonnage double, appearances int",
        )
    )
    return merged.withColumn("confidence_score", confidence(F.col("appearances"))).withColumnRenamed("doc", doc)
