"""Matching registry and report records one to one, merging, uniting and deduplicating them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher
from functools import lru_cache, reduce
from itertools import combinations
from math import ceil, comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreweave.functions.bitmaps import bits_for, has, key_bitmap
from oreweave.functions.commodity import fused_names
from oreweave.functions.constants import COORDINATE_DIGITS, DISTANCE_BONUS_KM, DISTANCE_THRESHOLD_KM, NAME_THRESHOLD
from oreweave.functions.geo import distance_km, in_range
from oreweave.functions.text import first_present, join_distinct, site_key
from oreweave.functions.udfs import key_similarity
from oreweave.operators.nearest import FREE, SCORE_DIGITS, best_near
from oreweave.operators.proximity import circles, locate
from oreweave.operators.registry import UNIFIED
from oreweave.session import cut_lineage

#: Pairs that one task serves in order.
SERVED_AT_ONCE = 2_000_000
#: Rows in a report's first list, and how much longer each next one is.
WANTED, LONGER = 1, 4


def _side(df: DataFrame, p: str) -> DataFrame:
    return df.select(
        F.col("_ord").alias(f"{p}_ord"), site_key(F.col("site_name")).alias(f"{p}_key"), F.col("latitude").alias(f"{p}_lat"), F.col("longitude").alias(f"{p}_lon")
    )


def _named(side: DataFrame, p: str) -> DataFrame:
    """A side as a frame of records again; a site key is its own key."""
    return side.select(F.col(f"{p}_ord").alias("_ord"), F.col(f"{p}_key").alias("site_name"), F.col(f"{p}_lat").alias("latitude"), F.col(f"{p}_lon").alias("longitude"))


def _km() -> Column:
    return distance_km(F.col("m_lat"), F.col("m_lon"), F.col("p_lat"), F.col("p_lon"))


def distance_counts(registry: DataFrame, reports: DataFrame, km: float) -> DataFrame:
    """(p_ord, n, first_m): the number of rows within ``km`` of each report that has any, and the first of them."""
    circle = circles(reports.select("_ord", "latitude", "longitude"), "report", km, "_ord")
    counted = locate(registry.select("_ord", "latitude", "longitude"), circle, "_ord", tally=True)
    return counted.select(F.col("place_id").alias("p_ord"), "n", F.col("least").alias("first_m"))


def segments(length: int, r: float) -> list[tuple[int, int]]:
    """(start, size) of the pieces of a key of which any key of similarity r keeps one whole.

    Similarity r leaves at most (1 - r)(a + b) characters unmatched, each of which
    spoils one piece, so one piece more than that survives.
    """
    longest = int(length * (2 - r) / r + 1e-9)
    count = min(length, int((1 - r) * (length + longest) + 1e-9) + 1)
    edges = [length * i // count for i in range(count + 1)]
    return [(x, y - x) for x, y in zip(edges, edges[1:])]


def segment_keys(key: str, r: float) -> list[str]:
    return [f"{len(key)}:{i}:{key[x : x + size]}" for i, (x, size) in enumerate(segments(len(key), r))]


def probe_keys(key: str, r: float) -> list[str]:
    """Every segment key that a key of similarity r can have, from the substrings in its reach."""
    m = len(key)
    out = set()
    for n in range(max(1, int(m * r / (2 - r))), int(m * (2 - r) / r + 1e-9) + 1):
        free = int((1 - r) * (n + m) + 1e-9)
        if abs(n - m) > free:
            continue
        for i, (x, size) in enumerate(segments(n, r)):
            for at in range(max(0, x - (free + n - m) // 2), min(m - size, x + (free + m - n) // 2) + 1):
                out.add(f"{n}:{i}:{key[at : at + size]}")
    return sorted(out)


#: Characters of site keys, frequent ones first; they are dealt to groups in turn.
LETTERS = "eoritaulnskdphmgfbcwzvjqyx0123456789"
#: Groups that no unmatched character touches, at least.
SPARED = 2
#: The greatest length that letter bits tell.
LONG = 63
_CODES = np.zeros(128, dtype="u1")
_CODES[np.frombuffer(LETTERS.encode(), "u1")] = np.arange(len(LETTERS))
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(maxsize=1 << 12)
def budgets(length: int, r: float) -> tuple[int, ...]:
    """The numbers of characters that a key of the length and a key of similarity r can leave unmatched, both together."""
    out = set()
    for other in range(max(1, int(length * r / (2 - r))), int(length * (2 - r) / r + 1e-9) + 1):
        free = length + other - 2 * ceil(r * (length + other) / 2 - 1e-9)
        if free >= abs(length - other):
            out.add(free)
    return tuple(sorted(out))


@lru_cache(maxsize=256)
def _chosen(budget: int) -> np.ndarray:
    """(choice, letter) -> whether the choice of SPARED out of budget + SPARED groups holds the letter."""
    count = budget + SPARED
    turn = np.arange(len(LETTERS)) % (2 * count)
    group = np.minimum(turn, 2 * count - 1 - turn)
    return np.array([np.isin(group, c) for c in combinations(range(count), SPARED)])


def group_signs(keys: Sequence[str], r: float, signed: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(places of keys, their letter bits, signs of shape (choice, place), budget) by length and budget.

    A character that is not matched lies in one group of letters, so of budget +
    SPARED groups at least SPARED are whole, and what the keys keep of these
    letters is equal, order included: two similar keys share a sign of their budget.
    The letter bits of two keys differ in no more places than characters are unmatched;
    their six lowest bits are the length, LONG if it is more.
    """
    lengths = np.array([len(k) for k in keys])
    for n in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == n)
        code = _CODES[np.frombuffer("".join(keys[i] for i in at).encode(), "u1").reshape(len(at), n)]
        before = np.stack([(code[:, :c] == code[:, c : c + 1]).sum(axis=1) for c in range(n)], axis=1).astype("u8")
        with np.errstate(over="ignore"):
            bit = (((code.astype("u8") + np.uint64(1)) * _MIX + before * _ODD) * _ODD >> np.uint64(32)) % np.uint64(58)
            bits = (np.bitwise_or.reduce(np.uint64(64) << bit, axis=1) | np.uint64(min(n, LONG))).view("i8")
            for budget in budgets(int(n), r) if signed else (0,):
                chosen = _chosen(budget)
                h = np.repeat((np.arange(len(chosen), dtype="u8") + np.uint64(1 + (budget << 20))) * _MIX, len(at)).reshape(len(chosen), len(at))
                for c in range(n if signed else 0):
                    h = np.where(chosen[:, code[:, c]], (h ^ (h >> np.uint64(32))) * _ODD + code[:, c] + np.uint64(1), h)
                yield at, bits, ((h ^ (h >> np.uint64(29))) * _MIX >> np.uint64(1)).astype("i8"), budget


def name_candidates(registry: DataFrame, reports: DataFrame, threshold: float) -> DataFrame:
    """(m_ord, p_ord) of the pairs of rows whose site keys have a similarity of at least ``threshold``."""
    return _alike(registry, reports, threshold).select("m_ord", "p_ord")


def _alike(registry: DataFrame, reports: DataFrame, threshold: float) -> DataFrame:
    """Both sides of the pairs of rows whose site keys have a similarity of at least ``threshold``.

    Distinct keys meet by a sign of group_signs (no similar pair is lost); their
    letter bits and then the common letters bound the similarity from above, and
    only pairs within that bound are compared.  A bitmap of the reports' signs
    drops those of the registry that meet none.
    """
    r = threshold / 100
    if not 0.5 <= r <= 1:
        raise ValueError("the name threshold must be from 50 to 100")
    keys = lambda df, p: _side(df, p).where(F.col(f"{p}_key") != "").select(F.col(f"{p}_key").alias("key")).distinct()
    known, asked = keys(registry, "m"), cut_lineage(keys(reports, "p"))
    sizes = asked.groupBy(F.length("key").alias("n")).count().collect()  # as many rows as there are lengths
    signs = sum(x["count"] * sum(comb(d + SPARED, SPARED) for d in budgets(x["n"], r)) for x in sizes)

    def sign_reports(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            key = b["key"].to_numpy()
            for at, bits, sign, budget in group_signs(key, r):
                many = len(sign)
                yield pd.DataFrame({"key": sign.ravel(), "p_bits": np.tile(bits, many), "budget": budget, "p_key": np.tile(key[at], many)})

    waiting = asked.mapInPandas(sign_reports, "key long, p_bits long, budget int, p_key string")
    shipped = asked.sparkSession.sparkContext.broadcast(key_bitmap(waiting, bits_for(signs)))

    def sign_registry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, bits, sign, _ in group_signs(b["key"].to_numpy(), r):
                waits = has(shipped.value, sign.ravel())
                yield pd.DataFrame({"key": sign.ravel()[waits], "m_bits": np.tile(bits, len(sign))[waits]})

    def letter_bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at, bits, _, _ in group_signs(b["key"].to_numpy(), r, signed=False):
                yield pd.DataFrame({"m_bits": bits, "m_key": b["key"].to_numpy()[at]})

    # signs are many more than the keys they are made of, which Spark's size estimate does not see: never broadcast them
    met = known.mapInPandas(sign_registry, "key long, m_bits long").hint("merge").join(waiting, "key")
    m_length = F.col("m_bits").bitwiseAND(F.lit(LONG))
    total = m_length + F.length("p_key")
    apart = F.bit_count(F.col("m_bits").bitwiseXOR(F.col("p_bits")).bitwiseAND(F.lit(~LONG)))
    of_budget = (m_length == LONG) | (total - 2 * F.ceil(F.lit(r) * total / 2 - 1e-9) == F.col("budget"))
    # partitioned for both the distinct and the join
    met = met.where((apart <= F.col("budget")) & of_budget).select("m_bits", "p_key").repartition("m_bits").distinct()
    pairs = met.hint("merge").join(known.mapInPandas(letter_bits, "m_bits long, m_key string"), "m_bits").select("m_key", "p_key")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            every, place = np.unique(b.to_numpy().ravel(), return_inverse=True)
            size = np.array([len(k) for k in every])
            held = np.repeat(np.arange(len(every)) * 128, size) + np.frombuffer("".join(every).encode(), "u1")
            letters = np.bincount(held, minlength=128 * len(every)).reshape(-1, 128)[:, 48:123]
            left, right = place.reshape(-1, 2).T
            bound = 2 * np.minimum(letters[left], letters[right]).sum(axis=1) + 1e-9 >= r * (size[left] + size[right])
            near = b[bound]
            alike = [100.0 * SequenceMatcher(None, x, y).ratio() >= threshold for x, y in zip(near["m_key"], near["p_key"])]
            yield near[np.array(alike, dtype=bool)]

    alike = pairs.mapInPandas(compare, "m_key string, p_key string")
    # the registry is larger than its estimate, so it is never broadcast
    return alike.hint("merge").join(_side(registry, "m"), "m_key").hint("merge").join(_side(reports, "p"), "p_key")


def _scored(pairs: DataFrame) -> DataFrame:
    """(m_ord, p_ord, name_score, km, score) of pairs with both sides.

    A distance of exactly 0 earns no bonus, as an unknown one; the bonus spans
    DISTANCE_BONUS_KM whatever the threshold.
    """
    scored = pairs.withColumn("km", _km()).withColumn("name_score", key_similarity(F.col("m_key"), F.col("p_key")))
    near_by = F.when(F.col("km") > 0, F.least("km", F.lit(DISTANCE_BONUS_KM))).otherwise(F.lit(DISTANCE_BONUS_KM))
    score = F.col("name_score") + DISTANCE_BONUS_KM - F.coalesce(near_by, F.lit(DISTANCE_BONUS_KM))
    return scored.select("m_ord", "p_ord", "name_score", "km", F.round(score, SCORE_DIGITS).alias("score"))


def _serve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs in order of report, score and row: the first free row of each report."""
    taken: set[int] = set()
    last = None
    for b in batches:
        keep = []
        for i, (m, p) in enumerate(zip(b["m_ord"], b["p_ord"])):
            if p != last and m not in taken:
                keep.append(i)
                taken.add(m)
                last = p
        yield b.iloc[keep]


def assign_one_to_one(candidates: DataFrame, at_once: int = SERVED_AT_ONCE) -> DataFrame:
    """The pairs that serving reports in order, best score first, earliest row on ties, would choose.

    As long as more than ``at_once`` pairs are left, all certain pairs are taken
    in parallel: a report's best remaining row is certain once no earlier report
    wants that row at all; taken rows and reports leave.  What is left then, such
    as long chains of reports that want each other's rows, is served in order by
    one task, which holds no more than the rows taken.  The candidates are read
    again and again, so a caller cuts their lineage.
    """
    left = candidates
    chosen = []
    while left.count() > at_once:
        best = Window.partitionBy("p_ord").orderBy(F.desc("score"), "m_ord")
        first = left.groupBy("m_ord").agg(F.min("p_ord").alias("first_p"))
        sure = cut_lineage(
            left.withColumn("place", F.row_number().over(best)).where("place = 1").join(first, "m_ord").where("p_ord = first_p").drop("place", "first_p")
        )
        chosen.append(sure)
        left = cut_lineage(left.join(sure.select("p_ord"), "p_ord", "left_anti").join(sure.select("m_ord"), "m_ord", "left_anti"))
    served = left.coalesce(1).sortWithinPartitions("p_ord", F.desc("score"), "m_ord").mapInPandas(_serve, left.schema)
    return reduce(DataFrame.unionByName, chosen, served)


def match_records(
    registry: DataFrame,
    reports: DataFrame,
    name_threshold: float = NAME_THRESHOLD,
    distance_threshold_km: float = DISTANCE_THRESHOLD_KM,
    wanted: int = WANTED,
) -> DataFrame:
    """(m_ord, p_ord, name_score, distance_km): the one-to-one pairs; both frames carry a unique ``_ord``.

    A report takes one row, so lists of each report's ``wanted`` best rows are
    served, not all pairs alike by name or near by distance.  A row only ever
    passes to an earlier report, so a report that lost all rows of its list needs
    only rows that no earlier report holds: it gets a longer list of these, until
    every report holds a row or has no more.  The outcome is that of the whole
    lists, since a row that refused a report never frees itself for it.

    The driver's memory goes with the number of plans and exchanges, not with the
    rows, so names are searched once, for all reports, and a round has three plans.
    """
    rows, asked = cut_lineage(_side(registry, "m")), cut_lineage(_side(reports, "p"))
    by_name = cut_lineage(_scored(_alike(_named(rows, "m"), _named(asked, "p"), name_threshold)))
    best = Window.partitionBy("p_ord").orderBy(F.desc("score"), "m_ord")
    of = Window.partitionBy("p_ord")
    waiting, taken, named, lists = asked, rows.withColumn("holder", F.lit(FREE)), by_name, None
    while True:
        near = best_near(taken, waiting, wanted, distance_threshold_km)
        # partitioned for both the duplicates and the windows
        both = near.unionByName(named).repartition("p_ord").dropDuplicates(["p_ord", "m_ord"])
        listed = both.withColumn("place", F.row_number().over(best)).where(F.col("place") <= wanted)
        # a list that is not full has all rows
        listed = listed.withColumn("full", F.max("place").over(of) == wanted).drop("place")
        lists = cut_lineage(listed if lists is None else lists.join(waiting.select("p_ord"), "p_ord", "left_anti").unionByName(listed))
        pairs = cut_lineage(assign_one_to_one(lists))
        ends = lists.select("p_ord", "full", F.lit(False).alias("got")).unionByName(pairs.select("p_ord", "full", F.lit(True).alias("got")))
        lost = ends.groupBy("p_ord").agg(F.bool_or("full").alias("full"), F.bool_or("got").alias("got")).where("full AND NOT got")
        waiting = cut_lineage(asked.join(lost, "p_ord", "left_semi"))
        many = waiting.count()
        if not many:
            return pairs.select("m_ord", "p_ord", F.round("name_score", 2).alias("name_score"), F.round("km", 3).alias("distance_km"))
        held = pairs.select("m_ord", F.col("p_ord").alias("holder"))
        taken = rows.join(held, "m_ord", "left").withColumn("holder", F.coalesce("holder", F.lit(FREE)))
        named = by_name.join(waiting.select("p_ord"), "p_ord", "left_semi").join(held, "m_ord", "left").where("holder IS NULL OR p_ord < holder").drop("holder")
        wanted = max(wanted, min(LONGER * wanted, SERVED_AT_ONCE // many))


def unmatched(df: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
    """Rows of the registry (side m) or the reports (side p) in no pair."""
    return df.join(pairs.select(F.col(f"{side}_ord").alias("_ord")), "_ord", "left_anti")


def merge_pairs(registry: DataFrame, reports: DataFrame, pairs: DataFrame) -> DataFrame:
    """One record per pair: identity and position of the registry first, grade and tonnage of the report first."""
    m = registry.select(F.struct(*UNIFIED.names).alias("m"), F.col("_ord").alias("m_ord"))
    p = reports.select(F.struct(*UNIFIED.names).alias("p"), F.col("_ord").alias("p_ord"))
    text = lambda c: F.coalesce(F.nullif(F.col(f"m.{c}"), F.lit("")), F.col(f"p.{c}"))
    both = pairs.join(m, "m_ord").join(p, "p_ord")
    return both.select(
        F.col("p_ord").alias("_ord"),
        text("record_id").alias("record_id"),
        text("site_name").alias("site_name"),
        F.coalesce("m.latitude", "p.latitude").alias("latitude"),
        F.coalesce("m.longitude", "p.longitude").alias("longitude"),
        fused_names(F.concat(F.coalesce("m.commodities", F.array()), F.coalesce("p.commodities", F.array()))).alias("commodities"),
        F.lit("mrds+pdf").alias("source"),
        F.greatest(F.coalesce("m.confidence_score", F.lit(0.0)), F.coalesce("p.confidence_score", F.lit(0.0))).alias("confidence_score"),
        first_present(F.col("p.grade"), F.col("m.grade")).alias("grade"),
        first_present(F.col("p.tonnage"), F.col("m.tonnage")).alias("tonnage"),
        join_distinct(F.col("m.source_url"), F.col("p.source_url")).alias("source_url"),
    )


def dedupe(df: DataFrame, *order: str) -> DataFrame:
    """One row per site key and position rounded to 4 digits: first by source, then by confidence, then by ``order``.

    Rows without name and position share one key.  A hot key is reduced on the
    map side by the min-aggregate, so it never meets in one task whole.
    """
    placed = in_range(F.col("latitude"), F.col("longitude"))
    rounded = lambda c: F.when(placed, F.round(c, COORDINATE_DIGITS) + 0.0)
    keyed = df.withColumns({"_site": site_key(F.col("site_name")), "_lat": rounded("latitude"), "_lon": rounded("longitude")})
    place = F.struct(F.col("source"), -F.col("confidence_score"), *[F.col(c) for c in order])
    best = keyed.groupBy("_site", "_lat", "_lon").agg(F.min_by(F.struct(*df.columns), place).alias("best"))
    return best.select("best.*")


def build_unified(registry: DataFrame, reports: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(unified records, parts): matched pairs merged, residuals appended, duplicates dropped.

    Both inputs have the unified columns and ``_ord``.
    """
    pairs = match_records(registry, reports)  # of a checkpoint
    merged = merge_pairs(registry, reports, pairs).withColumn("_part", F.lit(0))
    rest_m = unmatched(registry, pairs, "m").withColumn("_part", F.lit(1))
    rest_p = unmatched(reports, pairs, "p").withColumn("_part", F.lit(2))
    together = merged.unionByName(rest_m.select(merged.columns)).unionByName(rest_p.select(merged.columns))
    unified = dedupe(together, "_part", "_ord")
    return unified.select(*UNIFIED.names), {"pairs": pairs, "together": together, "registry": registry, "reports": reports}


def match_counts(unified: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """One row with the eight counters of a fusion.

    Pairs are one to one, so the numbers of rows left over are differences, and the
    records are put together only once, for the number that is left of them.
    """
    part = lambda df, name: df.select(F.lit(name).alias("part"))
    every = part(parts["pairs"], "pairs").unionByName(part(parts["registry"], "registry")).unionByName(part(parts["reports"], "reports")).unionByName(part(unified, "unified"))
    count = lambda name: F.count_if(F.col("part") == name)
    row = every.agg(
        count("pairs").alias("matched"), count("registry").alias("input_mrds"), count("reports").alias("input_pdf"),
        (count("registry") - count("pairs")).alias("unmatched_mrds_pre_dedupe"),
        (count("reports") - count("pairs")).alias("unmatched_pdf_pre_dedupe"),
        (count("registry") + count("reports") - count("pairs")).alias("pre_dedupe_total"), count("unified").alias("total"),
    )
    return row.withColumn("deduped_records", F.col("pre_dedupe_total") - F.col("total"))
