"""The best rows near each report by name and distance, without the pairs in between.

The rows within a circle grow with the square of a district's size, but a report
takes one row.  So the sweep over latitude strips keeps no pairs: each active
report holds its best rows so far, and rows that cannot beat the last of them
are dropped by distance and length, then by the longest common subsequence of
the names (which bounds their similarity from above), before names are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher
from heapq import heappush, heapreplace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreweave.functions.constants import DISTANCE_BONUS_KM
from oreweave.functions.geo import EARTH_KM
from oreweave.operators.proximity import circles, in_strips
from oreweave.session import partitions

#: Pairs of a row and a report's interval that are compared at once.
MET = 1 << 16
#: Points of a strip that one task sweeps, at most on average.
CHUNK_ROWS = 50_000
#: Holder of a row that no report holds.
FREE = (1 << 63) - 1
#: Digits of a score that count, so that no order rests on rounding noise.
SCORE_DIGITS = 9
#: Letters of a key that one word of bits holds; further ones are taken as equal.
WORD = 64
PAIRS = "m_ord long, p_ord long, name_score double, km double, score double"
_CODES = np.full(256, 36, dtype="u1")
_CODES[np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", "u1")] = np.arange(36)


def _codes(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes of shape (letter, key), padded with 36; lengths) of site keys, of WORD letters at most."""
    size = np.array([len(k) for k in keys], dtype="i4")
    width = max(1, min(WORD, int(size.max(initial=1))))
    raw = np.array([k[:width].encode() for k in keys], dtype=f"S{width}")
    return np.ascontiguousarray(_CODES[raw.view("u1").reshape(len(keys), width)].T), size


def _masks(key: str) -> np.ndarray:
    """Of each code, the places in the key as bits."""
    out = [0] * 37
    for i, c in enumerate(key[:WORD].encode()):
        out[_CODES[c]] |= 1 << i
    out[36] = 0
    return np.array(out, dtype="u8")


def subsequence(codes: np.ndarray, size: np.ndarray, left: np.ndarray, masks: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of the keys ``left`` and ``right``, a bit-parallel step for each letter."""
    shorter = -np.minimum(size[left], len(codes)).astype("i1")
    order = np.argsort(shorter, kind="stable")
    left, base = left[order], right[order].astype("i8") * 37
    many = np.searchsorted(shorter[order], -np.arange(len(codes), dtype="i1"), "left")  # keys that reach each letter
    v = np.full(len(left), ~np.uint64(0))
    flat = masks.ravel()
    for j, n in enumerate(many):
        if n == 0:
            break
        w = v[:n]
        u = w & flat[base[:n] + codes[j][left[:n]]]
        v[:n] = (w + u) | (w - u)
    out = np.empty(len(left), dtype="i4")
    out[order] = WORD - np.bitwise_count(v).astype("i4")
    return out


class _Report:
    """A report that waits in a sweep, with its best rows so far as a heap of (score, -row, name score, km)."""

    __slots__ = ("best", "key", "lat", "lon", "masks", "matcher", "ord", "start", "stop")

    def __init__(self, ord_: int, key: str, start: float, stop: float, lat: float, lon: float):
        self.ord, self.key, self.start, self.stop, self.lat, self.lon = ord_, key, start, stop, lat, lon
        self.best: list[tuple] = []
        self.masks, self.matcher = _masks(key), None

    def similarity(self, key: str) -> float:
        if not key or not self.key:
            return 0.0
        if self.matcher is None:
            self.matcher = SequenceMatcher(None, "", self.key)
        self.matcher.set_seq1(key)
        return 100.0 * self.matcher.ratio()


def _offer(active: list[_Report], points: dict, first: np.ndarray, last: np.ndarray, most: int, radius_km: float) -> None:
    """Shows each report its rows from first to last."""
    count = np.maximum(last - first, 0)
    at = np.repeat(np.arange(len(active)), count)
    x = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + first[at]
    enough = np.array([r.best[0][0] if len(r.best) == most else -1.0 for r in active])
    lat, lon = np.array([r.lat for r in active]), np.array([r.lon for r in active])
    # no row can earn more than the distance along the meridian allows
    north = np.radians(lat[at] - points["lat"][x])
    may = (enough[at] <= 100.0 + DISTANCE_BONUS_KM + 1e-6 - np.minimum(EARTH_KM * np.abs(north), DISTANCE_BONUS_KM)) & (np.array([r.ord for r in active])[at] < points["holder"][x])
    at, x, north = at[may], x[may], north[may]
    a = np.sin(north / 2) ** 2 + points["cos"][x] * np.cos(np.radians(lat))[at] * np.sin(np.radians(lon[at] - points["lon"][x]) / 2) ** 2
    km = 2 * EARTH_KM * np.arcsin(np.sqrt(np.minimum(1.0, a)))
    bonus = np.where(km > 0, DISTANCE_BONUS_KM - np.minimum(km, DISTANCE_BONUS_KM), 0.0)
    m, p = points["size"][x], np.array([len(r.key) for r in active], dtype="i4")[at]
    total = np.maximum(1, m + p)
    may = (km <= radius_km) & (200.0 * np.minimum(m, p) / total + bonus + 1e-6 >= enough[at])
    at, x, km, bonus, m, p, total = (c[may] for c in (at, x, km, bonus, m, p, total))
    if not len(at):
        return
    common = subsequence(points["codes"], points["size"], x, np.stack([r.masks for r in active]), at) + np.maximum(0, m - WORD) + np.maximum(0, p - WORD)
    bound = 200.0 * np.minimum(common, np.minimum(m, p)) / total + bonus + 1e-6
    likely = np.flatnonzero(bound >= enough[at])
    likely = likely[np.lexsort((-bound[likely], at[likely]))]
    at, x, km, bonus, bound = (c[likely] for c in (at, x, km, bonus, bound))
    edges = np.append(np.flatnonzero(np.diff(at, prepend=-1)), len(at))
    keys, ids = points["key"], points["id"]
    for i, j in zip(edges, edges[1:]):
        report = active[at[i]]
        best = report.best
        for k in range(i, j):
            if bound[k] < (best[0][0] if len(best) == most else -1.0):
                break
            name = report.similarity(keys[x[k]])
            entry = (float(np.round(name + bonus[k], SCORE_DIGITS)), -int(ids[x[k]]), name, float(km[k]))
            if len(best) < most:
                heappush(best, entry)
            elif entry > best[0]:
                heapreplace(best, entry)


def _held(done: list[_Report]) -> pd.DataFrame:
    rows = [(-e[1], r.ord, e[2], e[3], e[0]) for r in done for e in r.best]
    return pd.DataFrame(rows, columns=[c.split()[0] for c in PAIRS.split(", ")])


def best_near(rows: DataFrame, reports: DataFrame, most: int, radius_km: float) -> DataFrame:
    """(m_ord, p_ord, name_score, km, score): at least the ``most`` best free rows within ``radius_km`` of each report.

    ``rows`` have m_ord, m_key, m_lat, m_lon and holder: a row is free for reports
    before its holder.  ``reports`` have p_ord, p_key, p_lat and p_lon.  Best is by score,
    then by m_ord; fewer rows are given only where there are no more.  A distance
    of exactly 0 earns no bonus.
    """
    circle = circles(reports, "report", radius_km, "p_ord", "p_lat", "p_lon").select("place_id", "start", "stop", "low", "high", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    placed = circle.join(reports.select(F.col("p_ord").alias("place_id"), F.col("p_key").alias("name")), "place_id")
    points = rows.select(F.col("m_ord").alias("point"), F.col("m_key").alias("name"), F.col("m_lat").alias("lat"), F.col("m_lon").alias("lon"), "holder")

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, active = None, []
        for b in batches:
            strip, chunk = b["strip"].to_numpy(), b["chunk"].to_numpy()
            cuts = np.flatnonzero((np.diff(strip) != 0) | (np.diff(chunk) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(b)]):
                if hi <= lo:
                    continue
                if (strip[lo], chunk[lo]) != here:
                    yield _held(active)
                    here, active = (strip[lo], chunk[lo]), []
                piece = b.iloc[lo:hi]
                is_place = piece["is_place"].to_numpy()
                new = piece[is_place]
                active += [_Report(*r) for r in zip(*(new[c].tolist() for c in ("place_id", "name", "event", "stop", "p_lat", "p_lon")))]
                near = piece[~is_place]
                x = near["lon"].to_numpy()
                if not len(x) or not active:
                    continue
                keys = near["name"].tolist()
                codes, size = _codes(keys)
                points = {"lat": near["lat"].to_numpy(), "lon": x, "key": keys, "codes": codes, "size": size, "id": near["point"].to_numpy(), "holder": near["holder"].to_numpy()}
                points["cos"] = np.cos(np.radians(points["lat"]))
                first = np.searchsorted(x, [r.start for r in active], "left")
                last = np.searchsorted(x, [r.stop for r in active], "right")
                # reports are taken in runs that meet about MET rows, and rows of a report that alone meets more as well
                met = np.cumsum(np.maximum(last - first, 0))
                step = np.flatnonzero(np.diff(met // MET)) + 1
                for i, j in zip([0, *step], [*step, len(active)]):
                    _offer(active[i:j], points, first[i:j], last[i:j], most, radius_km)
                reached = x[-1]
                done = [r for r in active if r.stop < reached]
                if done:
                    yield _held(done)
                    active = [r for r in active if r.stop >= reached]
        yield _held(active)

    events = in_strips(points, placed, chunk_rows=CHUNK_ROWS)
    # numbers without nulls stay whole in pandas
    events = events.withColumns({"point": F.coalesce("point", F.lit(0)), "place_id": F.coalesce("place_id", F.lit(0)), "holder": F.coalesce("holder", F.lit(FREE))})
    ordered = events.repartition(partitions(rows.sparkSession), "strip", "chunk").sortWithinPartitions("strip", "chunk", "event", F.col("is_place").desc(), "point")
    return ordered.mapInPandas(sweep, PAIRS)
