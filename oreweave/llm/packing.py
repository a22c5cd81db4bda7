"""Filling fixed-capacity containers with items (problem 9).

Only the lengths matter to a packing, and there are at most ``capacity`` of
them, so the whole corpus is reduced to a histogram.  On it, gaps are closed by
exact complements: single lengths, pairs and triples whose sum is the gap, each
combination consumed as often as the counts allow; what has no complement takes
the best fit and tries again.  The result is a short list of patterns with
multiplicities.  Items get a rank within their length from two-level counts and
look their container up in the pattern list, in parallel, so neither the items
nor a frequent length ever meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreweave.session import cut_lineage

CHUNKS = 256


def exact_combination(counts: np.ndarray, gap: int) -> list[int] | None:
    """One, two or three available lengths that sum to ``gap``, larger ones first; None if there are none."""
    if gap < len(counts) and counts[gap]:
        return [gap]
    top = min(gap - 1, len(counts) - 1)
    if top < 1:
        return None
    have = counts > 0
    pair = _pair(counts, have, gap, top)
    if pair:
        return pair
    # sums of two available lengths as the bits of one number; counts are checked only where a bit is set
    lengths = np.flatnonzero(have[: top + 1]).tolist()
    bits = sum(1 << n for n in lengths)
    sums = 0
    for n in lengths:
        sums |= bits << n
    for c in reversed(lengths):  # largest first
        rest = gap - c
        if rest >= 2 and sums >> rest & 1:
            counts[c] -= 1
            pair = _pair(counts, counts > 0, rest, min(rest - 1, c))
            counts[c] += 1
            if pair:
                return [c, *pair]
    return None


def _pair(counts: np.ndarray, have: np.ndarray, gap: int, top: int) -> list[int] | None:
    """Two available lengths of at most ``top`` that sum to ``gap``, the larger as large as can be."""
    a = np.arange(max(1, (gap + 1) // 2), top + 1)
    if not len(a):
        return None
    ok = have[a] & have[gap - a]
    if len(a) and 2 * a[0] == gap:
        ok[0] = counts[a[0]] >= 2
    found = np.flatnonzero(ok)
    return [int(a[found[-1]]), gap - int(a[found[-1]])] if len(found) else None


def pack_histogram(counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths, multiplicity) that use every item of the histogram once.

    counts[n] is the number of items of length n, 1 <= n <= capacity.
    """
    counts = counts.copy()
    patterns: list[tuple[list[int], int]] = []
    length = capacity
    while length:
        if not counts[length]:
            length -= 1
            continue
        counts[length] -= 1
        pattern, gap = [length], capacity - length
        while gap:
            combination = exact_combination(counts, gap)
            if combination is None:
                below = np.flatnonzero(counts[1 : gap + 1])
                if not len(below):
                    break
                combination = [int(below[-1]) + 1]
            for n in combination:
                counts[n] -= 1
            pattern += combination
            gap -= sum(combination)
        lengths, times = np.unique(pattern, return_counts=True)
        again = int((counts[lengths] // times).min())
        counts[lengths] -= again * times
        patterns.append((pattern, again + 1))
    return patterns


def split_items(sizes: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """(key, piece, start, length): items cut only where they exceed the capacity; sizes of 0 or null left out."""
    pieces = F.ceil(F.col(size) / capacity).cast("int")
    return (
        sizes.where(F.col(size) > 0)
        .select(key, size, F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"))
        .select(
            key,
            "piece",
            (F.col("piece") * capacity).cast("long").alias("start"),
            F.least(F.lit(capacity), F.col(size) - F.col("piece") * capacity).cast("int").alias("length"),
        )
    )


def pack_items(sizes: DataFrame, key: str = "doc_id", size: str = "n_tokens", capacity: int = 2048) -> DataFrame:
    """(key, piece, start, length, container_id): every item of size above 0 in one container.

    An item above the capacity is split into full pieces and a remainder, every
    other item has one piece at start 0.  Repeated keys are packed as often as
    they occur.  The sum of lengths in a container is at most ``capacity``.
    An empty table gives an empty result.  Container ids start at 0 and are dense.
    """
    items = split_items(sizes, key, size, capacity).withColumn(
        "chunk", F.pmod(F.xxhash64(F.col(key), F.col("piece")), F.lit(CHUNKS)).cast("int")
    )
    items = cut_lineage(items)
    per_chunk = items.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    # at most capacity x CHUNKS rows; the histogram at most capacity
    offsets = per_chunk.withColumn(
        "offset",
        F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).drop("n")
    histogram = np.zeros(capacity + 1, dtype="i8")
    for row in per_chunk.groupBy("length").agg(F.sum("n").alias("n")).toLocalIterator():
        histogram[row["length"]] = row["n"]
    starts, bases, times, slots = _plan(pack_histogram(histogram, capacity), capacity)
    shipped = sizes.sparkSession.sparkContext.broadcast((starts, bases, times, slots))
    ranked = items.join(offsets, ["length", "chunk"]).withColumn(
        "rank", F.row_number().over(Window.partitionBy("length", "chunk").orderBy(key, "piece")) - 1 + F.col("offset")
    )

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts, bases, times, _ = shipped.value
        for b in batches:
            out = np.empty(len(b), dtype="i8")
            lengths, ranks = b["length"].to_numpy(), b["rank"].to_numpy()
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                k = np.searchsorted(starts[n], ranks[at], "right") - 1
                out[at] = bases[n][k] + (ranks[at] - starts[n][k]) // times[n][k]
            yield b[[key, "piece", "start", "length"]].assign(container_id=out)

    schema = T.StructType(
        [
            T.StructField(key, sizes.schema[key].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.IntegerType()),
            T.StructField("container_id", T.LongType()),
        ]
    )
    return ranked.select(key, "piece", "start", "length", "rank").mapInPandas(place, schema)


def _plan(patterns: list[tuple[list[int], int]], capacity: int) -> tuple[dict, dict, dict, int]:
    """Per length: first rank of each use, container of that rank, items of the length per container."""
    starts: dict[int, list[int]] = {}
    bases: dict[int, list[int]] = {}
    times: dict[int, list[int]] = {}
    used = np.zeros(capacity + 1, dtype="i8")
    base = 0
    for pattern, again in patterns:
        for n, k in zip(*np.unique(pattern, return_counts=True)):
            starts.setdefault(int(n), []).append(int(used[n]))
            bases.setdefault(int(n), []).append(base)
            times.setdefault(int(n), []).append(int(k))
            used[n] += int(k) * again
        base += again
    as_arrays = lambda d: {n: np.array(v, dtype="i8") for n, v in d.items()}
    return as_arrays(starts), as_arrays(bases), as_arrays(times), base


def container_fill(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """(container_id, n_items, used, unused) of each container."""
    return packed.groupBy("container_id").agg(
        F.count("*").alias("n_items"), F.sum("length").alias("used"), (F.lit(capacity) - F.sum("length")).alias("unused")
    )
