"""Bitmaps of keys: rows that can meet no key are dropped before anything is shuffled.

A key sets two bits.  A bitmap has EACH bits a key, so that few other keys pass
it whatever the data's size, but no more than MOST bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap a key, at least and at most (64 MB).
EACH, LEAST, MOST = 8, 1 << 25, 1 << 29
#: Words of 32 bits that travel in one row.
BLOCK = 4096


def bits_for(keys: int) -> int:
    """Bits of a bitmap of so many keys, a power of two."""
    return min(MOST, max(LEAST, 1 << (EACH * keys - 1).bit_length()))


def slots(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each key; ``bits`` is a power of two."""
    drop = np.uint64(65 - bits.bit_length())
    x = keys.astype("u8")
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    y = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> drop).astype("i8"), (y >> drop).astype("i8")


def key_bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of the two slots of all values of the column ``key``."""

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = np.unique(np.concatenate(slots(b["key"].to_numpy(), bits)))
            yield pd.DataFrame({"word": s // 32, "bit": np.left_shift(1, s % 32)})

    words = keys.select("key").mapInPandas(mark, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits"))

    def pack(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        block = np.zeros(BLOCK, dtype="u4")
        block[b["word"].to_numpy() % BLOCK] = b["bits"].to_numpy()
        return pd.DataFrame({"block": [key[0]], "data": [block.tobytes()]})

    # a block holds at most BLOCK words
    blocks = words.groupBy(F.floor(F.col("word") / BLOCK).alias("block")).applyInPandas(pack, "block long, data binary")
    bitmap = np.zeros(bits // 32, dtype="u4")
    for row in blocks.toLocalIterator():
        bitmap[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(bytes(row["data"]), "u4")
    return bitmap


def has(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    one, two = slots(keys, 32 * len(bitmap))
    return (bitmap[one // 32] >> (one % 32)) & (bitmap[two // 32] >> (two % 32)) & 1 == 1
