"""Arrow functions for what Spark has no expression for."""

from __future__ import annotations

import re
import struct
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreweave.functions.text import clean_report_text, site_key


@F.pandas_udf(T.DoubleType())
def _ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([100.0 * SequenceMatcher(None, a, b).ratio() if a and b else 0.0 for a, b in zip(left, right)], dtype="float64")


def key_similarity(left: Column, right: Column) -> Column:
    """Ratcliff-Obershelp similarity of two site keys, 0 to 100; 0 if one is empty. Not symmetric."""
    return _ratio(left, right)


def name_similarity(left: Column, right: Column) -> Column:
    return _ratio(site_key(left), site_key(right))


_SENTENCE_GAP = re.compile(r"(?<=[.!?])\s+")


def pack_sentences(text: str, most: int) -> list[str]:
    """Chunks of at most ``most`` characters of a text with single blanks: runs of whole sentences, as long as they fit.

    A chunk is a slice of the text from the start of a sentence to the last
    sentence end in reach.  A sentence with no end in reach is cut by itself, at
    the last blank of each stretch or where the stretch ends.
    """
    gaps = np.array([m.span() for m in _SENTENCE_GAP.finditer(text)], dtype="i8").reshape(-1, 2)
    starts, ends = np.append(0, gaps[:, 1]), np.append(gaps[:, 0], len(text))
    filled = starts < ends
    starts, ends = starts[filled], ends[filled]
    # index after the last sentence that fits when a chunk begins with each sentence
    reach = np.searchsorted(ends, starts + most, "right")
    stretch = re.compile(rf"(?s).{{1,{most}}}\Z|.{{1,{most - 1}}}(?= )|.{{{most}}}")
    chunks: list[str] = []
    k = 0
    while k < len(starts):
        if reach[k] > k:
            chunks.append(text[starts[k] : ends[reach[k] - 1]])
            k = int(reach[k])
        else:
            chunks += filter(None, map(str.strip, stretch.findall(text[starts[k] : ends[k]])))
            k += 1
    return chunks


def chunk_text(text: Column, max_tokens: int = 1500) -> Column:
    """Array of chunks of a report text, at most max(500, 4 * max_tokens) characters each."""
    most = max(500, 4 * max_tokens)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def chunk(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: pack_sentences(t, most) if t else [])

    return chunk(clean_report_text(text))


@F.pandas_udf(T.BinaryType())
def _points(lon: pd.Series, lat: pd.Series) -> pd.Series:
    """Little-endian WKB points of 21 bytes, built as one array."""
    ok = (lon.notna() & lat.notna()).to_numpy()
    raw = np.zeros(len(lon), dtype=np.dtype([("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")]))
    raw["order"], raw["kind"], raw["x"], raw["y"] = 1, 1, lon.fillna(0), lat.fillna(0)
    data = raw.tobytes()
    return pd.Series([data[21 * i : 21 * i + 21] if keep else None for i, keep in enumerate(ok)], dtype=object)


def point(lon: Column, lat: Column) -> Column:
    """WKB point; null if a coordinate is null."""
    return _points(lon.cast("double"), lat.cast("double"))


@F.pandas_udf(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
def _places(points: pd.Series) -> pd.DataFrame:
    rows = []
    for b in points:
        order = "<" if b is not None and len(b) >= 21 and b[0] == 1 else ">"
        is_point = b is not None and len(b) >= 21 and struct.unpack_from(order + "I", b, 1)[0] & 0xFF == 1
        rows.append(struct.unpack_from(order + "dd", b, 5) if is_point else (None, None))
    return pd.DataFrame(rows, columns=["x", "y"], dtype="float64")


def point_place(geometry: Column) -> Column:
    """struct(x, y) of a WKB point in either byte order, nulls for anything else."""
    place = _places(geometry)
    return F.struct(F.nanvl(place["x"], F.lit(None)).alias("x"), F.nanvl(place["y"], F.lit(None)).alias("y"))
