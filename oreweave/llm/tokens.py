"""Encoding a corpus with a public tokenizer, and decoding it (problem 8).

Byte-level BPE by tiktoken from a local rank file.  The driver reads the file
once (about 1 MB, checked) and ships it with the tasks, so executors need no
copy.  Rows stream through Arrow: no shuffle, one batch in memory.  Long texts
are first cut where the pre-splitting pattern must cut anyway, so the pieces'
tokens joined are exactly the text's tokens.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_DIR = "/opt/tokenizers"
DEFAULT_MODEL = "byte_bpe_50k"
#: Fixed value: the pattern that belongs to the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A rank file beyond this size is refused, as it travels with every task.
MOST_RANK_BYTES = 64 << 20
PIECE_CHARS = 200_000

#: Where a cut changes no token: before white space after anything else (tokens
#: hold white space only at their start or alone), and after a run of letters or
#: of digits that anything but white space of another class follows.
_SAFE = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])")


def rank_file(model: str = DEFAULT_MODEL, folder: str = DEFAULT_DIR) -> bytes:
    path = os.path.join(folder, f"{model}.tiktoken")
    if os.path.getsize(path) > MOST_RANK_BYTES:
        raise ValueError(f"{path} is larger than {MOST_RANK_BYTES} bytes")
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def encoder(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def safe_pieces(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """Pieces of about ``most`` characters, cut only at safe boundaries; a stretch without one stays whole."""
    at = 0
    while len(text) - at > most:
        cut = _SAFE.search(text, at + most)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encode_text(text: str | None, ranks: bytes) -> list[int]:
    """Token ids; [] for null and empty texts."""
    if not text:
        return []
    enc = encoder(ranks)
    if len(text) <= PIECE_CHARS:
        return enc.encode_ordinary(text)
    return [i for piece in safe_pieces(text) for i in enc.encode_ordinary(piece)]


def _ranks_of(df: DataFrame, model: str, folder: str):
    return df.sparkSession.sparkContext.broadcast(rank_file(model, folder))


def encode_corpus(
    docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = DEFAULT_MODEL, folder: str = DEFAULT_DIR
) -> DataFrame:
    """(key, ids array<int>): one row per row of ``docs``, repeated rows too.

    Null and empty texts give an empty list; blank texts give their tokens; a
    null key is kept.  The strings of special tokens are ordinary text.  Other
    columns are not read.
    """
    shipped = _ranks_of(docs, model, folder)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = [encode_text(t, shipped.value) for t in b.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, lists)], dtype="i8")
            flat = np.fromiter((i for ids in lists for i in ids), dtype="i4", count=int(ends[-1]))
            if ends[-1] > 2**31 - 1:
                raise ValueError("lower spark.sql.execution.arrow.maxRecordsPerBatch: a batch has over 2^31 tokens")
            ids = pa.ListArray.from_arrays(pa.array(ends.astype("i4")), pa.array(flat))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=[key, "ids"])

    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    return docs.select(key, text).mapInArrow(encode, schema)


def count_tokens(
    docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = DEFAULT_MODEL, folder: str = DEFAULT_DIR
) -> DataFrame:
    """(key, n_tokens int) without carrying the ids."""
    shipped = _ranks_of(docs, model, folder)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = pa.array([len(encode_text(t, shipped.value)) for t in b.column(1).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), n], names=[key, "n_tokens"])

    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("n_tokens", T.IntegerType())])
    return docs.select(key, text).mapInArrow(count, schema)


def decode_corpus(
    encoded: DataFrame, key: str = "doc_id", ids: str = "ids", model: str = DEFAULT_MODEL, folder: str = DEFAULT_DIR
) -> DataFrame:
    """(key, text): the raw bytes of the ids joined, then read as UTF-8; [] and null give ''.

    Bytes are joined before they are read, since a token may hold part of a
    character.  Ids outside the vocabulary raise.
    """
    shipped = _ranks_of(encoded, model, folder)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            enc = encoder(shipped.value)
            texts = [enc.decode_bytes(x or []).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    schema = T.StructType([T.StructField(key, encoded.schema[key].dataType), T.StructField("text", T.StringType())])
    return encoded.select(key, ids).mapInArrow(decode, schema)


def token_statistics(encoded: DataFrame, ids: str = "ids") -> DataFrame:
    """(token_id, n): how often each token occurs in the whole corpus, combined before the shuffle."""
    return encoded.select(F.explode(ids).alias("token_id")).groupBy("token_id").agg(F.count("*").alias("n"))
