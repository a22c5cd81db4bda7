"""Commodity expressions: names and codes at ingestion, names at fusion, labels and colours."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreweave.functions.constants import COMMODITY_COLORS, DEFAULT_COLOR, FUSION_COMMODITIES, INGEST_COMMODITIES
from oreweave.functions.helpers import let, trim_all


def _map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])


def _tokens(text: Column, pattern: str) -> Column:
    return F.filter(F.split(text, pattern), lambda x: x != "")


def split_commodities(text: Column) -> Column:
    """A text that is one listed name or code gives its name; any other is split at delimiters and blanks.

    Null gives an empty array.  (A cell with the single code AU is thus 'gold',
    for codes too.)
    """
    plain = trim_all(F.coalesce(text, F.lit("")))
    return let(
        plain,
        lambda t: F.coalesce(
            F.when(_map(INGEST_COMMODITIES)[F.lower(t)].isNotNull(), F.array(_map(INGEST_COMMODITIES)[F.lower(t)])),
            _tokens(t, r"(?U)[,\s;/|]+"),
        ),
    )


def commodity_names(text: Column) -> Column:
    """Lower-case names, each once, in order."""
    return F.array_distinct(
        F.transform(split_commodities(text), lambda x: F.coalesce(_map(INGEST_COMMODITIES)[F.lower(x)], F.lower(x)))
    )


def commodity_codes(text: Column) -> Column:
    """Upper-case codes, each once, in order."""
    return F.array_distinct(F.transform(split_commodities(text), F.upper))


def commodity_at(text: Column, place: int) -> Column:
    """The code at a place from 0, or null."""
    return F.get(commodity_codes(text), F.lit(place))


def fused_names(values: Column) -> Column:
    """Names of an array of texts at fusion: a listed phrase as a whole, anything else word by word.

    Null arrays give an empty array, null elements nothing; each name once, in order.
    """

    def expand(value: Column) -> Column:
        text = F.replace(F.lower(trim_all(value)), F.lit("_"), F.lit(" "))
        return let(
            text,
            lambda t: F.coalesce(
                F.when(_map(FUSION_COMMODITIES)[F.replace(t, F.lit("-"), F.lit(" "))].isNotNull(), F.array(_map(FUSION_COMMODITIES)[F.replace(t, F.lit("-"), F.lit(" "))])),
                _tokens(t, r"(?U)[\s,;/|+\-]+"),
            ),
        )

    present = F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda x: x.isNotNull())
    words = F.flatten(F.transform(present, expand))
    return F.array_distinct(F.transform(words, lambda x: F.coalesce(_map(FUSION_COMMODITIES)[x], x)))


def clean_list(values: Column, upper: bool = False) -> Column:
    """Trimmed, blank left out, one case, each once."""
    fold = F.upper if upper else F.lower
    folded = F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x: fold(trim_all(x)))
    return F.array_distinct(F.filter(folded, lambda x: x.isNotNull() & (x != "")))


def commodity_label(values: Column) -> Column:
    return F.array_join(F.coalesce(values, F.array().cast("array<string>")), ", ")


def commodity_color(values: Column) -> Column:
    """RGBA of the first commodity that has a colour, else the default."""
    colors = F.create_map(
        *chain.from_iterable((F.lit(k), F.array(*[F.lit(x) for x in v])) for k, v in COMMODITY_COLORS.items())
    )
    found = F.filter(
        F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x: colors[F.lower(trim_all(x))]), lambda x: x.isNotNull()
    )
    return F.coalesce(F.get(found, F.lit(0)), F.array(*[F.lit(x) for x in DEFAULT_COLOR]))
