"""Text and value expressions of the deposit ETL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreweave.functions.constants import AGE_KEYWORDS, LITHOLOGY_KEYWORDS, NULL_TOKENS
from oreweave.functions.helpers import let, trim_all


def clean_scalar(c: Column) -> Column:
    """Trimmed, then without double quotes at the ends; null words are null."""
    return let(
        F.regexp_replace(trim_all(c), '^"+|"+$', ""), lambda t: F.when(~F.lower(t).isin(*NULL_TOKENS), t)
    )


def collapse(c: Column) -> Column:
    """White space runs as one blank, trimmed; blank is null."""
    return F.nullif(trim_all(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(""))


def clean_report_text(c: Column) -> Column:
    """Words broken over lines joined, white space runs as one blank, trimmed; null is ''."""
    joined = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)-\s*\n\s*", "")
    return trim_all(F.regexp_replace(joined, r"(?U)\s+", " "))


def optional_text(c: Column) -> Column:
    """Trimmed; blank is null."""
    return F.nullif(trim_all(c), F.lit(""))


def combined_text(*columns: Column) -> Column:
    """Collapsed values joined by a blank; nulls left out."""
    return F.concat_ws(" ", *[collapse(c) for c in columns])


def site_key(c: Column) -> Column:
    """Lower-case ASCII letters and digits of a name; '' for null."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "")


def coerce_double(c: Column) -> Column:
    """Double that a value reads as; null for text that is none, and for NaN."""
    text = trim_all(c.cast("string"))
    number = F.when(text.rlike(r"(?i)^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|inf(inity)?)$"), text.try_cast("double"))
    return F.nanvl(number, F.lit(None).cast("double"))


def first_present(*columns: Column) -> Column:
    """First value that is neither null nor NaN nor an empty string."""
    return F.coalesce(*[F.when(c.isNotNull() & ~c.cast("string").isin("", "NaN"), c) for c in columns])


def join_distinct(*columns: Column, separator: str = ";") -> Column:
    """Distinct non-blank values in order, joined; null if there are none."""
    values = F.filter(F.array(*[trim_all(c) for c in columns]), lambda x: x.isNotNull() & (x != ""))
    return F.nullif(F.array_join(F.array_distinct(values), separator), F.lit(""))


def report_record_id(site_name: Column, path: Column) -> Column:
    """'pdf-' and the first 16 hex digits of the SHA-1 of 'path:site'; nulls count as ''."""
    seed = F.concat_ws(":", F.coalesce(path, F.lit("")), F.coalesce(site_name, F.lit("")))
    return F.concat(F.lit("pdf-"), F.substring(F.sha1(seed), 1, 16))


def clean_header(name: str) -> str:
    """Column name in lower case, runs of other characters than letters and digits as one underscore."""
    import re

    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")


def _keyword(text: Column, words: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.when(text.rlike(rf"(?i)\b{w}\b"), F.lit(w)) for w in words])


def extract_lithology(unit: Column, description: Column) -> Column:
    """First listed rock in "unit description" as a whole word; else the unit, or the description, in lower case."""
    return F.coalesce(
        let(combined_text(unit, description), lambda t: _keyword(t, LITHOLOGY_KEYWORDS)),
        F.lower(collapse(unit)),
        F.lower(collapse(description)),
    )


def extract_age(unit: Column, description: Column) -> Column:
    """First listed age in "unit description" as a whole word, in its listed spelling; else null."""
    return let(combined_text(unit, description), lambda t: _keyword(t, AGE_KEYWORDS))


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)
