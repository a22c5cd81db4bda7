"""Several values packed in one field (problem 7).

Quoted spans are replaced by indexed placeholders that cannot collide with the
text, the rest is split at the delimiters, spans are put back by array lookup
and the values are exploded with their positions.  Only built-in expressions:
one narrow stage, no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreweave.functions.constants import NULL_TOKENS
from oreweave.functions.helpers import let

OPEN, CLOSE, ESCAPED, SLASH = "\ue000", "\ue001", "\ue002", "\ue003"

#: Delimiters other than blanks. A hyphen separates only between blanks, a
#: plus sign and "and" only as words of their own.
DELIMITERS = r"(?:[,;|/&\t\r\n，；、]|(?<=\s)[+\-](?=\s)|(?<=\s)(?i:and)(?=\s))"

_EDGE = r"\s,;|/&，；、\[\]{}()"
#: A quoted span opens at the start of a value and closes at its end; a doubled
#: quote inside belongs to the value. Possessive, so long cells cost no stack.
QUOTED = (
    rf'(?<![^{_EDGE}])"(?:[^"]++|"")*+"(?![^{_EDGE}])'
    rf"|(?<![^{_EDGE}])'(?:[^']++|'')*+'(?![^{_EDGE}])"
)
_BLANK = r"[\s 　]"
_ENDS = rf"^{_BLANK}+|{_BLANK}+$"


def _trim(c: Column) -> Column:
    return F.regexp_replace(c, _ENDS, "")


def _unquote(c: Column) -> Column:
    quote = F.substring(c, 1, 1)
    body = c.substr(F.lit(2), F.length(c) - 2)
    return F.replace(body, F.concat(quote, quote), quote)


def packed_values(cell: Column) -> Column:
    """Array of the values of one cell, in order; empty places and null words left out.

    Null, blank and null-word cells give an empty array.  Repeats are kept.
    """
    text = F.replace(F.replace(F.coalesce(cell, F.lit("")), F.lit(OPEN), F.lit(OPEN + ESCAPED)), F.lit(SLASH), F.lit(OPEN + SLASH))
    return let(text, lambda t: let(F.regexp_extract_all(t, F.lit(QUOTED), F.lit(0)), lambda spans: _split(t, spans)))


def _split(text: Column, spans: Column) -> Column:
    marked = F.array_join(
        F.transform(
            F.split(text, QUOTED, -1),
            lambda p, i: F.when(i < F.size(spans), F.concat(p, F.lit(OPEN), i.cast("string"), F.lit(CLOSE))).otherwise(p),
        ),
        "",
    )
    # one pair of brackets around the whole list, as in JSON or array literals
    marked = F.regexp_replace(marked, r"(?s)^\s*(?:\[(.*)\]|\{(.*)\}|\((.*)\))\s*$", "$1$2$3")
    # a null word that holds a delimiter
    marked = F.regexp_replace(marked, r"(?i)(?<![^\s,;|，；、])n/a(?![^\s,;|，；、])", "n" + SLASH + "a")

    def restore(part: Column) -> Column:
        one = F.regexp_extract(part, f"^{OPEN}(\\d+){CLOSE}$", 1)
        mixed = F.aggregate(
            F.sequence(F.lit(0), F.greatest(F.size(spans) - 1, F.lit(0))),
            part,
            lambda acc, i: F.replace(
                acc, F.concat(F.lit(OPEN), i.cast("string"), F.lit(CLOSE)), F.coalesce(F.get(spans, i), F.lit(""))
            ),
        )
        plain = (
            F.when(~part.contains(CLOSE), part)
            .when(one != "", let(F.get(spans, one.cast("int")), _unquote))
            .otherwise(mixed)
        )
        plain = F.replace(plain, F.lit("n" + SLASH + "a"), F.lit("n/a"))
        return _trim(F.replace(F.replace(plain, F.lit(OPEN + SLASH), F.lit(SLASH)), F.lit(OPEN + ESCAPED), F.lit(OPEN)))

    parts = let(
        marked,
        lambda m: F.when(m.rlike(DELIMITERS), F.split(m, DELIMITERS, -1)).otherwise(F.split(_trim(m), rf"{_BLANK}+", -1)),
    )
    values = F.transform(parts, lambda p: let(_trim(p), restore))
    return F.filter(values, lambda v: ~F.lower(v).isin(*NULL_TOKENS))


def unpack_values(
    df: DataFrame, key: str = "row_id", cell: str = "code_list", value: str = "packed_value", least: int = 2
) -> DataFrame:
    """(key, pos, value): one row per value of each cell that packs at least ``least`` values.

    pos counts the values of the cell from 1.  Null and blank cells, and cells
    with fewer values, give no row; an empty table gives an empty result.
    Columns other than ``key`` and ``cell`` are not read, so their names may clash.
    """
    kept = let(packed_values(F.col(cell)), lambda v: F.when(F.size(v) >= least, v))
    # the outer form, as the inner one would repeat the whole expression in a filter
    return (
        df.select(key, F.posexplode_outer(kept).alias("pos0", value))
        .where(F.col(value).isNotNull())
        .select(key, (F.col("pos0") + 1).cast("int").alias("pos"), value)
    )
