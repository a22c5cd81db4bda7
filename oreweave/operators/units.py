"""Quantities recorded in different units (problem 1).

A statement names its unit beside the number, in a unit column, in a remark or
only through the habit of its source.  Every reading of a cell is turned into
kilograms-based common units by the physical identities between mass units and
between mass ratios.  The candidate units of a statement are those of its
strongest evidence; a cell without any evidence keeps all units as candidates
and takes the one with the smallest log residual against the other statements
of the same deposit, flagged when another unit fits about as well.

All of it is built-in expressions; the only shuffles are by deposit.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreweave.functions.helpers import let
from oreweave.session import cut_lineage

# Exact definitions.
POUND_KG = 0.45359237
SHORT_TON_KG = 2000 * POUND_KG
LONG_TON_KG = 2240 * POUND_KG
TROY_OUNCE_G = 31.1034768

#: name -> (pattern, factor to the common unit), tonnes for masses
MASS_UNITS = {
    "long ton": (r"long[ \-]?tons?|l\. ?t\.?|lt|gross tons?|imperial tons?", LONG_TON_KG / 1000),
    "tonne": (r"metric[ \-]?ton(?:ne)?s?|tonnes?|m\.t\.|t", 1.0),
    "short ton": (r"short[ \-]?tons?|s\. ?t\.?|st|us tons?|tons?", SHORT_TON_KG / 1000),
    "kilogram": (r"kilogram(?:me)?s?|kilos?|kgs?", 0.001),
    "pound": (r"pounds?|lbs?\.?", POUND_KG / 1000),
    "gram": (r"grams?|grammes?", 1e-6),
}
SCALES = {"million": (r"million|mega|mm|m", 1e6), "thousand": (r"thousand|kilo|k|000", 1e3)}
_PER = r"(?: ?/ ?| per )"
_SHORT = r"(?:short[ \-]?ton|s\.t\.|st|ton)"
_TONNE = r"(?:metric[ \-]?ton(?:ne)?|tonne|t)"
#: grams per tonne for mass ratios
RATIO_UNITS = {
    "percent": (r"wt\.? ?%|weight %|per ?cent|pct\.?|%", 1e4),
    "ppb": (r"parts per billion|ppb|mg/t|ug/kg|µg/kg", 1e-3),
    "ppm": (r"parts per million|ppm|mg/kg|g/t|g/tonne|gpt|gm?s?/t|" + rf"gram(?:me)?s?{_PER}{_TONNE}|g{_PER}{_TONNE}", 1.0),
    "kg/t": (rf"(?:kilogram(?:me)?s?|kilos?|kgs?){_PER}{_TONNE}", 1e3),
    "oz/ton": (
        rf"(?:troy )?(?:ounces?|oz)\.?(?: t(?:roy)?\.?)?{_PER}{_SHORT}|opt|ozt/st",
        TROY_OUNCE_G / (SHORT_TON_KG / 1000),
    ),
    "dwt/ton": (rf"(?:penny ?weights?|dwts?){_PER}{_SHORT}", TROY_OUNCE_G / 20 / (SHORT_TON_KG / 1000)),
    "lb/ton": (rf"(?:pounds?|lbs?)\.?{_PER}{_SHORT}", POUND_KG * 1000 / (SHORT_TON_KG / 1000)),
}
FIELDS = ("tonnage", "grade")

_GAP = "[    ]"
#: digits, grouped by commas, dots, apostrophes or blanks, with decimals and exponent
NUMBER = rf"(?:\d{{1,3}}(?:{_GAP}\d{{3}})+(?!\d)|\d[\d.,'’]*|[.,]\d+)(?:[.,]\d+)?(?:[eE][+\-]?\d+)?"
#: words that may stand before the number of a cell
_LEAD = r"^\s*(?:[~≈<>]|ca\.?|c\.|circa|about|approx\.?|approximately|est\.?|estimated|around|roughly|some|\s)*\s*"


def _mass_pattern() -> str:
    scale = "|".join(p for p, _ in SCALES.values())
    unit = "|".join(p for p, _ in MASS_UNITS.values())
    return rf"(?:(?:{scale})[ \-]?)?(?:{unit})"


def _ratio_pattern() -> str:
    return "|".join(p for p, _ in RATIO_UNITS.values())


_PATTERN = {"tonnage": _mass_pattern(), "grade": _ratio_pattern()}
_FREE = r"(?![a-z0-9/%])(?! ?per )"


def unit_factor(text: Column, field: str) -> Column:
    """Factor of a unit text (the whole text is one unit) to t or g/t; null if it is none."""
    unit = F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))

    def one(u: Column) -> Column:
        table = MASS_UNITS if field == "tonnage" else RATIO_UNITS
        if field == "grade":
            return F.coalesce(*[F.when(u.rlike(rf"^(?:{p})$"), F.lit(f)) for p, f in table.values()])
        whole = [F.when(u.rlike(rf"^(?:{p})$"), F.lit(f)) for p, f in table.values()]
        scaled = [
            F.when(u.rlike(rf"^(?:{sp})[ \-]?(?:{p})$"), F.lit(f * sf))
            for sp, sf in SCALES.values()
            for p, f in table.values()
        ]
        return F.coalesce(*whole, *scaled)

    return let(unit, one)


def parse_number(text: Column) -> Column:
    """The number that a number text means.

    A comma followed by exactly three digits groups thousands, any other comma
    is decimal; repeated dots, blanks and apostrophes group too.
    """
    plain = F.regexp_replace(text, rf"(?:{_GAP}|['’])", "")
    plain = F.regexp_replace(plain, r",(?=\d{3}(?!\d))", "")

    def dots(n: Column) -> Column:
        grouped = n.rlike(r"\..*[.,]")
        return F.regexp_replace(F.when(grouped, F.regexp_replace(n, r"\.", "")).otherwise(n), ",", ".")

    return let(plain, dots).try_cast("double")


def read_cell(cell: Column, field: str) -> Column:
    """struct(number double, unit string) of a cell; null for cells that state nothing.

    Blank, null, negative and non-numeric cells state nothing.
    """
    clean = F.regexp_replace(cell, r"[\s   ]+", " ")
    body = F.regexp_replace(clean, "(?i)" + _LEAD, "")

    def read(b: Column) -> Column:
        number = F.regexp_extract(b, rf"^\+?({NUMBER})", 1)
        tail = F.lower(F.regexp_replace(b, rf"^\+?{NUMBER}", ""))
        before = F.lower(F.regexp_extract(b, rf"(?i)^({_PATTERN[field]})\s*[:=]?\s*(?={NUMBER})", 1))
        after = F.regexp_extract(tail, rf"^[\s\-]*({_PATTERN[field]}){_FREE}", 1)
        lead_number = F.regexp_extract(b, rf"(?i)^(?:{_PATTERN[field]})\s*[:=]?\s*({NUMBER})", 1)
        return F.when(
            number != "", F.struct(parse_number(number).alias("number"), F.nullif(after, F.lit("")).alias("unit"))
        ).when(
            before != "", F.struct(parse_number(lead_number).alias("number"), F.nullif(before, F.lit("")).alias("unit"))
        )

    return let(body, read)


def remark_unit(remarks: Column, field: str) -> Column:
    """Unit that a remark names for the field, null if none.

    Mass ratios are taken out of the text before masses are looked for, so the
    "ton" of "lb/ton" is no tonnage unit.
    """
    text = F.lower(F.regexp_replace(remarks, r"\s+", " "))
    if field == "tonnage":
        text = F.regexp_replace(text, rf"(?<![a-z0-9])(?:{_PATTERN['grade']})(?![a-z0-9])", " # ")
    cue = {"tonnage": r"tonnages?|ore|weights?|quantit(?:y|ies)|tons", "grade": r"grades?|assays?|content|metal|values"}[field]
    found = F.regexp_extract(
        text, rf"(?:{cue})[^.;#]*?(?:\bin\b|\bas\b|:|\bunit\b)\s*({_PATTERN[field]})(?=$|[\s.;,)])(?! ?/)", 1
    )
    return F.nullif(found, F.lit(""))


def read_units(statements: DataFrame, sources: DataFrame, field: str) -> DataFrame:
    """statements with ``number``, ``unit``, ``evidence`` and ``value`` of one field.

    evidence: cell, column, remarks or source, in that order of strength; null
    where nothing names a unit.  ``value`` is in tonnes or g/t.  Columns of the
    same names already in ``statements`` are replaced.
    """
    habit = sources.select(
        F.lower(F.trim("source")).alias("_source"), F.col(f"{field}_unit").alias("_habit")
    ).dropDuplicates(["_source"])
    read = statements.withColumn("_read", read_cell(F.col(field), field))
    # the list of sources is a small reference table; Spark broadcasts it only if its size allows
    read = read.withColumn("_source", F.lower(F.trim(F.col("source")))).join(habit, "_source", "left")
    named = {
        "cell": F.col("_read.unit"),
        "column": F.col(f"{field}_unit"),
        "remarks": remark_unit(F.col("remarks"), field),
        "source": F.col("_habit"),
    }
    best = F.coalesce(
        *[
            let(
                F.struct(F.lit(k).alias("evidence"), u.alias("unit"), unit_factor(u, field).alias("factor")),
                lambda s: F.when(s["factor"].isNotNull(), s),
            )
            for k, u in named.items()
        ]
    )
    read = read.withColumn("_best", best)
    return read.withColumns(
        {
            "number": F.col("_read.number"),
            "unit": F.col("_best.unit"),
            "evidence": F.col("_best.evidence"),
            "value": F.col("_read.number") * F.col("_best.factor"),
        }
    ).drop("_read", "_best", "_source", "_habit")


def stated_values(statements: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per statement and field that states a number.

    (statement_id, record_id trimmed, field, cell, cell_unit, number, unit,
    evidence, value).  value is null where no evidence names a unit.
    Statements without a record_id, and cells that state nothing, give no row.
    """
    parts = []
    for field in FIELDS:
        read = read_units(
            statements.select("statement_id", "record_id", "source", "remarks", field, f"{field}_unit"), sources, field
        )
        parts.append(
            read.where(F.col("number").isNotNull() & F.col("record_id").isNotNull()).select(
                "statement_id",
                F.trim("record_id").alias("record_id"),
                F.lit(field).alias("field"),
                F.col(field).alias("cell"),
                F.col(f"{field}_unit").alias("cell_unit"),
                "number",
                "unit",
                "evidence",
                "value",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def harmonise(statements: DataFrame, sources: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Every stated number in common units, units without evidence inferred.

    All statements of one deposit describe one quantity, so log(value) of each
    should agree.  A number without unit evidence tries every unit and takes the
    one with the smallest |log residual| against the median of the evidenced
    values of its deposit and field.  Columns added: ``residual`` (log, null
    without other statements), ``inferred``, ``unique`` (false when a second unit
    comes within ``tolerance`` of the best, or when there is nothing to compare
    with; such a value stays null).  Ties go to the unit first in the table.
    """
    stated = cut_lineage(stated_values(statements, sources))
    middle = (
        stated.where(F.col("value") > 0)
        .groupBy("record_id", "field")
        .agg(F.percentile_approx(F.log("value"), 0.5, 1000).alias("middle"))
    )
    both = stated.join(middle, ["record_id", "field"], "left")
    units = F.when(
        F.col("field") == "tonnage",
        F.array(*[F.struct(F.lit(k).alias("name"), F.lit(f).alias("factor")) for k, (_, f) in _all_units("tonnage")]),
    ).otherwise(
        F.array(*[F.struct(F.lit(k).alias("name"), F.lit(f).alias("factor")) for k, (_, f) in _all_units("grade")])
    )
    log_number = F.log("number")
    tried = F.transform(
        units,
        lambda u, i: F.struct(
            F.abs(log_number + F.log(u["factor"]) - F.col("middle")).alias("off"),
            i.alias("place"),
            u["name"].alias("name"),
            u["factor"].alias("factor"),
        ),
    )
    open_ = F.col("value").isNull() & F.col("middle").isNotNull() & (F.col("number") > 0)
    both = both.withColumn("_tried", F.when(open_, F.slice(F.array_sort(tried), 1, 2)))
    best, second = F.get("_tried", F.lit(0)), F.get("_tried", F.lit(1))
    value = F.coalesce("value", F.col("number") * best["factor"])
    return both.select(
        "statement_id",
        "record_id",
        "field",
        "cell",
        "cell_unit",
        "number",
        F.coalesce("unit", best["name"]).alias("unit"),
        F.coalesce("evidence", F.when(F.col("_tried").isNotNull(), F.lit("residual"))).alias("evidence"),
        value.alias("value"),
        F.when(value > 0, F.log(value) - F.col("middle")).alias("residual"),
        F.col("_tried").isNotNull().alias("inferred"),
        F.coalesce(
            F.when(F.col("_tried").isNotNull(), second["off"] - best["off"] > tolerance),
            F.col("value").isNotNull(),
        ).alias("unique"),
    )


def _all_units(field: str) -> list[tuple[str, tuple[str, float]]]:
    if field == "grade":
        return list(RATIO_UNITS.items())
    plain = [(k, v) for k, v in MASS_UNITS.items() if k != "gram"]
    return plain + [
        (f"{s} {k}s", ("", sf * f)) for s, (_, sf) in SCALES.items() for k, (_, f) in plain
    ]


def agreeing_pairs(values: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """(statement_a, statement_b, field): pairs of one deposit with the same value.

    ``values`` as from :func:`harmonise`; only values with stated units and
    above zero, or both zero, can agree.  Same: the larger exceeds the smaller
    by at most ``tolerance``.  Pairs whose cell and unit column are both
    identical (null equals null) are left out.

    A band join: the values are hashed into log buckets of one tolerance, one
    side is sent to its own and the next bucket, so partners meet once, and only
    values near each other are compared.  A deposit with very many statements is
    spread over its buckets.
    """
    step = math.log1p(tolerance) * (1 + 1e-9)
    known = values.where(F.col("value").isNotNull() & ~F.col("inferred") & (F.col("value") >= 0)).select(
        "record_id",
        "field",
        "statement_id",
        "cell",
        "cell_unit",
        "value",
        F.when(F.col("value") > 0, F.floor(F.log("value") / step)).otherwise(F.lit(-(2**40))).cast("long").alias("bucket"),
    )
    # read by both sides: written once, so that cells are parsed once
    known = cut_lineage(known)
    low = known.select([F.col(c) if c in ("record_id", "field", "bucket") else F.col(c).alias(f"{c}_l") for c in known.columns])
    # the higher value lies in the same bucket or the one above
    high = known.withColumn("bucket", F.explode(F.array(F.col("bucket"), F.col("bucket") - 1)))
    pairs = low.join(high, ["record_id", "field", "bucket"]).where(
        (F.col("value") <= F.col("value_l") * (1 + tolerance) * (1 + 1e-12))
        & ((F.col("value") > F.col("value_l")) | ((F.col("value") == F.col("value_l")) & (F.col("statement_id") > F.col("statement_id_l"))))
        & ~(F.col("cell").eqNullSafe(F.col("cell_l")) & F.col("cell_unit").eqNullSafe(F.col("cell_unit_l")))
    )
    return pairs.select(
        F.least("statement_id", "statement_id_l").alias("statement_a"),
        F.greatest("statement_id", "statement_id_l").alias("statement_b"),
        "field",
    )
