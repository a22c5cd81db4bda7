"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once.

    Catalyst inlines stacked projections, so a sub-expression used n times is
    evaluated n times inside lambdas; a one-element array binds it instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trim_all(c: Column) -> Column:
    """Without white space (Unicode too) at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
