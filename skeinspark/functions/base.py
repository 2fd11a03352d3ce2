"""Small things that all expression modules use."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x: Column | str) -> Column:
    """A column, by name or as it is."""
    return F.col(x) if isinstance(x, str) else x


def first_match(x: Column, rules: Iterable[tuple[str, str]], otherwise: str | Column | None) -> Column:
    """The value of the first rule (pattern, value) whose pattern is found in x."""
    out = F
    for pattern, value in rules:
        out = out.when(F.rlike(x, F.lit(pattern)), F.lit(value))
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def present(x: Column | str) -> Column:
    """x with NaN as null."""
    return F.nanvl(col(x), F.lit(None).cast("double"))
