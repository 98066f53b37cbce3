"""Numeric expressions with the panel's null and zero rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelattice import vocabulary as V


def relative_change(value: Column, base: Column) -> Column:
    """(value - base) / base; null where the base is null or zero."""
    return F.when(base != 0, (value - base) / base)


def pct_change(value: Column, previous: Column) -> Column:
    """value / previous - 1 with IEEE results for a zero base (inf or NaN, no error)."""
    on_zero = F.when(value > 0, F.lit(float("inf"))).when(value < 0, F.lit(float("-inf"))).otherwise(F.lit(float("nan")))
    return F.when(previous == 0, on_zero).otherwise(value / previous - 1)


def stable_mean(value: Column) -> Column:
    """Mean of a double column that does not depend on the order of addition.

    Summing as decimal gives the same digits for every partitioning and retry.
    """
    return F.sum(value.cast("decimal(28,8)")).cast("double") / F.count(value)


_NUMBER = r"(?iU)^[\s\x1c-\x1f]*([+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity|nan))[\s\x1c-\x1f]*$"


def number_text(cell: Column) -> Column:
    """The number a text cell holds, as text; empty if it holds none."""
    return F.regexp_extract(cell, _NUMBER, 1)


def number_value(text: Column) -> Column:
    return F.when(text != "", text).cast("double")


def is_bad_cell(cell: Column, text: Column) -> Column:
    """True where a cell holds neither a number, nor the placeholder, nor nothing."""
    return F.when(text != "", False).otherwise(
        F.coalesce(F.btrim(cell, F.lit(V.WHITESPACE_CHARACTERS)) != V.EMPTY_NUMBER, F.lit(False))
    )


def clean_number(cell: Column) -> Column:
    """Text cell to double; the '-' placeholder and cells that are no number give null."""
    return number_value(number_text(cell))


def is_bad_number(cell: Column) -> Column:
    return is_bad_cell(cell, number_text(cell))
