"""Display labels and Brazilian number formats as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelattice import vocabulary as V


def _lookup(c: Column, labels: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    return F.coalesce(F.try_element_at(table, c), c)


def measure_label(c: Column) -> Column:
    return _lookup(c, V.MEASURE_LABELS)


def region_label(c: Column) -> Column:
    return _lookup(c, V.REGION_LABELS)


def type_label(c: Column) -> Column:
    return _lookup(c, V.TYPE_LABELS)


def layout_label(c: Column) -> Column:
    return _lookup(c, V.LAYOUT_LABELS)


def yes_no(c: Column) -> Column:
    return F.when(c, V.YES).otherwise(V.NO)


def regime_label(c: Column) -> Column:
    return F.when(c, V.REGIME_LABELS[True]).when(~c, V.REGIME_LABELS[False])


def series_suffix(c: Column) -> Column:
    return F.when(c, " (desonerado)").when(~c, " (não desonerado)")


def format_period(d: Column) -> Column:
    """First of a month as 'Abril/2026'."""
    months = F.array(*[F.lit(m) for m in V.MONTH_LABELS])
    return F.concat(F.try_element_at(months, F.month(d)), F.lit("/"), F.year(d).cast("string"))


def format_money(v: Column) -> Column:
    """1234.5 as 'R$ 1.234,50'."""
    return F.concat(F.lit("R$ "), F.translate(F.format_number(v, 2), ",.", ".,"))


def format_money_range(low: Column, high: Column) -> Column:
    return F.concat(format_money(low), F.lit(" – "), format_money(high))


def _percent_digits(v: Column) -> Column:
    # format_number rounds the exact binary value half-even
    return F.translate(F.format_number(v * 100, 1), ".,", ",")


def format_change(v: Column) -> Column:
    """0.015 as '+1,5%'; null as a dash."""
    digits = _percent_digits(v)
    signed = F.when(digits.startswith("-"), digits).otherwise(F.concat(F.lit("+"), digits))
    return F.coalesce(F.concat(signed, F.lit("%")), F.lit(V.MISSING_CHANGE))


def format_difference(v: Column) -> Column:
    """0.015 as '1,5%'; null as '-'."""
    return F.coalesce(F.concat(_percent_digits(v), F.lit("%")), F.lit(V.MISSING_DIFFERENCE))


def format_decimal(v: Column) -> Column:
    """104.26 as '104,3'."""
    return F.translate(F.format_number(v, 1), ".,", ",")
