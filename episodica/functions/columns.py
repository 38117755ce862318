"""Column expressions for dates, ids, flags and ratios."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from episodica.config import DATE_MAX, DATE_MIN


def parse_date_lenient(text: Column, formats: tuple[str, ...] = ("yyyy-MM-dd",)) -> Column:
    """Date from text; null when no format fits or the date is out of range."""
    parsed = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats])
    return F.when(parsed.between(F.lit(DATE_MIN), F.lit(DATE_MAX)), parsed)


def parse_date_strict(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Date from text; bad text fails the job (ANSI mode)."""
    return F.to_date(text, fmt)


def flag_equal(column: Column, value) -> Column:
    """1 where the column equals the value, else 0; null counts as 0."""
    return F.when(column.eqNullSafe(F.lit(value)), 1).otherwise(0)


def recode(column: Column, mapping: dict[str, str]) -> Column:
    """Replace listed values and keep all others."""
    return reduce(lambda acc, kv: F.when(column == kv[0], kv[1]).otherwise(acc), mapping.items(), column)


def strip_literal(column: Column, literal: str) -> Column:
    """Remove a literal wherever it occurs."""
    return F.replace(column, F.lit(literal), F.lit(""))


def person_key(text: Column, mapping: dict[str, str]) -> Column:
    """Numeric person id: recode the listed ids, drop the letter T, cast strictly."""
    return strip_literal(recode(text, mapping), "T").cast("bigint")


def release_date(actual: Column, projected: Column) -> Column:
    """Actual end of a stay, else the projected one."""
    return F.coalesce(actual, projected)


def release_imputed(actual: Column, projected: Column) -> Column:
    """1 where the release date had to be taken from the projection."""
    return F.when(projected.isNotNull() & actual.isNull(), 1).otherwise(0)


def years_between(later: Column, earlier: Column, days_per_year: float = 365.0) -> Column:
    """Elapsed time in years of a fixed number of days; may be negative."""
    return F.datediff(later, earlier) / F.lit(days_per_year)


def any_of(conditions: list[Column]) -> Column:
    """OR over conditions, where an unknown condition counts as false."""
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])


def ratio(num: Column, den: Column) -> Column:
    """Quotient that is null where the denominator is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))
