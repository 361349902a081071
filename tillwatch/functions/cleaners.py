"""Column-to-column cleaning rules.

Each builder returns a rule, a function from a column to its cleaned column, so
that a table's rules can be listed as data (see ``operators.cleaning``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

Rule = Callable[[Column], Column]

WHITESPACE = " \t\n\r\f\v"


def upper_or(default: str) -> Rule:
    """Upper-cased and trimmed; only null takes the default, blanks stay blank."""
    return lambda c: F.upper(F.trim(F.coalesce(c, F.lit(default))))


def trimmed_or(default: str) -> Rule:
    return lambda c: F.trim(F.coalesce(c, F.lit(default)))


def value_or(default) -> Rule:
    return lambda c: F.coalesce(c, F.lit(default))


def bounded(low=None, high=None, default=0) -> Rule:
    """Null to the default, then clamped. NaN sorts highest, so it lands on ``high``."""

    def rule(c: Column) -> Column:
        out = F.coalesce(c, F.lit(default))
        if low is not None:
            out = F.greatest(out, F.lit(low))
        if high is not None:
            out = F.least(out, F.lit(high))
        return out

    return rule


def one_if(value: int, otherwise: int = 0) -> Rule:
    """``value`` where the column equals it, ``otherwise`` for anything else, null included."""
    return lambda c: F.when(c == value, F.lit(value)).otherwise(F.lit(otherwise))


def inside_or(low, high, default) -> Rule:
    return lambda c: F.when(c.between(low, high), c).otherwise(F.lit(default))


def magnitude(default: float = 0.0) -> Rule:
    return lambda c: F.abs(F.coalesce(c, F.lit(default)))


def typed_or(type_name: str, default=None) -> Rule:
    """Cast with a default for null, empty and uncastable values; strings are stripped."""

    def rule(c: Column) -> Column:
        filled = F.nullif(c.cast("string"), F.lit(""))
        if type_name == "string":
            cast = F.btrim(filled, F.lit(WHITESPACE))
        else:
            cast = F.when(filled.isNotNull(), c).try_cast(type_name)
        return F.coalesce(cast, F.lit(default).cast(type_name))

    return rule


def numeric_or_null(c: Column) -> Column:
    """Numeric coercion: whatever does not read as a number becomes null."""
    return c.try_cast("double")


def banded(c: Column, bands: list[tuple]) -> Column:
    """Label of the first band whose upper bound exceeds the value; null falls to the last."""
    *bounded_bands, (_, last) = bands
    out = None
    for bound, label in bounded_bands:
        out = F.when(c < bound, F.lit(label)) if out is None else out.when(c < bound, F.lit(label))
    return out.otherwise(F.lit(last))


def rounded(c: Column, digits: int) -> Column:
    """Half-up rounding of non-negative doubles in plain arithmetic.

    ``F.round`` goes through a decimal object per row; this stays primitive in
    generated code. Meant for values well inside the 64-bit range.
    """
    scale = float(10**digits)
    return F.floor(c * scale + 0.5) / F.lit(scale)
