"""Numeric coercion with pandas-compatible missing-value semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Text that reads as a number: digits with an optional point and exponent, or a name of infinity or "not a number".
#: A plain cast would also take Java's literals (``12D``, ``5F``, ``0x1p3``).
NUMBER_RE = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$|^\s*[+-]?(?i:inf|infinity|nan)\s*$"
INT_RE = r"^[+-]?[0-9]+$"
#: Codes such as ``0123``: digits whose leading zero a number would lose.
PADDED_RE = r"^[+-]?0[0-9]+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c, already_double: bool = False) -> Column:
    """``pd.to_numeric(errors='coerce')``: bad text -> NULL, and NaN -> NULL.

    ``try_cast('nan' as double)`` yields NaN, which Spark does not treat as
    missing, so NaN is mapped to NULL explicitly. ``already_double`` skips
    the cast when the column is known to be double.
    """
    x = _c(c) if already_double else F.when(_c(c).cast("string").rlike(NUMBER_RE), _c(c).try_cast("double"))
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def is_true(cond: Column) -> Column:
    """A predicate where a missing operand counts as False (pandas ``NaN > x``)."""
    return F.coalesce(cond, F.lit(False))


def not_equal_or_missing(a: Column, b: Column) -> Column:
    """``a != b`` where a missing operand counts as unequal (pandas ``NaN != x``)."""
    return F.coalesce(a != b, F.lit(True))


def to_long(c) -> Column:
    """Whole numbers exactly (no detour through double); other numbers by truncation, if they fit; else NULL."""
    exact = F.when(_c(c).cast("string").rlike(INT_RE), _c(c).try_cast("bigint"))
    return F.coalesce(exact, to_number(c).try_cast("bigint"))
