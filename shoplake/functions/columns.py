"""Column-level helpers shared by the operators.

Money is summed as DECIMAL(28,2) and turned into DOUBLE only at the end, so
sums do not depend on the order in which partitions are merged.  Ratios are
DOUBLE divisions rounded half-up, with ``try_divide`` so a zero denominator
gives NULL instead of an ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DecimalType, StringType, TimestampNTZType,
                               TimestampType)

MONEY = DecimalType(28, 2)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(c) -> Column:
    """Exact two-place decimal; text that is no number, or 1e26 and more, becomes NULL (never raises).

    ``clean.rejected_orders`` counts the numbers that do not fit.
    """
    return col_(c).try_cast(MONEY)


def to_double(c) -> Column:
    return col_(c).try_cast("double")


def money_sum(c) -> Column:
    """Order-independent money sum as DOUBLE."""
    return F.sum(to_money(c)).cast("double")


def money_avg(c, scale: int = 2) -> Column:
    """Mean of a money column, rounded half-up; NULLs are skipped as in ``avg``."""
    return F.round(F.try_divide(money_sum(c), F.count(col_(c))), scale)


def percent(num, den, scale: int = 1) -> Column:
    """``round(num / den * 100, scale)``; NULL when ``den`` is 0."""
    return F.round(F.try_divide(col_(num), col_(den)) * F.lit(100), scale)


def to_date_safe(c, data_type=None) -> Column:
    """DATE from a DATE, TIMESTAMP(_NTZ) or text column; bad text -> NULL."""
    c = col_(c)
    if isinstance(data_type, DateType):
        return c
    if isinstance(data_type, (TimestampType, TimestampNTZType)):
        return F.to_date(c)
    if data_type is None or isinstance(data_type, StringType):
        return F.try_to_date(c.cast("string"))
    return F.to_date(c)


def month_key(c) -> Column:
    """'yyyy-MM' of a date (the reference takes the first 7 characters)."""
    return F.date_format(col_(c), "yyyy-MM")
