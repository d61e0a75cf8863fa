"""Money arithmetic.

Amounts arrive as doubles. Summing doubles gives results that depend on task
order; summing fixed-point decimals does not, so every sales figure is
accumulated as DECIMAL with six decimals and turned into a double only at the
edge: what was sent is not rounded to cents on the way.

An amount that is not a number or not below ``LARGEST`` in size is no amount:
it counts as null instead of stopping the job, and ``odd_amount`` marks it for
the jobs' counts. Sums of such bounded amounts can't leave the accumulator
(2e16 rows of the largest would be needed).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(22,6)"
LARGEST = 1e15


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def odd_amount(col: str | Column) -> Column:
    """True for an amount that is there but can't be counted."""
    c = _c(col)
    return F.coalesce(c.isNotNull() & ~(F.abs(c) < F.lit(LARGEST)) | F.isnan(c), F.lit(False))


def to_money(col: str | Column) -> Column:
    c = _c(col)
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)), c.try_cast(MONEY))


def money_out(col: str | Column) -> Column:
    """A decimal accumulator as the double the serving tables store."""
    return _c(col).cast("double")
