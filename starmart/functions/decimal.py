"""Exact numeric aggregates with Postgres ``ROUND(numeric, n)`` semantics (X-9, X-10).

Spark's decimal ``round`` is HALF_UP (ties away from zero), as is Postgres'
numeric round. Averages and ratios are divided as whole numbers, quotient and
remainder, so a tie such as 50.005 rounds the same way every time and nothing
is rounded twice.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.columns import as_col

RESULT_MONEY = "decimal(38,2)"


def round_sum(c, scale: int = 2) -> Column:
    """``ROUND(SUM(c)::numeric, scale)``."""
    return F.round(F.sum(as_col(c)), scale).cast(f"decimal(38,{scale})")


def _rounded_quotient(num: Column, den: Column, scale: int) -> Column:
    """``num / den`` for whole ``decimal(38,0)`` numbers, ``num`` in units of
    10**-scale: quotient and remainder decide, half away from zero, and no
    intermediate result is rounded. NULL for a zero or NULL denominator. The
    quotient has to fit 64 bits: the average of any decimal(18, n) column does."""
    q = F.call_function("div", F.abs(num), den).cast("decimal(38,0)")
    r = F.abs(num) - q * den
    up = F.when(r * 2 >= den, F.lit(1)).otherwise(F.lit(0))
    whole = (q + up).cast("decimal(38,0)") * F.when(num < 0, F.lit(-1)).otherwise(F.lit(1))
    unit = F.lit(Decimal(1).scaleb(-scale)).cast(f"decimal({scale + 1},{scale})")
    return F.when(den > 0, (whole.cast(f"decimal({38 - scale},0)") * unit).cast(f"decimal(38,{scale})"))


def exact_avg(c, scale: int = 2, digits: int = 4) -> Column:
    """``ROUND(AVG(c)::numeric, scale)`` over decimals; NULL when no value.

    ``digits`` is at least the column's number of fractional digits (staged
    amounts have four); the sum is kept exactly and divided as whole numbers.
    """
    return exact_quotient(F.sum(as_col(c)), F.count(as_col(c)), scale, digits)


def exact_quotient(total: Column, count: Column, scale: int = 2, digits: int = 4) -> Column:
    """``ROUND(total::numeric / count, scale)`` of a sum and its number of values,
    for averages whose parts were added up before."""
    # in units of the result: a sum of finer units divides by that much more
    up, down = 10 ** max(scale - digits, 0), 10 ** max(digits - scale, 0)
    units = (total.cast(f"decimal(38,{digits})") * F.lit(Decimal(10) ** digits)).cast("decimal(38,0)") * F.lit(up).cast("decimal(10,0)")
    parts = count.cast("decimal(20,0)") * F.lit(down).cast("decimal(10,0)")
    return _rounded_quotient(units.cast("decimal(38,0)"), parts.cast("decimal(38,0)"), scale)


def exact_ratio(num: Column, den: Column, scale: int = 1) -> Column:
    """``ROUND(num::numeric / den, scale)`` for integer counts."""
    units = num.cast("decimal(20,0)") * F.lit(10 ** scale).cast("decimal(10,0)")
    return _rounded_quotient(units.cast("decimal(38,0)"), den.cast("decimal(38,0)"), scale)
