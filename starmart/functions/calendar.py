"""Date parts with Postgres meaning (X-3 … X-8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.columns import as_col

# to_char(d, 'Month') / to_char(d, 'Day') blank-pad the name to 9 characters.
NAME_WIDTH = 9


def day_of(ts) -> Column:
    """``ts::date``."""
    return as_col(ts).cast("date")


def iso_week(d) -> Column:
    """``extract(week)``: ISO-8601 week number (2023-01-01 is week 52)."""
    return F.weekofyear(as_col(d))


def dow_sunday0(d) -> Column:
    """``extract(dow)``: Sunday = 0 … Saturday = 6."""
    return F.dayofweek(as_col(d)) - 1


def month_name(d) -> Column:
    return F.rpad(F.date_format(as_col(d), "MMMM"), NAME_WIDTH, " ")


def day_name(d) -> Column:
    return F.rpad(F.date_format(as_col(d), "EEEE"), NAME_WIDTH, " ")
