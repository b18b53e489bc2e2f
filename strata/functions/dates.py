"""Calendar expressions of the model layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(c) -> Column:
    """Timestamp to its calendar date."""
    return F.to_date(_col(c))


def day_diff(end, start) -> Column:
    """Whole days from ``start`` to ``end`` (negative when ``end`` is earlier);
    NULL when either side is NULL."""
    return F.datediff(day(end), day(start)).cast("int")


def iso_day_of_week(d) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(_col(d)) + 1).cast("smallint")


def calendar_columns(d) -> list[Column]:
    """The descriptive columns of the date dimension for date column ``d``."""
    d = _col(d)
    dow = iso_day_of_week(d)
    return [
        F.year(d).cast("smallint").alias("year"),
        F.month(d).cast("smallint").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).cast("smallint").alias("quarter"),
        F.dayofmonth(d).cast("smallint").alias("day"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
        dow.isin(6, 7).alias("is_weekend"),
    ]


def rounded_mean(c) -> Column:
    """Mean of a small integer, rounded half away from zero, as smallint."""
    return F.round(F.avg(_col(c))).cast("smallint")


def exact_money_mean(c) -> Column:
    """Mean of decimal(10,2) money, rounded half away from zero to cents.

    ``avg`` on decimals keeps only 4 extra digits and can round twice
    (0.0049999.. -> 0.0050 -> 0.01); dividing the exact decimal sum by the
    count keeps 20 fractional digits before the single rounding to cents.
    NULL when there is no value.
    """
    c = _col(c)
    return F.round(F.sum(c) / F.count(c), 2).cast("decimal(10,2)")
