"""Date column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import col as _c


def lenient_date(c, dtype: T.DataType | None = None) -> Column:
    """parse text leniently to DATE (bad -> null); typed values are truncated to midnight."""
    x = _c(c)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return x.cast("date")
    return F.to_date(F.try_to_timestamp(F.trim(x.cast("string"))))


def lenient_date_of(df: DataFrame, name: str) -> Column:
    """F08 choosing the parse from the column's declared type."""
    return lenient_date(name, df.schema[name].dataType)


def year_month(c) -> Column:
    """``yyyy-MM`` text (null date -> null)."""
    return F.date_format(_c(c), "yyyy-MM")


def day_name(c) -> Column:
    """F11."""
    return F.date_format(_c(c), "EEEE")


def month_name(c) -> Column:
    """F11."""
    return F.date_format(_c(c), "MMMM")


def is_weekend(c) -> Column:
    """Saturday or Sunday (null date -> null)."""
    return F.dayofweek(_c(c)).isin(1, 7)


def age_years(reference, start) -> Column:
    """whole days between two dates / 365.25, rounded half-even to 2 dp."""
    from .numeric import round_even
    days = F.datediff(_c(reference), _c(start)).cast("double")
    return round_even(days / F.lit(365.25), 2)


def calendar_parts(df: DataFrame, date_col: str = "date") -> DataFrame:
    """F09-F13 derived columns for a dated row."""
    d = F.col(date_col)
    return (df.withColumn("day_of_week", day_name(d))
              .withColumn("month", F.month(d))
              .withColumn("year", F.year(d))
              .withColumn("year_month", year_month(d))
              .withColumn("is_weekend", is_weekend(d)))
