"""Date and time expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(col: Column, formats: Sequence[str]) -> Column:
    """First layout that fits; text that fits none gives null."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in formats])


def parse_date(col: Column, formats: Sequence[str]) -> Column:
    return parse_timestamp(col, formats).cast("date")


def date_parts(col: Column, prefix: str = "") -> list[Column]:
    """Year, month, day, hour, minute and day of week (Monday = 0)."""
    return [
        F.year(col).alias(f"{prefix}year"),
        F.month(col).alias(f"{prefix}month"),
        F.dayofmonth(col).alias(f"{prefix}day"),
        F.hour(col).alias(f"{prefix}hour"),
        F.minute(col).alias(f"{prefix}minute"),
        F.weekday(col).alias(f"{prefix}dayofweek"),
    ]


def month_name(col: Column) -> Column:
    return F.date_format(col, "MMMM")


def iso_week(col: Column) -> Column:
    return F.weekofyear(col)


def year_month(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def quarter_label(col: Column) -> Column:
    """``YYYY/0Q``."""
    return F.concat(F.year(col).cast("string"), F.lit("/0"), F.quarter(col).cast("string"))


def drop_zone(col: Column) -> Column:
    """Wall-clock time without a zone."""
    return col.cast("timestamp_ntz")


def to_day(col: Column) -> Column:
    return F.to_date(col)


def shift_days(col: Column, days: int) -> Column:
    return F.date_add(col, days)


def weekday(col: Column) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(col)


def week_ending_sunday(col: Column) -> Column:
    """The Sunday that closes the week; a Sunday is its own label."""
    return F.next_day(F.date_sub(F.to_date(col), 1), "Sun")


def week_starting_monday(col: Column) -> Column:
    return F.to_date(F.date_trunc("week", col))


def month_end(col: Column) -> Column:
    return F.last_day(col)


def month_start(col: Column) -> Column:
    return F.to_date(F.date_trunc("month", col))


def warm_season(col: Column, first_month: int = 5, last_month: int = 10) -> Column:
    """1 from May to October, else 0."""
    return F.month(col).between(first_month, last_month).cast("int")


def iso_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")
