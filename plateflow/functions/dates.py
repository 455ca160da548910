"""Calendar helpers. Every operator takes its own ``as_of``; nothing reads the clock."""

from __future__ import annotations

import calendar
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F


def month_of(value: Column) -> Column:
    """First day of the month as a date."""
    return F.trunc(value.cast("date"), "month")


def sunday_zero(value: Column) -> Column:
    """Day of the week with Sunday = 0."""
    return (F.dayofweek(value.cast("date")) - 1).cast("int")


def day_name(value: Column) -> Column:
    return F.date_format(value.cast("date"), "EEEE")


DAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def day_label(dow: Column) -> Column:
    """Name of a weekday number (Sunday = 0); cheaper after an aggregation than formatting every row."""
    return F.element_at(F.array(*[F.lit(d) for d in DAYS]), dow + 1)


def month_label(value: Column) -> Column:
    return F.date_format(value.cast("date"), "yyyy-MM")


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole months between two month starts."""
    return ((F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)).cast("int")


def seconds_between(start: Column, end: Column) -> Column:
    """``end - start`` in seconds with microseconds, independent of the session time zone."""

    def of_day(ts: Column) -> Column:
        whole = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("decimal(10,0)")
        return whole + F.date_part(F.lit("SECOND"), ts)

    days = F.datediff(end.cast("date"), start.cast("date")).cast("decimal(10,0)") * F.lit(86400)
    return (days + of_day(end) - of_day(start)).cast("decimal(20,6)")


def first_of_month(day: date) -> date:
    return day.replace(day=1)


def shift_months(day: date, months: int) -> date:
    """Same day ``months`` later, clipped to the end of that month."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    return date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


def days_before(day: date, days: int) -> date:
    return day - timedelta(days=days)


def between_dates(df: DataFrame, since: date | None, until: date | None, column: str = "order_date",
                  month: str = "order_month") -> DataFrame:
    """Keep ``since <= column < until``; the month partition gets the same bounds so files are pruned."""
    partitioned = month in df.columns
    if since is not None:
        df = df.filter(F.col(column) >= F.lit(since))
        if partitioned:
            df = df.filter(F.col(month) >= F.lit(first_of_month(since)))
    if until is not None:
        df = df.filter(F.col(column) < F.lit(until))
        if partitioned:
            df = df.filter(F.col(month) < F.lit(until))
    return df


def between_months(df: DataFrame, since: date | None, until: date | None, month: str) -> DataFrame:
    """Keep the months that ``since <= day < until`` touches."""
    if since is not None:
        df = df.filter(F.col(month) >= F.lit(first_of_month(since)))
    return df if until is None else df.filter(F.col(month) < F.lit(until))
