"""Dates that arrive as dates, timestamps or ``yyyy-MM-dd`` text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text form of a date and of a month.
DATE_TEXT = "yyyy-MM-dd"
MONTH_TEXT = "yyyy-MM"
PLAIN_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def parse_date(text: Column | str) -> Column:
    """Text to date; null when the text is no date.

    A cast reads a text of four, two and two digits at a fraction of the
    pattern's cost, and as the same date; the pattern is left the others.
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(PLAIN_DATE), text.try_cast("date")).otherwise(F.try_to_date(text, DATE_TEXT))


def date_text(date: Column) -> Column:
    """A date as its cast to text writes it; put together from its number, if the year has four digits."""
    number = (F.year(date) * 10_000 + F.month(date) * 100 + F.day(date)).cast("string")
    parts = [F.substring(number, start, length) for start, length in ((1, 4), (5, 2), (7, 2))]
    return F.when(F.year(date).between(1000, 9999), F.concat_ws("-", *parts)).otherwise(date.cast("string"))


def date_of(frame: DataFrame, name: str) -> Column:
    """The column as a date, whatever type the table stores it in."""
    kind = frame.schema[_actual(frame, name)].dataType
    if isinstance(kind, T.StringType):
        return parse_date(F.col(name))
    return F.col(name).cast("date")


def in_years(frame: DataFrame, name: str, first: int, last: int) -> Column:
    """Membership in a run of years, as a range on the stored column.

    A range on the bare column reaches the Parquet scan, where ``year(col)``
    would not, so row groups outside the years are skipped.
    """
    kind = frame.schema[_actual(frame, name)].dataType
    start, end = f"{first}-01-01", f"{last + 1}-01-01"
    if isinstance(kind, T.StringType):
        # text of the form yyyy-MM-dd sorts like the dates it stands for
        plausible = (F.col(name) >= start) & (F.col(name) < end)
        return plausible & parse_date(F.col(name)).isNotNull()
    return (F.col(name) >= F.lit(start).cast(kind)) & (F.col(name) < F.lit(end).cast(kind))


def month_label(date: Column) -> Column:
    return F.date_format(date, MONTH_TEXT)


def days_between(end: Column, start: Column) -> Column:
    """Whole days from start to end; negative when end is earlier."""
    return F.datediff(end, start)


def _actual(frame: DataFrame, name: str) -> str:
    return next(c for c in frame.columns if c.lower() == name.lower())
