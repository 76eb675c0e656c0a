"""Dates, numbers and references read out of text. Nothing raises: what cannot be read is null."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions.fixed_values import CELL_ROW_PATTERN, DATE_PATTERNS, DOCUMENT_NUMBER_PATTERN, NUMBER_PATTERN
from gridloom.functions.text import strip


def parse_date(c: Column, years: str = "20|19", within: int | None = None, bounded: bool = False) -> Column:
    """The first year-month-day in a text; null if there is none or it is no day of the calendar.

    ``years`` lists the centuries (``20|19`` or ``20``), ``within`` reads only so many code points, ``bounded`` refuses a
    digit before the year.
    """
    text = F.substring(c, 1, within) if within else c
    part = lambda i: F.regexp_extract(text, DATE_PATTERNS[years, bounded], i)
    return F.to_date(F.try_to_timestamp(F.concat_ws("-", F.nullif(part(1), F.lit("")), F.nullif(part(2), F.lit("")), F.nullif(part(3), F.lit(""))), F.lit("yyyy-M-d")))


def first_int(c: Column) -> Column:
    return F.regexp_substr(c, F.lit(r"\d+")).try_cast("bigint")


def cell_row(c: Column) -> Column:
    """The row of a cell reference (``AB12``) or of a row locator (``ROW:12``)."""
    return F.nullif(F.regexp_extract(c, CELL_ROW_PATTERN, 1), F.lit("")).try_cast("bigint")


def measure(c: Column) -> Column:
    """struct(value, unit, currency): the first number of a text, thousands separators left out."""
    number = F.nullif(F.regexp_extract(F.replace(c, F.lit(","), F.lit("")), NUMBER_PATTERN, 1), F.lit("")).try_cast("double")
    unit = F.when(F.contains(c, F.lit("%")), "%").when(F.contains(c, F.lit("万")), "万元")
    return F.struct(number.alias("value"), unit.alias("unit"), F.when(unit == "万元", "CNY").alias("currency"))


def document_number(c: Column, within: int = 5000) -> Column:
    return F.regexp_substr(F.substring(c, 1, within), F.lit(DOCUMENT_NUMBER_PATTERN))


def days_apart(a: Column, b: Column) -> Column:
    return F.abs(F.datediff(a, b))


def overlap_window(c: Column, today: dt.date, days: int) -> Column:
    """Whether a date is in the last ``days`` days, today included: what an incremental run reads again."""
    return c.between(F.lit(today - dt.timedelta(days=days)), F.lit(today))


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")
