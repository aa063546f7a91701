"""Date arithmetic. Two month lengths occur and must never be mixed up.

An *average* month is a fixed number of days; a *calendar* month shifts the
month number and clamps to the end of the month.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days in an average month and an average year.
AVG_MONTH_DAYS = 30.436875
AVG_YEAR_DAYS = 365.2425


def avg_months_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier) / F.lit(AVG_MONTH_DAYS)


def whole_years_between(later: Column, earlier: Column) -> Column:
    return (F.datediff(later, earlier) / F.lit(AVG_YEAR_DAYS)).cast("int")


def add_calendar_months(date: Column, months: Column | int) -> Column:
    return F.add_months(date, months)


def parse_iso_date(text: Column) -> Column:
    """yyyy-MM-dd to date; blanks, zero dates and nonsense become NULL.

    Blanks aren't parsed, as a failed parse costs far more than one that succeeds.
    """
    whole = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z")
    return F.when(whole, text.try_cast("date")).when(text != "", F.try_to_date(text, "y-M-d"))


def slash_date(text: Column) -> Column:
    """Year from characters 1-4, month and day from the digits around the first '/'."""
    year = F.substring(text, 1, 4)
    month = F.regexp_extract(text, r"^[^/]*?(\d{2})/", 1)
    day = F.regexp_extract(text, r"^[^/]*/(\d{2})", 1)
    return parse_iso_date(F.concat_ws("-", year, month, day))
