"""Date parsing and day arithmetic."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The accepted date form (fixed value).
ISO_DATE = "yyyy-MM-dd"
#: Other forms seen in the sources (fixed values); accepted only on request.
OTHER_DATES = ("dd/MM/yyyy", "MM-dd-yyyy", "yyyyMMdd")


def parse_date(text: Column, formats: Sequence[str] = (ISO_DATE,)) -> Column:
    """The date in the first format that fits, else NULL; never an error."""
    return F.coalesce(*[F.try_to_date(text, fmt) for fmt in formats])


def midnight(day: Column) -> Column:
    """The start of ``day`` as a timestamp without zone."""
    return day.cast("timestamp_ntz")


def days_since(day: Column, as_of: Column) -> Column:
    """Whole days from ``day`` to ``as_of``."""
    return F.datediff(as_of, day)


def date_value(day: date | str) -> Column:
    """A date parameter such as ``as_of``; runs never read the clock themselves."""
    return F.lit(str(day)).cast("date")


def time_value(moment: datetime | str) -> Column:
    """A time parameter such as ``run_ts``."""
    return F.lit(str(moment)).cast("timestamp_ntz")
