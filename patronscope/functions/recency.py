"""Days and the time since them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An average month of 30.44 days, in seconds; the text form of a day.
SECONDS_PER_MONTH = 30.44 * 24 * 60 * 60
DAY_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}\z"


def purchase_day(text: Column) -> Column:
    """Text such as ``2023-10-05`` as a date; NULL where it is not a day.

    A cast alone would also take a bare year or a time of day, so the form is checked
    first; together that is cheaper than parsing by a date pattern.
    """
    return F.when(text.rlike(DAY_PATTERN), text.try_cast("date"))


def months_between_days(day: Column, as_of: Column) -> Column:
    """Average months from the start of ``day`` to the moment ``as_of``."""
    seconds = F.unix_timestamp(as_of) - F.unix_timestamp(day.cast("timestamp"))
    return seconds / F.lit(SECONDS_PER_MONTH)
