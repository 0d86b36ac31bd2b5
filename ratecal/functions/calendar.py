"""Calendar arithmetic. Everything works on dates, so no result depends on the session zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def weekday(when) -> Column:
    """Day of week with 0 for Sunday (Spark's own numbering starts at 1)."""
    return F.dayofweek(F.to_date(when)) - 1


def week_of(when) -> Column:
    """The Monday on or before a date."""
    return F.trunc(F.to_date(when), "week")


def month_of(when) -> Column:
    return F.trunc(F.to_date(when), "month")


def whole_days_ahead(stay, created) -> Column:
    """Full 24-hour days from a scrape time to the midnight a stay begins, rounded down."""
    day = F.to_date(created)
    past_midnight = F.col(created) > day.cast("timestamp_ntz")
    return F.datediff(F.col(stay), day) - past_midnight.cast("int")


def date_literal(value) -> Column:
    return F.lit(value).cast("date")
