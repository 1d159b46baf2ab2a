"""Dates and times (CLN14-CLN18, MEA6-MEA7).

Spark has no usable TIME type by default, so a time of day is 'HH:mm:ss' text.
Differences in years and months count calendar boundaries, not full periods.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillhouse.functions.text import blank

# Formats of the raw extracts.
ID_DATE = r"TXN(\d{8})"
CLOCK = r"^\d{2}:\d{2}:\d{2}$"
MIDNIGHT = "00:00:00"
LAST_SECOND = "23:59:59"


def safe_date(c: Column) -> Column:
    """CLN14: blank or unparsable text becomes NULL."""
    text = c.cast("string")
    return F.when(~blank(text), text).try_cast("date")


def date_in_id(txn_id: Column) -> Column:
    """The day coded in a transaction id."""
    return F.try_to_date(F.regexp_extract(txn_id, ID_DATE, 1), "yyyyMMdd")


def date_or_from_id(date: Column, txn_id: Column) -> Column:
    """CLN15: fall back to the id only when the date is missing."""
    text = date.cast("string")
    return F.when(blank(text), date_in_id(txn_id)).otherwise(text.try_cast("date"))


def valid_time(time: Column) -> Column:
    """A well-formed clock text, else NULL."""
    inside = (F.substring(time, 1, 2) < "24") & (F.substring(time, 4, 2) < "60") & (F.substring(time, 7, 2) < "60")
    return F.when(time.rlike(CLOCK) & inside, time)


def time_or_midnight(time: Column) -> Column:
    """CLN16."""
    return F.when(blank(time), F.lit(MIDNIGHT)).otherwise(valid_time(time))


def compose_datetime(date: Column, time: Column, txn_id: Column) -> Column:
    """CLN17: date plus time; the id's midnight when either is missing."""
    text = date.cast("string")
    at = F.concat_ws(" ", text.try_cast("date").cast("string"), valid_time(time))
    missing = blank(text) | blank(time)
    return F.when(missing, date_in_id(txn_id).cast("timestamp_ntz")).otherwise(at.try_cast("timestamp_ntz"))


def weekday(date: Column) -> Column:
    """Sunday is 0."""
    return F.dayofweek(date) - 1


def hour_of(time: Column) -> Column:
    """CLN18: NULL when the time is missing."""
    return F.substring(valid_time(time), 1, 2).cast("int")


def date_parts(date: Column, time: Column) -> dict[str, Column]:
    """CLN18: calendar parts of a cleaned date."""
    return {
        "transaction_year": F.year(date),
        "transaction_month": F.month(date),
        "transaction_day": F.day(date),
        "transaction_day_of_week": weekday(date),
        "transaction_hour": hour_of(time),
    }


def time_or_last_second(time: Column) -> Column:
    """CLN25: live events without a time sort to the end of the day."""
    return F.coalesce(time, F.lit(LAST_SECOND))


def years_between(start: Column, end: Column) -> Column:
    """MEA6: year boundaries crossed."""
    return F.year(end) - F.year(start)


def months_between_boundaries(start: Column, end: Column) -> Column:
    """MEA6: month boundaries crossed."""
    return years_between(start, end) * 12 + F.month(end) - F.month(start)


def days_since(start: Column, today: Column) -> Column:
    """MEA6: days elapsed; NULL for a start in the future."""
    return F.when(start <= today, F.datediff(today, start))


def rounded_years(days: Column) -> Column:
    """MEA6: whole years at 365.25 days each."""
    return F.round(days.cast("double") / 365.25, 0)


def date_key(date: Column) -> Column:
    """MEA7: yyyymmdd as an integer."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.day(date)


def utc_instant(clock: Column) -> Column:
    """A wall-clock time read as UTC, whatever the session's time zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), clock).cast("timestamp")


def utc_clock(instant: Column) -> Column:
    """The UTC wall-clock time of an instant, whatever the session's time zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))
