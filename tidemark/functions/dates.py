"""Dates, session markers and the trading calendar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exchange sessions in local time, as seconds of the day.
MORNING_OPEN = 9 * 3600
MORNING_CLOSE = 11 * 3600 + 30 * 60
AFTERNOON_OPEN = 13 * 3600 + 30 * 60
AFTERNOON_CLOSE = 15 * 3600

# Sessions that a day's keys tell apart: none, first, second.
SESSIONS = 3

EXCHANGE_ZONE = "Asia/Ho_Chi_Minh"

_DAY = r"\d{4}-\d{2}-\d{2}"


def date_part_of(key: Column) -> Column:
    """First ``YYYY-MM-DD`` in the text as a DATE; NULL where there is none."""
    return F.regexp_extract(key, _DAY, 0).try_cast("date")


def session_part_of(key: Column) -> Column:
    """1 or 2 for a marked key (the first marker of the two wins as 1), else 0."""
    return (
        F.when(key.contains("(1)"), 1)
        .when(key.contains("(2)"), 2)
        .when(key.isNotNull(), 0)
    )


def canonical_key(key: Column) -> Column:
    """The date text rewritten as ``YYYY-MM-DD`` plus its marker, NULL without a date."""
    mark = F.when(key.contains("(1)"), "(1)").when(key.contains("(2)"), "(2)").otherwise("")
    return F.concat(date_part_of(key).cast("string"), mark)


def key_number(key: Column) -> Column:
    """``canonical_key`` as a number of the same order."""
    return F.unix_date(date_part_of(key)) * SESSIONS + session_part_of(key)


def session_key(trade_date: Column, session: Column) -> Column:
    """The text form ``YYYY-MM-DD`` plus ``(1)``/``(2)``; sorts as (date, session)."""
    mark = F.when(session == 1, "(1)").when(session == 2, "(2)").otherwise("")
    return F.concat(trade_date.cast("string"), mark)


def strip_marker(key: Column) -> Column:
    """Drop a trailing ``(n)`` and read what is left as a date or a timestamp."""
    text = F.regexp_replace(key, r"\(\d+\)$", "")
    return F.coalesce(text.try_cast("date"), text.try_cast("timestamp").cast("date"))


def second_of_day(ts: Column) -> Column:
    """Seconds since local midnight with microseconds kept (DECIMAL)."""
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts)


def local_time(ts: Column, zone: str = EXCHANGE_ZONE) -> Column:
    """Wall-clock time at the exchange for a UTC instant."""
    return F.from_utc_timestamp(ts, zone)


def session_of(ts: Column) -> Column:
    """1 from the morning open up to the afternoon open, 2 at any other time."""
    second = second_of_day(ts)
    return F.when(
        (second >= MORNING_OPEN) & (second < AFTERNOON_OPEN), 1
    ).otherwise(2)


def in_session(ts: Column) -> Column:
    """True inside either session; both ends count, to the microsecond."""
    second = second_of_day(ts)
    return second.between(MORNING_OPEN, MORNING_CLOSE) | second.between(
        AFTERNOON_OPEN, AFTERNOON_CLOSE
    )


def wall_clock_micros(ts: Column) -> Column:
    """Microseconds of the wall-clock reading, whatever the session time zone."""
    second = second_of_day(ts)
    return F.unix_date(F.to_date(ts)) * F.lit(86_400_000_000) + (
        second * F.lit(1_000_000)
    ).cast("bigint")


def trading_days(as_of: Column, count: int) -> Column:
    """The next ``count`` weekdays after ``as_of`` as an array of dates."""
    # Twice the count plus four calendar days always hold that many weekdays.
    days = F.sequence(F.date_add(as_of, 1), F.date_add(as_of, 2 * count + 4))
    return F.slice(F.filter(days, lambda day: F.weekday(day) < 5), 1, count)


def next_trading_day(as_of: Column) -> Column:
    return trading_days(as_of, 1)[0]
