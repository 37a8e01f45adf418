"""New York wall-clock time and time selection.

Columns of type TIMESTAMP are instants and are converted; TIMESTAMP_NTZ columns are taken as New York wall clock already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NEW_YORK = "America/New_York"
#: First and last minute of the sessions, both inclusive.
REGULAR = ("09:30:00", "16:00:00")


def ny_wall(df: DataFrame, name: str) -> Column:
    """New York wall clock (TIMESTAMP_NTZ) of a timestamp column."""
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.convert_timezone(None, F.lit(NEW_YORK), F.col(name).cast("timestamp_ntz"))
    return F.col(name).cast("timestamp_ntz")


def ny_date(df: DataFrame, name: str) -> Column:
    """New York trading date."""
    return F.to_date(ny_wall(df, name))


def second_of_day(wall: Column) -> Column:
    return F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall)


def seconds_of(clock: str) -> int:
    h, m, s = (int(x) for x in clock.split(":"))
    return h * 3600 + m * 60 + s


def session_filter(df: DataFrame, name: str = "window_start", session: tuple[str, str] = REGULAR) -> DataFrame:
    """Rows inside a session of the New York day, both ends inclusive."""
    wall = ny_wall(df, name)
    return df.filter(F.date_format(wall, "HH:mm:ss.SSSSSS").between(session[0] + ".000000", session[1] + ".000000"))


def seconds(n: Column | int) -> Column:
    """A day-time interval of so many seconds."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n if isinstance(n, Column) else F.lit(n))


def interval_bin(wall: Column, size: int) -> Column:
    """Start of the interval of ``size`` seconds, counted from local midnight, that a wall-clock time falls in."""
    return F.date_trunc("day", wall).cast("timestamp_ntz") + seconds(F.floor(second_of_day(wall) / F.lit(size)) * size)


def recent_days(df: DataFrame, n: int, date_col: str = "date") -> DataFrame:
    """The dates from n calendar days before the latest one on, both ends inclusive. The latest date is a scalar subquery."""
    latest = df.select(F.max(date_col)).scalar()
    return df.filter(F.col(date_col) >= F.date_sub(latest, n))


def date_range(df: DataFrame, start: str | None, end: str | None, date_col: str = "date") -> DataFrame:
    """Dates between two ends, both inclusive; give both or neither."""
    if (start is None) != (end is None):
        raise ValueError("give both ends of the range or neither")
    return df if start is None else df.filter(F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def latest_date(df: DataFrame, date_col: str = "date") -> DataFrame:
    """The rows of the latest date."""
    return df.filter(F.col(date_col) == df.select(F.max(date_col)).scalar())


def parse_event_ts(text: Column) -> Column:
    """An event's time: unix seconds, else ISO text taken as UTC; null where it is neither. The result is New York wall clock (NTZ)."""
    iso = F.try_to_timestamp(F.regexp_replace(text, r"(Z|[+-]00:?00)$", ""))
    unix = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), text.try_cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(NEW_YORK), F.coalesce(unix, iso.cast("timestamp_ntz")))


def parse_press_time(text: Column) -> Column:
    """``Mar 18, 2024 5:58PM EDT`` as UTC wall clock (NTZ): EDT is 4 hours behind, EST 5; null if it isn't such a time."""
    up = F.upper(text)
    clock = F.regexp_extract(up, r"^\s*([A-Z]{3} \d{1,2}, \d{4} \d{1,2}:\d{2})\s*([AP]M) (EDT|EST)\s*$", 1)
    half = F.regexp_extract(up, r"([AP]M) (EDT|EST)\s*$", 1)
    zone = F.regexp_extract(up, r"(EDT|EST)\s*$", 1)
    named = F.concat(F.initcap(F.lower(clock)), F.lit(" "), half)
    local = F.try_to_timestamp(named, F.lit("MMM d, yyyy h:mm a")).cast("timestamp_ntz")
    return F.when(clock != "", local + seconds(F.when(zone == "EDT", 4 * 3600).otherwise(5 * 3600)))
