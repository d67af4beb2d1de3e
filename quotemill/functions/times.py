"""Dates, clocks and sessions. Market time has no zone: TIMESTAMP_NTZ throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotemill.functions import as_column
from quotemill.functions.texts import ascii_only

NTZ = "timestamp_ntz"

# Single-letter fields accept both "3/4/2025" and "03/04/2025".
DAY_FIRST = "d/M/yyyy"
MONTH_FIRST = "M/d/yyyy"
MONTH_NAME = "MMM d, yyyy"
PACKED = "yyyyMMddHHmmss"
STAMP = "yyyy-MM-dd HH:mm:ss"
ISO_DAY = "yyyy-MM-dd"

# Request periods and the days each covers.
PERIOD_DAYS = {
    "1d": 1,
    "5d": 5,
    "1mo": 30,
    "3mo": 90,
    "6mo": 180,
    "1y": 365,
    "2y": 730,
    "5y": 1825,
    "10y": 3650,
}
PERIOD_ALL = "max"


# The shape of each pattern. A text of another shape cannot match; looking first spares the exception
# the parser would raise, and the second look Spark takes after one.
_SHAPES = {
    DAY_FIRST: r"^\d{1,2}/\d{1,2}/\d{4}$",
    MONTH_FIRST: r"^\d{1,2}/\d{1,2}/\d{4}$",
    MONTH_NAME: r"^[A-Za-z]{3,4} \d{1,2}, \d{4}$",
    PACKED: r"^\d{14}$",
    STAMP: r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
}


def parse_time(text, pattern: str) -> Column:
    """Text by pattern, null when it does not match."""
    text = as_column(text)
    if pattern in _SHAPES:
        text = F.when(text.rlike(_SHAPES[pattern]), text)
    return F.try_to_timestamp(text, F.lit(pattern)).cast(NTZ)


def parse_date(text, pattern: str) -> Column:
    return parse_time(text, pattern).cast("date")


def epoch_seconds(number) -> Column:
    """Seconds since 1970 in UTC."""
    return F.timestamp_seconds(as_column(number)).cast(NTZ)


def epoch_millis(number) -> Column:
    return F.timestamp_millis(as_column(number).cast("bigint")).cast(NTZ)


def to_epoch_seconds(time) -> Column:
    return F.unix_seconds(as_column(time).cast("timestamp"))


def shift_seconds(time, seconds) -> Column:
    """A time moved by seconds; zone offsets are not always whole hours."""
    zero = F.lit(0)
    return as_column(time) + F.make_dt_interval(zero, zero, zero, as_column(seconds).cast("decimal(18,6)"))


def shift_hours(time, hours: float) -> Column:
    return shift_seconds(time, F.lit(hours * 3600))


def zone_shift(time, gmtoffset, hour_adjust: float = 0, signed: bool = False) -> Column:
    """Exchange-local time from UTC.

    A positive offset (seconds) is used; otherwise ``hour_adjust`` is, unless ``signed`` asks for
    negative offsets to count as well.
    """
    offset = as_column(gmtoffset)
    use = offset.isNotNull() if signed else offset > 0
    return shift_seconds(time, F.when(use, offset).otherwise(F.lit(hour_adjust * 3600)))


def standardize_datetime(text, zone: str = "UTC", pattern: str | None = STAMP) -> Column:
    """Text or time read as UTC, converted to ``zone``, formatted unless ``pattern`` is None."""
    column = as_column(text)
    parsed = F.coalesce(
        F.try_to_timestamp(column.cast("string")),
        F.lit(None).cast("timestamp"),
    ).cast(NTZ)
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), parsed)
    return local if pattern is None else F.date_format(local, pattern)


def standardize_date(text) -> Column:
    """"2025-03" as "2025-03-01"; a full date and anything else stay, blanks trimmed."""
    text = F.trim(as_column(text))
    return F.when(text.rlike(r"^[0-9]+-[0-9]+$"), F.concat(text, F.lit("-01"))).otherwise(text)


def long_date(text) -> Column:
    """"Thursday, January 2, 2025" as a date: weekday, day and year between commas; the weekday says nothing new."""
    parts = F.transform(F.split(as_column(text), ","), lambda part: F.trim(part))
    return parse_date(F.when(F.size(parts) == 3, F.array_join(F.slice(parts, 2, 2), ", ")), "MMMM d, yyyy")


def clock24(text) -> Column:
    """"2:44 PM" as "14:44"."""
    clock = F.upper(F.trim(as_column(text)))
    clock = F.when(clock.rlike(r"^\d{1,2}:\d{2} [AP]M$"), clock)
    return F.date_format(F.try_to_timestamp(clock, F.lit("h:mm a")), "HH:mm")


def _sessions(text: Column) -> Column:
    """The sessions of a list like "9:00 am - 11:30 am, 1:00 pm - 2:45 pm", entries that are none left out."""
    ends = F.transform(F.split(text, ","), lambda entry: F.split(entry, " - "))
    clocks = F.transform(ends, lambda e: F.struct(clock24(F.get(e, F.lit(0))).alias("opens"), clock24(F.get(e, F.lit(1))).alias("closes")))
    return F.filter(clocks, lambda c: c["opens"].isNotNull() & c["closes"].isNotNull())


def _open_and_close(sessions: Column) -> list[Column]:
    """The first opening and the last closing."""
    return [F.get(sessions, F.lit(0))["opens"].alias("open_local"), F.try_element_at(sessions, F.lit(-1))["closes"].alias("close_local")]


def session_text(text) -> Column:
    """First opening, last closing and zone of "9:00 am - 11:30 am, 1:00 pm - 2:45 pm (+07)": the zone is in the last brackets."""
    text = as_column(text)
    behind = F.when(F.contains(text, F.lit("(")), F.substring_index(text, "(", -1))
    zone = F.when(F.contains(behind, F.lit(")")), F.substring_index(behind, ")", 1))
    return F.struct(*_open_and_close(_sessions(F.substring_index(text, "(", 1))), zone.alias("timezone"))


def holiday_session(status) -> Column:
    """Opening and closing of a shortened day, from the first line of "Open, 9:30 AM - 1:00 PM"; null for other days."""
    line = F.substring_index(ascii_only(status), "\n", 1)
    sessions = F.when(F.contains(F.substring_index(line, ",", 1), F.lit("Open")), _sessions(line))
    return F.struct(*_open_and_close(sessions))


def hhmm(time) -> Column:
    return F.date_format(as_column(time), "HH:mm")


def first_ten(text) -> Column:
    return F.left(as_column(text).cast("string"), F.lit(10))


def last_trading_day(now, target_hour) -> Column:
    """The day prices of ``now`` belong to.

    Past the target hour: yesterday, weekends going back to Friday. Else today, weekends going on
    to Monday.
    """
    now = as_column(now)
    target = target_hour if isinstance(target_hour, Column) else F.lit(target_hour)
    today = now.cast("date")
    yesterday = F.date_sub(today, 1)
    back = F.when(F.weekday(yesterday) == 5, 1).when(F.weekday(yesterday) == 6, 2).otherwise(0)
    ahead = F.when(F.weekday(today) == 5, 2).when(F.weekday(today) == 6, 1).otherwise(0)
    return F.when(target < F.hour(now), F.date_sub(yesterday, back)).otherwise(F.date_add(today, ahead))


def fetch_period(as_of, max_date) -> Column:
    """The shortest period that covers what is missing; null when nothing is, "max" when nothing is stored."""
    max_date = as_column(max_date).cast("date")
    days = F.date_diff(as_column(as_of).cast("date"), max_date)
    period = F.lit(PERIOD_ALL)
    for name, covers in reversed(PERIOD_DAYS.items()):
        period = F.when(days <= covers, F.lit(name)).otherwise(period)
    return (
        F.when(max_date.isNull(), F.lit(PERIOD_ALL))
        .when(days <= 0, F.lit(None).cast("string"))
        .otherwise(period)
    )


def after_close(now, trading_day, closing: str = "15:45") -> Column:
    """True once the session of ``trading_day`` is over at ``now``."""
    now = as_column(now)
    return (hhmm(now) >= F.lit(closing)) | (now.cast("date") > as_column(trading_day))
