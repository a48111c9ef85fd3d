"""Calendar and slot expressions over epoch milliseconds and date/time text.

Everything is integer or date arithmetic, so results do not depend on the
session time zone and no formatter runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_SECOND = 1_000
MS_PER_DAY = 86_400_000
SLOT_MS = 600_000
SLOTS_PER_DAY = MS_PER_DAY // SLOT_MS

# Weekday order, and the first half-hour of service in a day.
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
WORKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri"]
SERVICE_START = "05:30:00"

# Text of every 10-minute slot of a day, 00:00:00 .. 23:50:00.
SLOT_LEVELS = [f"{s // 6:02d}:{s % 6 * 10:02d}:00" for s in range(SLOTS_PER_DAY)]


def _lookup(values: list[str], index: Column) -> Column:
    """Constant array access; ``index`` counts from zero.

    Split of a literal is folded to an array once, and is one call to build.
    """
    return F.get(F.split(F.lit(",".join(values)), ","), index)


def slot_start(ms: Column) -> Column:
    """Start of the 10-minute slot that holds an epoch-millisecond instant."""
    return ms - F.pmod(ms, F.lit(SLOT_MS))


def utc_date(ms: Column) -> Column:
    return F.date_from_unix_date(((ms - F.pmod(ms, F.lit(MS_PER_DAY))) / MS_PER_DAY).cast("int"))


def date_text(ms: Column) -> Column:
    return utc_date(ms).cast("string")


def slot_time_text(ms: Column) -> Column:
    """``HH:m0:00`` of the slot that holds the instant."""
    return slot_label((F.pmod(ms, F.lit(MS_PER_DAY)) / SLOT_MS).cast("int"))


def weekday_code(date: Column) -> Column:
    """Monday is 0."""
    return F.weekday(date)


def weekday_name(date: Column) -> Column:
    return _lookup(WEEKDAYS, weekday_code(date))


def slot10(minute: Column) -> Column:
    """Minute of the hour to the text of its ten, NULL outside 0..59."""
    return F.when(minute.between(0, 59), F.lpad((minute - minute % 10).cast("string"), 2, "0"))


def slot30(time_text: Column) -> Column:
    """``HH:MM:SS`` text to the start of its half hour."""
    half = F.when(F.substring(time_text, 4, 2) < "30", F.lit(":00:00")).otherwise(F.lit(":30:00"))
    return F.concat(F.substring(time_text, 1, 2), half)


def season(date: Column) -> Column:
    """Quarter of the year counted from November; a NULL date has no season."""
    quarter = (F.pmod(F.month(date) + 1, F.lit(12)) / 3).cast("int")
    return _lookup(["Winter", "Spring", "Summer", "Autumn"], quarter)


def horizon_ms(minutes: Column) -> Column:
    """Forecast horizon: hours rounded to two decimals, so 10 minutes is 0.17 h."""
    hours = F.round(F.coalesce(minutes, F.lit(0)) / 60, 2)
    return F.round(hours * 3_600_000).cast("long")


def timestamp_text(ms: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC."""
    second = F.floor(F.pmod(ms, F.lit(MS_PER_DAY)) / MS_PER_SECOND)

    def two(x: Column) -> Column:
        return F.lpad(F.floor(x).cast("string"), 2, "0")

    return F.concat(
        date_text(ms), F.lit(" "), two(second / 3600), F.lit(":"),
        two(second % 3600 / 60), F.lit(":"), two(second % 60),
    )


def minute_of_day(time_text: Column) -> Column:
    return F.substring(time_text, 1, 2).cast("int") * 60 + F.substring(time_text, 4, 2).cast("int")


def slot_number(time_text: Column) -> Column:
    """Position of a 10-minute slot in its day, 0..143."""
    return (minute_of_day(time_text) / 10).cast("int")


def slot_label(number: Column) -> Column:
    return _lookup(SLOT_LEVELS, number)
