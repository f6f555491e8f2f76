"""Date and time columns.

Trip times carry no zone.  Every helper stays with wall-clock fields and differences of
zone-free timestamps, so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day names, Sunday first.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def whole_seconds(ts: Column) -> Column:
    """Wall-clock seconds since 1970-01-01, fraction dropped (BIGINT).

    On a zone-free timestamp this is a plain division of the stored number.
    """
    return F.unix_timestamp(ts)


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from ``start`` to ``end``."""
    return whole_seconds(end) - whole_seconds(start)


def interval_offset(at: Column, anchor: Column, seconds: int) -> Column:
    """Signed number of intervals from ``anchor`` to ``at``, nearest, halves away from zero.

    ``anchor`` has no fraction of a second.  Whole numbers only: halves go up by the floor,
    and an exact half before the anchor is then moved down.
    """
    shifted = whole_seconds(at) - whole_seconds(anchor) + seconds // 2
    exact_half_before = (
        (shifted < seconds // 2)
        & (F.pmod(shifted, F.lit(seconds)) == 0)
        & (F.extract(F.lit("SECOND"), at) == F.second(at))
    )
    return F.floor(shifted / seconds) - F.when(exact_half_before, 1).otherwise(0)


def hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def nearest_hour(ts: Column) -> Column:
    """Round to the nearest hour: half past goes up."""
    shifted = ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(30))
    return F.to_date(shifted).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(shifted))


def day_number(date: Column) -> Column:
    """Day of week with Sunday = 0 (BIGINT)."""
    return (F.dayofweek(date) - 1).cast("bigint")


def day_name_of(number: Column) -> Column:
    """Name of a Sunday = 0 day number."""
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), (number + 1).cast("int"))


def day_name(date: Column) -> Column:
    return day_name_of(day_number(date))


def is_weekend(date: Column) -> Column:
    return F.dayofweek(date).isin(1, 7)


def day_type(date: Column) -> Column:
    return F.when(is_weekend(date), "Weekend").otherwise("Weekday")


def hour_label(hour: Column) -> Column:
    """``7`` to ``07:00``."""
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def first_sunday(year: Column, month: int) -> Column:
    """First Sunday of a month; ``next_day`` is strict, hence the day before."""
    return F.next_day(F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1), "SU")
