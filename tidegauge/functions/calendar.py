"""Calendar expressions with Monday as day 0."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar order of day names.
DAY_NAMES = (
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
    "Sunday",
)

PARTS = {
    "hour": F.hour,
    "dayofweek": F.weekday,
    "month": F.month,
    "dayofyear": F.dayofyear,
}


def part(time: Column, name: str) -> Column:
    return PARTS[name](time)


def day_name(time: Column) -> Column:
    return F.date_format(time, "EEEE")


def cycle(hour: Column, wave: str) -> Column:
    """Hour of day on the unit circle: ``wave`` is ``sin`` or ``cos``."""
    angle = hour.cast("double") * (2 * pi / 24)
    return F.sin(angle) if wave == "sin" else F.cos(angle)
