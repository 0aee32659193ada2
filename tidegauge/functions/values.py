"""Value-level expressions: coercion, text normalisation, guards, hashing."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number in text, and the words for "missing".
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
MISSING_WORDS = ("nan", "none", "na", "")
TIME_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "yyyy-MM-dd",
)


def nan_to_null(value: Column) -> Column:
    """Spark has NULL and NaN; everything downstream knows NULL only."""
    return F.when(~F.isnan(value), value)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    A filter on a computed column is pushed below the projection by copying its
    expression, so one that repeats a costly input multiplies the work.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def to_number(text: Column) -> Column:
    """Text to double, NULL where it is not a plain decimal number."""
    text = text.cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


# What the letters of a format stand for.
_FIELDS = {"y": "year", "M": "month", "d": "day", "H": "hour", "h": "hour", "m": "minute", "s": "second", "S": "fraction"}


def _fields_of(fmt: str) -> tuple[str, dict[str, tuple[int, int]]] | None:
    """Regular expression for texts of an all-digit format, and where its groups stand.

    Each field has the number of its group and of its digits. None if the format has names.
    """
    pattern, fields = "", {}
    for m in re.finditer(r"'([^']*)'|([A-Za-z])\2*|(.)", fmt):
        letter, length = m[2], len(m[0])
        if m[1] is not None or not letter:
            pattern += re.escape(m[1] if m[1] is not None else m[3])
            continue
        if letter not in _FIELDS or (letter == "M" and length > 2) or _FIELDS[letter] in fields:
            return None
        fields[_FIELDS[letter]] = len(fields) + 1, length
        pattern += rf"(\d{{{length}}})" if length > 1 else r"(\d{1,2})"
    return f"^{pattern}$", fields


def _from_fields(text: Column, shape: str, fields: Mapping[str, tuple[int, int]]) -> Column:
    """Wall-clock time from the digit groups of a text; NULL if there is no such time."""

    def number(name: str, default: int) -> Column:
        if name not in fields:
            return F.lit(default)
        return F.regexp_extract(text, shape, fields[name][0]).cast("int")

    year = number("year", 1970)
    if fields.get("year", (0, 4))[1] == 2:
        year = year + 2000
    second = number("second", 0).cast("decimal(16,6)")
    if "fraction" in fields:
        second = second + F.rpad(F.regexp_extract(text, shape, fields["fraction"][0]), 6, "0").cast("decimal(16,6)") / 1_000_000
    parts = [year, number("month", 1), number("day", 1), number("hour", 0), number("minute", 0), second.cast("decimal(16,6)")]
    return F.when(text.rlike(shape), F.try_make_timestamp_ntz(*parts))


def to_time(text: Column, formats: Sequence[str] = TIME_FORMATS) -> Column:
    """Text to ``timestamp_ntz`` by the first format that fits, else NULL.

    All-digit formats are read as wall-clock time, whatever the zone of the session. A format
    with names of months or zones goes through Spark's parser and the session zone.
    """
    parsed = []
    for fmt in formats:
        known = _fields_of(fmt)
        parsed.append(_from_fields(text, *known) if known else F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz"))
    return F.coalesce(*parsed)


def _flat(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def _capital(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))


def normal_text(text: Column, words: Iterable[str] = MISSING_WORDS) -> Column:
    """Strip, collapse white space, lower-case, capital first letter; NULL for ``words``."""
    listed = list(words)
    return let(_flat(text), lambda flat: F.when(~flat.isin(*listed), _capital(flat)))


def safe_ratio(over: Column, under: Column) -> Column:
    """``over / under``; 0.0 for a zero divisor, a missing input or no finite value."""
    ratio = nan_to_null(over.cast("double") / F.nullif(under.cast("double"), F.lit(0.0)))
    finite = F.when(F.abs(ratio) != float("inf"), ratio)
    return F.coalesce(finite, F.lit(0.0))


def clamp(value: Column, low: float | Column | None, high: float | Column | None) -> Column:
    """Limit to ``[low, high]``; NULL and NaN give NULL.

    ``greatest``/``least`` skip NULLs and take NaN for the largest number, hence the guard.
    """
    limited = value
    if low is not None:
        limited = F.greatest(limited, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        limited = F.least(limited, high if isinstance(high, Column) else F.lit(high))
    return F.when(value.isNotNull() & ~F.isnan(value), limited)


def hash_number(key: Column, seed: int) -> Column:
    """32-bit number from md5 of ``key:seed``: the same in every engine and run."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
