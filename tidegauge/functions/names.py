"""Plan-time helpers for column names and types: nothing here runs a job."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted spellings of the target column.
TARGET_ALIASES = (
    "usage_kwh",
    "energy_kwh",
    "energy_usage_kwh",
    "target",
)
TARGET_WORDS = ("usage", "kwh")


def quoted(name: str) -> str:
    """Back-tick a name so that dots and parentheses are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Return ``df``, or raise ``ValueError`` naming every absent column."""
    present = set(df.columns)
    missing = [c for c in columns if c not in present]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def _renamed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    twice = sorted(n for n, k in Counter(names).items() if k > 1)
    if twice:
        raise ValueError(f"column names collide after renaming: {twice}")
    return df.toDF(*names)


def normalized_header(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalize_headers(df: DataFrame) -> DataFrame:
    """Strip, lower-case, and replace spaces by ``_`` in every column name."""
    return _renamed(df, [normalized_header(c) for c in df.columns])


def safe_name(name: str, lower: bool = True) -> str:
    plain = name.strip().replace(" ", "_").replace("(", "").replace(")", "")
    plain = plain.replace(".", "_")
    return plain.lower() if lower else plain


def safe_names(df: DataFrame, lower: bool = True) -> DataFrame:
    """Headers without spaces and parentheses, and with ``_`` for dots."""
    return _renamed(df, [safe_name(c, lower) for c in df.columns])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; other entries of ``mapping`` are ignored."""
    return _renamed(df, [mapping.get(c, c) for c in df.columns])


def _likeness(name: str, wanted: str) -> int | None:
    """0: the same name, 1: the same letters and digits in any case, None: another name."""
    if name == wanted:
        return 0
    return 1 if re.findall(r"[^\W_]", name.lower()) == re.findall(r"[^\W_]", wanted.lower()) else None


def best_match(columns: Iterable[str], wanted: Sequence[str], words: Sequence[str] = ()) -> str | None:
    """The column that fits best: an exact name, else the same letters, else all ``words``.

    Among equally close fits an earlier name of ``wanted`` wins. Two columns that fit
    equally well are an error, never a silent choice.
    """
    ranked: dict[tuple[int, int], list[str]] = {}
    for c in columns:
        places = [(close, at) for at, w in enumerate(wanted) if (close := _likeness(c, w)) is not None]
        if words and all(w in c.lower() for w in words):
            places.append((2, 0))
        if places:
            ranked.setdefault(min(places), []).append(c)
    if not ranked:
        return None
    first = ranked[min(ranked)]
    if len(first) > 1:
        raise ValueError(f"columns {first} fit equally well")
    return first[0]


def resolve(df: DataFrame, candidates: Iterable[str]) -> str:
    """The column meant by one of ``candidates``; ``KeyError`` without one."""
    wanted = list(candidates)
    found = best_match(df.columns, wanted)
    if found is None:
        raise KeyError(f"no column matches {wanted}")
    return found


def find_target(
    df: DataFrame, aliases: Sequence[str] = TARGET_ALIASES, words: Sequence[str] = TARGET_WORDS
) -> str | None:
    """The target column by a usual name, else by the words its name holds."""
    return best_match(df.columns, aliases, words)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    gone = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in gone
    ]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    gone = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in gone
    ]


def classify(df: DataFrame, exclude: Iterable[str] = ()) -> tuple[list[str], list[str]]:
    """``(numeric, categorical)`` column names by type, without ``exclude``."""
    gone = tuple(exclude)
    return numeric_columns(df, gone), categorical_columns(df, gone)


def first_time_column(df: DataFrame, words: Sequence[str] = ("date", "time")) -> str | None:
    """First column whose name holds ``date`` or ``time``."""
    return next((c for c in df.columns if any(w in c.lower() for w in words)), None)
