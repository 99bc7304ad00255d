"""Predicates and bounded listings (P1-P16, Q scans, SC1, T1-T3).

A predicate whose argument is None stands for a filter that was not asked for and is left out. Everything stays a
Column, so that filters reach the scan and a sorted, limited listing becomes TakeOrderedAndProject.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT, MAX_LIMIT = 50, 500


def clamp(limit: float | None, default: int = DEFAULT_LIMIT, most: int = MAX_LIMIT) -> int:
    """The number of rows to return: none, NaN or 0 mean the default; others are cut to 1..most."""
    if not limit or math.isnan(limit):
        return default
    return int(min(max(math.floor(limit), 1), most))


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def equals(c: str | Column, value, fold: str | None = None) -> Column | None:
    """Equality; ``fold`` ("upper" or "lower") changes the argument, never the column."""
    if value is None:
        return None
    return _column(c) == (getattr(value, fold)() if fold else value)


def between(c: str | Column, since=None, until=None) -> Column | None:
    """Inclusive range; null values are outside."""
    parts = [_column(c) >= F.lit(since) if since is not None else None, _column(c) <= F.lit(until) if until is not None else None]
    return all_of(parts)


def contains(c: str | Column, needle: str | None) -> Column | None:
    """Case-insensitive substring; % and _ in the needle are wildcards, a backslash is ordinary text."""
    if needle is None:
        return None
    return F.lower(_column(c)).like("%" + needle.lower().replace("\\", "\\\\") + "%")


def has(c: str | Column, value: str | None, fold: str | None = "upper") -> Column | None:
    """An array holds the value exactly; an array of null or no elements holds nothing."""
    if value is None:
        return None
    return F.coalesce(F.array_contains(_column(c), getattr(value, fold)() if fold else value), F.lit(False))


def any_contains(c: str | Column, needle: str | None, field: str | None = None) -> Column | None:
    """Some element (or a field of it) contains the needle; names of fields never match."""
    if needle is None:
        return None
    return F.coalesce(F.exists(_column(c), lambda x: contains(x[field] if field else x, needle)), F.lit(False))


def one_of(c: str | Column, values: Sequence[str] | None) -> Column | None:
    """Membership of upper-cased values; an empty list filters nothing."""
    return _column(c).isin([v.upper() for v in values]) if values else None


def at_least(c: str | Column, value: float | None) -> Column | None:
    return None if value is None else _column(c) >= value


def product_at_least(a: str, b: str, value: float | None) -> Column | None:
    """Both present and their product at least the value (the sign counts)."""
    return None if value is None else F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) * F.col(b) >= value)


def any_of(*parts: Column | None) -> Column | None:
    given = [p for p in parts if p is not None]
    return reduce(lambda a, b: a | b, given) if given else None


def all_of(parts: Sequence[Column | None]) -> Column | None:
    given = [p for p in parts if p is not None]
    return reduce(lambda a, b: a & b, given) if given else None


def where(df: DataFrame, *parts: Column | None) -> DataFrame:
    condition = all_of(parts)
    return df if condition is None else df.where(condition)


def order(*names: str) -> list[Column]:
    """Sort keys; a leading minus means descending. Null is least, so it comes first ascending and last descending."""
    return [F.col(n[1:]).desc_nulls_last() if n.startswith("-") else F.col(n).asc_nulls_first() for n in names]


def listing(df: DataFrame, parts: Sequence[Column | None], by: Sequence[str], limit: float | None = None) -> DataFrame:
    """Filter, sort with a last key that settles ties, and keep at most the clamped number of rows."""
    return where(df, *parts).orderBy(*order(*by)).limit(clamp(limit))


def top_groups(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], by: Sequence[str], limit: int | None) -> DataFrame:
    """Groups in order; the keys themselves settle ties."""
    grouped = df.groupBy(*keys).agg(*aggregates)
    if limit is None:
        return grouped
    settled = [*by, *[k for k in keys if k not in by and f"-{k}" not in by]]
    return grouped.orderBy(*order(*settled)).limit(limit)
