"""Predicates over content columns, as plain Spark columns.

Negations follow search-index rules: a document that lacks the value is not
equal to it, so it passes.  They are written null-safe in a form the Parquet
reader still accepts as a pushed filter.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliosearch import model as m


def equals(name: str, value) -> Column:
    return F.col(name) == F.lit(value)


def not_equals(name: str, value) -> Column:
    """``!=`` and ``<>``: also true where the column is null."""
    return ~F.col(name).eqNullSafe(F.lit(value))


def like(name: str, pattern: str) -> Column:
    """``LIKE`` with ``%`` as the wildcard; case matters."""
    return F.col(name).like(pattern)


def ilike(name: str, pattern: str) -> Column:
    return F.col(name).ilike(pattern)


def is_in(name: str, values: Sequence) -> Column:
    return F.col(name).isin(*values)


def not_in(name: str, values: Sequence) -> Column:
    """``NOT IN``: also true where the column is null."""
    return F.col(name).isNull() | ~F.col(name).isin(*values)


def _date(day: str | dt.date) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def between_dates(name: str, first: str | dt.date, last: str | dt.date) -> Column:
    """``BETWEEN DATE first AND DATE last``, both days whole.

    The column itself stays bare (no ``to_date`` around it), so that the range
    reaches the scan for dates and timestamps alike.
    """
    upper = _date(last) + dt.timedelta(days=1)
    return (F.col(name) >= F.lit(_date(first))) & (F.col(name) < F.lit(upper))


def not_between_dates(name: str, first: str | dt.date, last: str | dt.date) -> Column:
    upper = _date(last) + dt.timedelta(days=1)
    column = F.col(name)
    return column.isNull() | (column < F.lit(_date(first))) | (column >= F.lit(upper))


def starts_with_path(path: str, name: str = m.PATH) -> Column:
    """``STARTSWITH``, by whole path components: the path itself or below it.

    ``/a/b`` takes ``/a/b`` and ``/a/b/c`` but not ``/a/bc``.
    """
    base = path.rstrip("/")
    if not base:
        return F.col(name).startswith("/")
    return (F.col(name) == base) | F.col(name).startswith(base + "/")


def below_ancestor(ancestor_id: str) -> Column:
    return F.array_contains(m.ANCESTOR_IDS, ancestor_id)


def has_value(name: str, value: str) -> Column:
    """``=`` on a multi-valued column: one of its values is ``value``."""
    return F.array_contains(name, value)


def lacks_value(name: str, value: str) -> Column:
    """``!=`` on a multi-valued column: none of its values is ``value``."""
    return ~F.coalesce(F.array_contains(name, value), F.lit(False))


# Up to so many values an overlap of arrays is faster, past it a set lookup
# per element: that one does not slow down with the number of values.
FEW_VALUES = 10


def has_any_value(name: str, values: Sequence[str]) -> Column:
    """``IN`` on a multi-valued column."""
    wanted = sorted(set(values))
    if len(wanted) <= FEW_VALUES:
        return F.arrays_overlap(F.col(name), F.array(*[F.lit(value) for value in wanted]).cast("array<string>"))
    return F.exists(F.col(name), lambda value: value.isin(*wanted))


def flag(name: str, value: int | bool) -> Column:
    """A 0/1 test on a boolean column."""
    return F.col(name) == F.lit(bool(value))


def state_is(state: str) -> Column:
    return equals(m.STATE, state)


def state_is_not(state: str) -> Column:
    return not_equals(m.STATE, state)


def match_all() -> Column:
    """What a search without a query means."""
    return F.lit(True)


def all_of(*predicates: Column) -> Column:
    combined = match_all()
    for predicate in predicates:
        combined = combined & predicate
    return combined
