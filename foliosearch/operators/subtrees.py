"""Subtrees as ranges of paths, kept beside an index.

An index is sorted by path, and what lies below a folder is one stretch of that
order.  A small table keeps, for each ancestor that documents name, the first
and last path that names it.  A subtree is then a range that the scan prunes row
groups by.  The range only ever narrows what is read; the ancestors in each row decide, so
a document whose path doesn't follow its ancestors is found as well.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliosearch import model as m

ROOT = "root"
INTERVAL_SCHEMA = f"`{m.REPOSITORY}` string, {ROOT} string, low string, high string, unplaced boolean"

# Up to so many intervals come to the driver; of more, only the first and the last path.
MOST_INTERVALS = 10_000

# Up to so many ranges go into a scan.
MOST_RANGES = 100

# First and last path of a range, both included.
Range = tuple[str, str]


def subtree_intervals(rows: DataFrame) -> DataFrame:
    """``(repository, root, low, high, unplaced)`` of each ancestor that rows name.

    ``unplaced`` tells that one of the rows below has no path.  Paths are compared inside
    the tasks first, so the shuffle has one row per ancestor and task, and a root
    above all documents gathers nowhere.
    """
    members = rows.select(m.REPOSITORY, F.explode(m.ANCESTOR_IDS).alias(ROOT), m.PATH).where(F.col(ROOT).isNotNull())
    return members.groupBy(m.REPOSITORY, ROOT).agg(
        F.min(m.PATH).alias("low"),
        F.max(m.PATH).alias("high"),
        F.coalesce(F.bool_or(F.col(m.PATH).isNull()), F.lit(False)).alias("unplaced"),
    )


def merged(ranges: Iterable[Range], most: int = MOST_RANGES) -> list[Range]:
    """Disjoint ranges that hold all given ones, at most ``most``: beyond, neighbours become one."""
    joined: list[Range] = []
    for low, high in sorted(ranges):
        if joined and low <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(high, joined[-1][1]))
        else:
            joined.append((low, high))
    step = -(-len(joined) // most) if joined else 1
    return [(joined[at][0], joined[min(at + step, len(joined)) - 1][1]) for at in range(0, len(joined), step)]


def reach(intervals: DataFrame) -> list[Range] | None:
    """The ranges of these intervals; None where a document below has no path."""
    rows = intervals.select("low", "high", "unplaced").limit(MOST_INTERVALS + 1).collect()
    if len(rows) > MOST_INTERVALS:
        rows = intervals.agg(F.min("low").alias("low"), F.max("high").alias("high"), F.bool_or("unplaced").alias("unplaced")).collect()
    if any(row.unplaced for row in rows):
        return None
    return merged((row.low, row.high) for row in rows)


def within(ranges: list[Range] | None) -> Column:
    """The paths in one of these ranges, as a predicate for the scan; all rows for None."""
    if ranges is None:
        return F.lit(True)
    tests = [(F.col(m.PATH) >= F.lit(low)) & (F.col(m.PATH) <= F.lit(high)) for low, high in ranges]
    return reduce(or_, tests, F.lit(False)) if tests else F.lit(False)
