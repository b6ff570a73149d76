"""Sorting, paging and counting of hits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliosearch import model as m
from foliosearch.functions.text import sort_key

# A sort key: column name and whether it ascends.
SortKey = tuple[str, bool]

ALL_ROWS = -1


def _sort_column(df: DataFrame, name: str) -> Column | None:
    """What a requested name sorts by; None where the data has no such column."""
    if name.lower() == m.TITLE:
        if m.TITLE_LOWERCASE in df.columns:
            return F.col(m.TITLE_LOWERCASE)
        return sort_key(F.col(m.TITLE)) if m.TITLE in df.columns else None
    if name.startswith(m.RECORD_VARIABLES + "."):
        variable = name[len(m.RECORD_VARIABLES) + 1 :]
        if m.VARIABLES_LOWERCASE in df.columns:
            return F.col(m.VARIABLES_LOWERCASE)[variable]
        return sort_key(F.col(m.RECORD_VARIABLES)[variable]) if m.RECORD_VARIABLES in df.columns else None
    return F.col(f"`{name}`") if name in df.columns else None


def sort_orders(df: DataFrame, keys: Sequence[SortKey] = ()) -> list[Column]:
    """The full order of hits: requested keys, nulls last, document id last.

    Titles and record variables sort by their lowercase form.  A key the data
    does not have is ignored.  Without keys the best score comes first.
    """
    orders = []
    if not keys and "score" in df.columns:
        orders.append(F.col("score").desc_nulls_last())
    for name, ascending in keys:
        column = _sort_column(df, name)
        if column is not None:
            orders.append(column.asc_nulls_last() if ascending else column.desc_nulls_last())
    return [*orders, *[F.col(name).asc() for name in (m.UUID, m.REPOSITORY) if name in df.columns]]


def sort_columns(df: DataFrame, keys: Sequence[SortKey]) -> list[str]:
    """The columns of ``df`` that the keys sort by, other than the document's key."""
    names = []
    for name, _ in keys:
        if name.lower() == m.TITLE:
            names += [m.TITLE_LOWERCASE] if m.TITLE_LOWERCASE in df.columns else [m.TITLE]
        elif name.startswith(m.RECORD_VARIABLES + "."):
            names += [m.VARIABLES_LOWERCASE] if m.VARIABLES_LOWERCASE in df.columns else [m.RECORD_VARIABLES]
        else:
            names.append(name)
    return [name for name in dict.fromkeys(names) if name in df.columns and name not in m.KEY]


def sort_hits(df: DataFrame, keys: Sequence[SortKey] = ()) -> DataFrame:
    return df.orderBy(*sort_orders(df, keys))


def page(df: DataFrame, page_size: int = ALL_ROWS, page_index: int = 0) -> DataFrame:
    """One page of sorted hits; ``-1`` means all of them.

    On a sorted frame Spark plans a distributed top-k, not a full sort.
    """
    if page_size == ALL_ROWS:
        return df
    if page_size < 1 or page_index < 0:
        raise ValueError(f"no such page: size {page_size}, index {page_index}")
    return df.offset(page_size * page_index).limit(page_size)


def sort_values(df: DataFrame, keys: Sequence[SortKey] = ()) -> list[tuple[Column, bool]]:
    """What hits are ordered by, and whether it ascends: the same as ``sort_orders``."""
    values = [(F.col("score"), False)] if not keys and "score" in df.columns else []
    for name, ascending in keys:
        column = _sort_column(df, name)
        if column is not None:
            values.append((column, ascending))
    return [*values, *[(F.col(name), True) for name in (m.UUID, m.REPOSITORY) if name in df.columns]]


def cursor_after(hits: DataFrame, keys: Sequence[SortKey] = ()) -> list | None:
    """The place of the last hit of a page: its sort values, as plain values; None for an empty page.

    A page is small; it is read once for this.
    """
    values = [value.alias(f"v{k}") for k, (value, _) in enumerate(sort_values(hits, keys))]
    rows = hits.select(*values).collect()
    return list(rows[-1]) if rows else None


def after_cursor(df: DataFrame, cursor: Sequence, keys: Sequence[SortKey] = ()) -> DataFrame:
    """The hits that come after a cursor in the order of ``sort_hits``.

    One predicate on the sort columns: an earlier column is beyond the cursor's
    value, or equal to it and the next one decides.  Nulls come last both
    ways.  The first column's part stands alone as well, so that it reaches the scan.
    """
    values = sort_values(df, keys)
    if len(cursor) != len(values):
        raise ValueError(f"a cursor of {len(cursor)} values for an order of {len(values)}")
    beyond, same = F.lit(False), F.lit(True)
    for (column, ascending), value in zip(values, cursor):
        literal = F.lit(value)
        if value is None:
            later = F.lit(False)
        else:
            later = column.isNull() | ((column > literal) if ascending else (column < literal))
        beyond, same = beyond | (same & later), same & column.eqNullSafe(literal)
    (first, ascending), value = values[0], cursor[0]
    if value is None:
        reach = first.isNull()
    else:
        reach = first.isNull() | ((first >= F.lit(value)) if ascending else (first <= F.lit(value)))
    return df.where(reach & F.coalesce(beyond, F.lit(False)))


def next_page(df: DataFrame, cursor: Sequence | None, page_size: int, keys: Sequence[SortKey] = ()) -> DataFrame:
    """The page after a cursor, or the first one without.

    It costs what the first page costs, however far it is: a top-k of ``page_size``
    rows, not of all rows before it too.
    """
    if page_size < 1:
        raise ValueError(f"no such page: size {page_size}")
    rest = df if cursor is None else after_cursor(df, cursor, keys)
    return sort_hits(rest, keys).limit(page_size)


def total_matches(df: DataFrame) -> DataFrame:
    """``(totalSize)``: all matches, whatever the page; zero where none."""
    return df.agg(F.count(F.lit(1)).alias("totalSize"))


def page_info(df: DataFrame, page_size: int, page_index: int) -> DataFrame:
    """One row about a page of ``df``, which is the unpaged result.

    Counting needs no sort and no data column, and the size of the page follows
    from the total.  There is no page info for a result without pages.
    """
    return info_of_total(total_matches(df), page_size, page_index)


def info_of_total(totals: DataFrame, page_size: int, page_index: int) -> DataFrame:
    """``page_info`` from a total that is known: a row ``(totalSize)``."""
    if page_size < 1 or page_index < 0:
        raise ValueError(f"no page info for size {page_size}, index {page_index}")
    size = F.lit(page_size).cast("long")
    left = F.col("totalSize") - F.lit(page_size * page_index).cast("long")
    return totals.select(
        F.lit(True).alias("isPaginable"),
        F.greatest(F.lit(0).cast("long"), F.least(left, size)).alias("resultsCount"),
        "totalSize",
        size.alias("pageSize"),
        F.ceil(F.col("totalSize") / size).cast("long").alias("pageCount"),
        F.lit(page_index).cast("long").alias("currentPageIndex"),
    )
