"""From the keys of a page back to full documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliosearch import model as m
from foliosearch.operators.page import ALL_ROWS, SortKey, page, sort_hits, sort_orders

POSITION = "position"


# Up to so many ids go into a scan as literals.
MOST_IDS = 10_000


def named_documents(source: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents of ``source`` with these keys; few keys reach its scan as literals.

    Row groups whose statistics or Bloom filter exclude all of them are not read.
    With more than ``MOST_IDS`` the keys are met by the join alone.
    """
    ids = [row[0] for row in keys.select(m.UUID).distinct().limit(MOST_IDS + 1).collect()]
    narrowed = source.where(F.col(m.UUID).isin(*ids)) if len(ids) <= MOST_IDS else source
    return narrowed.join(keys, m.KEY)


def hydrate(
    hits: DataFrame,
    source: DataFrame,
    page_size: int,
    page_index: int = 0,
    keys: Sequence[SortKey] = (),
    *,
    by_id: bool = False,
) -> DataFrame:
    """Full documents of one page of hits, in page order, with their position.

    Hits need their key and sort columns only.  The page size bounds what is
    numbered; from the limit Catalyst also knows that the page is small enough to
    broadcast.  A hit whose document is gone is left out.  Of the hits' other
    columns only a score is kept.

    ``by_id=True`` finds the page at once, and reads the parts of the source that
    may have its documents instead of all; a page of more than ``MOST_IDS`` stays lazy.
    """
    if page_size == ALL_ROWS:
        raise ValueError("a page has a size; all matches are exported instead")
    best = page(sort_hits(hits, keys), page_size, page_index)
    position = F.row_number().over(Window.orderBy(*sort_orders(best, keys)))
    score = [name for name in best.columns if name == "score"]
    numbered = best.select(*m.KEY, *score, position.alias(POSITION))
    if not by_id or page_size > MOST_IDS:
        return source.join(numbered, m.KEY).orderBy(POSITION)
    found = numbered.collect()  # a page
    return named_documents(source, source.sparkSession.createDataFrame(found, numbered.schema)).orderBy(POSITION)
