"""Whole searches: from a request to a page of envelopes, or to facets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliosearch import model as m
from foliosearch.operators.envelope import envelope, page_json
from foliosearch.operators.facets import Facet, facets
from foliosearch.operators.fulltext import FullTextQuery
from foliosearch.operators.hydrate import hydrate
from foliosearch.operators.page import (
    ALL_ROWS,
    SortKey,
    info_of_total,
    next_page,
    page,
    page_info,
    sort_columns,
    sort_hits,
    total_matches,
)
from foliosearch.operators.security import acl_filter
from foliosearch.operators.summary import summarise
from foliosearch.plans.term_index import TermIndex


@dataclass(frozen=True)
class SearchResult:
    """A page with the total of all matches and their facets."""

    hits: DataFrame
    facets: DataFrame
    total: int
    page_size: int
    page_index: int

    def facet(self, agg_id: str) -> DataFrame:
        """``(bucket_key, doc_count)`` of one facet."""
        return self.facets.where(F.col("agg_id") == agg_id).select("bucket_key", "doc_count")

    def info(self) -> DataFrame:
        """The row that ``page_info`` gives, without another count."""
        totals = self.facets.sparkSession.range(1).select(F.lit(self.total).cast("long").alias("totalSize"))
        return info_of_total(totals, self.page_size, self.page_index)


@dataclass(frozen=True)
class Search:
    """What to find, for whom, in which order, and which page of it.

    Without a predicate every document matches.  With a full-text query and the
    term index that answers it, matches also obey the query and have a score,
    and without sort keys the best come first.  All results are lazy frames
    over the same plan; ``persist`` the matches where several of them are run
    on a costly predicate.
    """

    predicate: Column | None = None
    fulltext: FullTextQuery | None = None
    terms: TermIndex | None = None
    principals: Sequence[str] = ()
    admin: bool = False
    sort: Sequence[SortKey] = ()
    page_size: int = ALL_ROWS
    page_index: int = 0
    prefixes: Sequence[str] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        if (self.fulltext is None) != (self.terms is None):
            raise ValueError("a full-text query and its term index go together")

    def matches(self, df: DataFrame) -> DataFrame:
        found = df if self.predicate is None else df.where(self.predicate)
        readable = acl_filter(found, self.principals, admin=self.admin)
        return readable if self.terms is None else readable.join(self.terms.ranked(self.fulltext), m.KEY)

    def hits(self, df: DataFrame) -> DataFrame:
        """The page of hits.  Where hits are ranked, only keys, scores and sort columns
        move until the page is cut; the documents are fetched for it alone."""
        return self._page_of(df, self.matches(df))

    def _page_of(self, df: DataFrame, found: DataFrame) -> DataFrame:
        if self.terms is None or self.page_size == ALL_ROWS:
            return page(sort_hits(found, self.sort), self.page_size, self.page_index)
        narrow = found.select(*m.KEY, "score", *sort_columns(df, self.sort))
        full = hydrate(narrow, df, self.page_size, self.page_index, self.sort, by_id=True)
        return full.select(*[F.col(f"`{name}`") for name in (*df.columns, "score")])

    def hits_after(self, df: DataFrame, cursor: Sequence | None) -> DataFrame:
        """The page that follows a cursor (``page.cursor_after`` of the page before), at the
        cost of the first page."""
        return next_page(self.matches(df), cursor, self.page_size, self.sort)

    def envelopes(self, df: DataFrame) -> DataFrame:
        return envelope(self.hits(df), self.prefixes)

    def document(self, df: DataFrame) -> DataFrame:
        """The page as one JSON document, page info included."""
        return page_json(self.matches(df), self.page_size, self.page_index, self.sort, self.prefixes)

    def total(self, df: DataFrame) -> DataFrame:
        return total_matches(self.matches(df))

    def info(self, df: DataFrame) -> DataFrame:
        return page_info(self.matches(df), self.page_size, self.page_index)

    def facets(self, df: DataFrame, wanted: Sequence[Facet]) -> DataFrame:
        return facets(self.matches(df), wanted)

    def result(self, df: DataFrame, wanted: Sequence[Facet] = ()) -> SearchResult:
        """The page, the total and the facets, from one reading of all matches.

        That reading runs at once and leaves a small table: the counted buckets, and
        the best leading sort value of each of a fixed number of cells of hits.
        The total is the cells' sum, and the page is read below the bound that
        the cells prove for it.  The predicate, the ACL and the query must be
        the same in both readings: nothing may write to ``df`` in between.
        """
        found = self.matches(df)
        paged = self.page_size != ALL_ROWS
        counted = summarise(found, wanted, self.page_size * (self.page_index + 1) if paged else 0, self.sort)
        bounded = found if counted.bound is None else found.where(counted.bound)
        return SearchResult(self._page_of(df, bounded), counted.facets, counted.total, self.page_size, self.page_index)


def ranked_hits(
    df: DataFrame,
    terms: TermIndex,
    query: FullTextQuery,
    principals: Sequence[str] = (),
    *,
    admin: bool = False,
    predicate: Column | None = None,
    page_size: int,
    page_index: int = 0,
) -> DataFrame:
    """One page of full documents by falling score, with ``score`` and ``position``.

    Only documents that match the query and the predicate count.  Scores are
    those of the whole corpus; the predicate and the ACL then take rows away.
    Until the page is cut only keys and scores move, and the documents' scan
    reads what the predicate and the ACL name; documents are fetched for the
    page alone.
    """
    found = df if predicate is None else df.where(predicate)
    readable = acl_filter(found, principals, admin=admin).select(*m.KEY)
    scored = terms.ranked(query).join(readable, m.KEY, "left_semi")
    return hydrate(scored, df, page_size, page_index)
