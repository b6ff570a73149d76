"""Full-text search: every word of the query, none of the ``-excluded`` ones."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliosearch.operators.analysis import analyze

# A clause is one word of the query: a list of positions, each a list of
# alternative terms.  It matches where every position has one of its terms.
Clause = list[list[str]]


@dataclass(frozen=True)
class FullTextQuery:
    required: list[Clause]
    excluded: list[Clause]

    @property
    def required_terms(self) -> list[str]:
        return sorted({term for clause in self.required for position in clause for term in position})

    @property
    def all_terms(self) -> list[str]:
        excluded = {term for clause in self.excluded for position in clause for term in position}
        return sorted(excluded.union(self.required_terms))


def fulltext_query(spark: SparkSession, text: str, language: str = "fulltext") -> FullTextQuery:
    """Analyse a query's words as the documents were analysed.

    What comes back to the driver is the query's own handful of terms; as
    literals they can be pushed into the scan of a term table.
    """
    pieces = [
        (number, piece.startswith("-"), piece.lstrip("-"))
        for number, piece in enumerate(text.split())
        if piece.lstrip("-")
    ]
    if not pieces:
        return FullTextQuery([], [])
    rows = analyze(
        spark.createDataFrame(pieces, "clause int, negative boolean, text string"),
        ["clause", "negative"],
        "text",
        language,
    ).collect()
    clauses: dict[tuple, dict[tuple, set[str]]] = {}
    for row in rows:
        positions = clauses.setdefault((row.clause, row.negative), {})
        positions.setdefault((row.pos, row.part), set()).add(row.term)
    required, excluded = [], []
    for (_, negative), positions in sorted(clauses.items()):
        clause = [sorted(terms) for _, terms in sorted(positions.items())]
        (excluded if negative else required).append(clause)
    return FullTextQuery(required, excluded)


def _all(columns: list[Column]) -> Column:
    return reduce(and_, columns, F.lit(True))


def _any(columns: list[Column]) -> Column:
    return reduce(or_, columns, F.lit(False))


def _matches(query: FullTextQuery, found) -> Column:
    """The condition of a query, given how to test one position."""
    if not query.required and not query.excluded:
        return F.lit(False)
    required = _all([found(position) for clause in query.required for position in clause])
    excluded = _any([_all([found(position) for position in clause]) for clause in query.excluded])
    return required & ~excluded


def fulltext_match(query: FullTextQuery, terms: str) -> Column:
    """A predicate on a column that holds a document's terms as an array.

    It goes beside any other predicate and needs no join or shuffle.  The
    column is named once, in a lambda of its own: were it still to be computed,
    several mentions would compute it several times.
    """
    column = F.coalesce(F.col(terms), F.array().cast("array<string>"))

    def condition(held: Column) -> Column:
        return _matches(query, lambda position: F.arrays_overlap(held, F.array(*[F.lit(term) for term in position])))

    return F.exists(F.array(column), condition)


def position_flags(query: FullTextQuery) -> tuple[list[Column], Column]:
    """Aggregates over a document's terms, one for each position of a query, and the
    condition on them that makes the document match."""
    found: dict[tuple, str] = {}
    for clause in query.required + query.excluded:
        for position in clause:
            found.setdefault(tuple(position), f"position_{len(found)}")
    flags = [F.max(F.col("term").isin(*position)).alias(name) for position, name in found.items()]
    return flags, _matches(query, lambda position: F.col(found[tuple(position)]))


def fulltext_keys(terms: DataFrame, keep: list[str], query: FullTextQuery) -> DataFrame:
    """Keys of the documents that match, from a term or posting table.

    Rows of other terms are dropped at the scan, exclusions are decided in the
    same grouping as requirements, and tasks combine a document's rows before
    the shuffle.  Needs at least one required word; ``search_fulltext`` takes
    queries of exclusions only.
    """
    if not query.required:
        return terms.select(*keep).where(F.lit(False))
    flags, matches = position_flags(query)
    return (
        terms.where(F.col("term").isin(*query.all_terms))
        .groupBy(*keep)
        .agg(*flags)
        .where(matches)
        .select(*keep)
    )


def search_fulltext(df: DataFrame, terms: DataFrame, keep: list[str], query: FullTextQuery) -> DataFrame:
    """The documents of ``df`` that match a query over their term table."""
    if query.required:
        return df.join(fulltext_keys(terms, keep, query), keep, "left_semi")
    if query.excluded:
        unwanted = [fulltext_keys(terms, keep, FullTextQuery([clause], [])) for clause in query.excluded]
        return reduce(lambda rest, keys: rest.join(keys, keep, "left_anti"), unwanted, df)
    return df.where(F.lit(False))
