"""Relevance: TF-IDF with statistics of the whole corpus and field boosts.

    score = Σ over fields and terms of
            sqrt(tf) · (1 + ln(N / (df + 1)))² · boost / sqrt(field length)

Access control never changes a score: it filters rows that are scored already.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliosearch import model as m
from foliosearch.operators.analysis import analyze, analyze_fields, by_document, postings, stack_fields
from foliosearch.operators.fulltext import FullTextQuery, position_flags

SCORE_DIGITS = 6

SIGN = "sign"


def _weight(tf: Column, df: Column, total: Column, boost: Column, length: Column) -> Column:
    idf = F.lit(1.0) + F.log(total / (df + 1))
    return F.sqrt(tf.cast("double")) * idf * idf * boost / F.sqrt(length.cast("double"))


def score_text(
    df: DataFrame,
    keep: Sequence[str],
    terms: Sequence[str],
    boosts: Mapping[str, float] = m.FIELD_BOOSTS,
    language: str = "fulltext",
) -> DataFrame:
    """``(*keep, score)`` for every document that holds one of the terms.

    Straight from the text, in one pass: lengths and frequencies of all fields
    and terms are conditional counts of a single grouping by document, so tasks
    shuffle one small row per document instead of its words.  The corpus counts
    come back as one-row scalar subqueries over the same grouping.
    """
    keep = list(keep)
    terms = sorted(set(terms))
    if not terms:
        return df.select(*keep, F.lit(0.0).alias("score")).where(F.lit(False))
    fields = {f"f{number}": name for number, name in enumerate(boosts)}
    weights = {f"f{number}": float(boost) for number, boost in enumerate(boosts.values())}

    lengths = [F.count_if(F.col("field") == field).alias(f"{field}_length") for field in fields]
    frequencies = [
        F.count_if((F.col("field") == field) & (F.col("term") == term)).alias(f"{field}_tf{number}")
        for field in fields
        for number, term in enumerate(terms)
    ]
    per_document = (
        analyze_fields(df, keep, fields, language).groupBy(*keep).agg(*lengths, *frequencies)
    )
    names = [f"{field}_tf{number}" for field in fields for number in range(len(terms))]
    # The lengths are counted along, so that both uses of the grouping need the
    # same columns and Spark runs it once (a reused exchange).
    found = F.struct(
        *[F.count_if(F.col(name) > 0).alias(name) for name in names],
        *[F.sum(f"{field}_length").alias(f"{field}_length") for field in fields],
    )
    statistics = per_document.agg(found.alias("statistics")).scalar()
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()

    scored = per_document.where(F.greatest(F.lit(0), *[F.col(name) for name in names]) > 0)
    scored = scored.withColumns({"statistics": statistics, "total": total})
    parts = [
        F.when(
            F.col(f"{field}_tf{number}") > 0,
            _weight(
                F.col(f"{field}_tf{number}"),
                F.col("statistics").getField(f"{field}_tf{number}"),
                F.col("total"),
                F.lit(weights[field]),
                F.col(f"{field}_length"),
            ),
        ).otherwise(F.lit(0.0))
        for field in fields
        for number in range(len(terms))
    ]
    return scored.select(*keep, F.round(sum(parts[1:], parts[0]), SCORE_DIGITS).alias("score"))


def field_postings(
    df: DataFrame,
    keep: Sequence[str],
    fields: Sequence[str] = tuple(m.FIELD_BOOSTS),
    language: str = "fulltext",
    documents: int | None = None,
) -> DataFrame:
    """``(*keep, field, term, tf, length)``: what an index keeps for scoring.

    ``length`` is the field's number of terms, summed over the document's own
    postings.  Texts are partitioned by document first; that is the only shuffle.
    ``documents`` is the number of rows, if it is known.
    """
    keep = list(keep)
    texts = by_document(df.select(*keep, *fields), keep, documents)
    return _with_lengths(analyze_fields(texts, keep, {name: name for name in fields}, language), keep)


def _with_lengths(terms: DataFrame, keep: list[str]) -> DataFrame:
    """Sorted by the narrow part of the key first, where most comparisons end."""
    counted = postings(terms, [*keep, "field"])
    return counted.withColumn("length", F.sum("tf").over(Window.partitionBy(*reversed(keep), "field")))


def difference_postings(
    df: DataFrame,
    keep: Sequence[str],
    fields: Sequence[str] = tuple(m.FIELD_BOOSTS),
    language: str = "fulltext",
    documents: int | None = None,
) -> DataFrame:
    """``(*keep, sign, field, term, tf, length)`` of documents that came or left (``sign``).

    A field whose texts come as often as they leave adds nothing and is not analysed: a
    new title does not have the whole document analysed twice.  Where any text of a field
    differs, all rows of the document have theirs, since postings of a key that comes
    several times are counted together.  Texts are partitioned by document first; that
    is the only shuffle.
    """
    keep = list(keep)
    texts = by_document(df.select(*keep, SIGN, *fields), keep, documents)
    stacked = stack_fields(texts, [*keep, SIGN], {name: name for name in fields}).where("text IS NOT NULL")
    net = F.sum(SIGN).over(Window.partitionBy(*keep, "field", "text"))
    differs = F.bool_or(F.col("net") != 0).over(Window.partitionBy(*keep, "field"))
    changed = stacked.withColumn("net", net).withColumn("differs", differs).where("differs")
    return _with_lengths(analyze(changed, [*keep, SIGN, "field"], "text", language), [SIGN, *keep])


def field_statistics(posted: DataFrame) -> DataFrame:
    """``(field, term, df)`` over the whole corpus."""
    return posted.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))


def net_postings(posted: DataFrame, keep: Sequence[str] = tuple(m.KEY)) -> DataFrame:
    """Postings that are left when those with sign -1 take away earlier ones.

    Rows are dealt by document, which is the only shuffle here and serves a grouping
    by document that follows.  There is nothing to combine before it: a posting
    comes once for each time that its document came or left.
    """
    count = F.sum(SIGN)
    net = (
        posted.repartition(*keep)
        .groupBy(*keep, "field", "term")
        .agg(count.alias("held"), F.sum(F.col("tf") * F.col(SIGN)).alias("tf"), F.sum(F.col("length") * F.col(SIGN)).alias("length"))
    )
    return net.where("held > 0").drop("held")


def _weighted(posted: DataFrame, statistics: DataFrame, total: int, terms: Sequence[str], keep: Sequence[str], boosts: Mapping[str, float]) -> DataFrame:
    """Postings of terms with ``weight``; both sides are filtered by the terms at the scan.

    The statistics left hold one row per field and term of the query, which
    bounds the broadcast.
    """
    wanted = F.col("term").isin(*sorted(set(terms))) & F.col("field").isin(*boosts)
    boost = F.lit(0.0)
    for name, value in boosts.items():
        boost = F.when(F.col("field") == name, F.lit(float(value))).otherwise(boost)
    weight = _weight(F.col("tf"), F.col("df"), F.lit(total), boost, F.col("length"))
    named = posted.where(wanted)
    found = net_postings(named, keep) if SIGN in posted.columns else named
    frequencies = statistics.where(wanted).groupBy("field", "term").agg(F.sum("df").alias("df"))
    return found.join(F.broadcast(frequencies), ["field", "term"]).withColumn("weight", weight)


def score_postings(
    posted: DataFrame,
    statistics: DataFrame,
    total: int,
    keep: Sequence[str],
    terms: Sequence[str],
    boosts: Mapping[str, float] = m.FIELD_BOOSTS,
) -> DataFrame:
    """``(*keep, score)`` from materialised postings and statistics.

    Postings may have signs, and statistics may come in parts; both are summed.
    """
    weighted = _weighted(posted, statistics, total, terms, keep, boosts)
    return weighted.groupBy(*keep).agg(F.round(F.sum("weight"), SCORE_DIGITS).alias("score"))


def match_postings(
    posted: DataFrame,
    statistics: DataFrame,
    total: int,
    keep: Sequence[str],
    query: FullTextQuery,
    boosts: Mapping[str, float] = m.FIELD_BOOSTS,
) -> DataFrame:
    """``(*keep, score)`` of the documents that match a query, in one reading of the postings.

    Terms that only exclude have no part in the score.
    """
    if not query.required:
        return posted.select(*keep, F.lit(0.0).alias("score")).where(F.lit(False))
    weighted = _weighted(posted, statistics, total, query.all_terms, keep, boosts)
    flags, matches = position_flags(query)
    scored = F.when(F.col("term").isin(*query.required_terms), F.col("weight"))
    grouped = weighted.groupBy(*keep).agg(F.round(F.sum(scored), SCORE_DIGITS).alias("score"), *flags)
    return grouped.where(matches).select(*keep, "score")
