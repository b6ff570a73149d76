"""Facets: several named bucket counts over all matches, in one pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Groups that the values of a long terms facet are cut in first.
SALTS = 256


@dataclass(frozen=True)
class Facet:
    """A named way to put a row into a bucket; a null bucket is not counted."""

    agg_id: str
    column: str
    bucket: Column
    top: int | None = None
    several: bool = False  # the bucket is an array of all buckets the row is in


def terms_facet(agg_id: str, column: str, top: int = 10) -> Facet:
    """The most frequent values, ties by value; each value of an array counts."""
    return Facet(agg_id, column, F.col(column), top)


def range_facet(agg_id: str, column: str, ranges: Sequence[tuple[str, float | None, float | None]]) -> Facet:
    """Buckets ``(key, from, to)``: from is included, to is not, None is open.

    Ranges may overlap; a row counts in each that it lies in.
    """
    return _ranges(agg_id, column, [(key, low, high) for key, low, high in ranges], F.lit)


def _ranges(agg_id: str, column: str, ranges: Sequence[tuple], bound: Callable[[object], Column]) -> Facet:
    keys = []
    for key, low, high in ranges:
        inside = F.col(column).isNotNull()
        if low is not None:
            inside = inside & (F.col(column) >= bound(low))
        if high is not None:
            inside = inside & (F.col(column) < bound(high))
        keys.append(F.when(inside, key))
    return Facet(agg_id, column, F.array_compact(F.array(*keys)), several=True)


def date_range_facet(agg_id: str, column: str, ranges: Sequence[tuple[str, str | None, str | None]]) -> Facet:
    """The same for days given as ``yyyy-mm-dd``."""
    return _ranges(agg_id, column, ranges, lambda day: F.to_date(F.lit(day)))


def histogram_facet(agg_id: str, column: str, interval: int) -> Facet:
    """Buckets of equal width, keyed by their lower bound."""
    return Facet(agg_id, column, F.floor(F.col(column) / interval).cast("long") * interval)


def date_histogram_facet(agg_id: str, column: str, unit: str) -> Facet:
    """Calendar buckets (``year``, ``month``, ``week``, ``day``), keyed by first day."""
    return Facet(agg_id, column, F.date_format(F.date_trunc(unit, F.col(column)), "yyyy-MM-dd"))


def _bucket(facet: Facet, key: Column) -> Column:
    return F.struct(F.lit(facet.agg_id).alias("agg_id"), key.cast("string").alias("bucket_key"))


def _buckets(facet: Facet, multi_valued: bool) -> Column:
    """The buckets of a row as an array; empty where it has none."""
    keys = F.array_distinct(facet.bucket) if multi_valued else F.array(facet.bucket)
    buckets = F.transform(keys, lambda key: _bucket(facet, key))
    return F.coalesce(buckets, F.array().cast("array<struct<agg_id:string,bucket_key:string>>"))


def stacked_buckets(df: DataFrame, wanted: Sequence[Facet]) -> Column:
    """All buckets of a row, of every facet, as one array of ``(agg_id, bucket_key)``."""
    if len({facet.agg_id for facet in wanted}) < len(wanted):
        raise ValueError("facet ids must differ")
    multi_valued = {
        field.name for field in df.schema if isinstance(field.dataType, T.ArrayType)
    }
    if any(facet.several or facet.column in multi_valued for facet in wanted):
        return F.flatten(F.array(*[_buckets(facet, facet.several or facet.column in multi_valued) for facet in wanted]))
    return F.array(*[_bucket(facet, facet.bucket) for facet in wanted])


def facets(df: DataFrame, wanted: Sequence[Facet]) -> DataFrame:
    """``(agg_id, bucket_key, doc_count)`` of every facet over all rows of ``df``.

    A row becomes its buckets inside the scan stage, and tasks count them
    before the one shuffle, so even a bucket that takes every row arrives as one
    partial count per task.  The top of a terms facet is cut inside each task
    before its ranking, so no task ever ranks all values.
    """
    counts = (
        df.select(F.explode(stacked_buckets(df, wanted)).alias("bucket"))
        .select("bucket.agg_id", "bucket.bucket_key")
        .where(F.col("bucket_key").isNotNull())
        .groupBy("agg_id", "bucket_key")
        .agg(F.count(F.lit(1)).alias("doc_count"))
    )
    return top_buckets(counts, wanted)


def top_buckets(counts: DataFrame, wanted: Sequence[Facet]) -> DataFrame:
    """Counted buckets without those beyond the top of a terms facet; other columns stay."""
    tops = {facet.agg_id: facet.top for facet in wanted if facet.top is not None}
    return _top_values(counts, tops) if tops else counts


def _top_values(counts: DataFrame, tops: dict[str, int]) -> DataFrame:
    """The first values of the facets in ``tops``, and all buckets of the others.

    Buckets of other facets rank first in a partition of their own, so one
    ranking serves all.  Spark cuts partitions down to a constant rank inside the
    tasks before it shuffles them; past the rank up to which it does, values are
    cut within salted groups first.
    """
    highest = max(tops.values())
    is_terms = F.col("agg_id").isin(*tops)
    limit = F.lit(1)
    for agg_id, top in tops.items():
        limit = F.when(F.col("agg_id") == agg_id, top).otherwise(limit)
    ranked = counts.withColumn("group", F.when(~is_terms, F.col("bucket_key")))

    def cut(df: DataFrame, *group: Column | str) -> DataFrame:
        order = Window.partitionBy("agg_id", "group", *group).orderBy(F.desc("doc_count"), "bucket_key")
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= highest)

    if highest > int(counts.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        ranked = cut(ranked, F.pmod(F.xxhash64("bucket_key"), F.lit(SALTS))).drop("rank")
    return cut(ranked).where(F.col("rank") <= limit).drop("rank", "group")
