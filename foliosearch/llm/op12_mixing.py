"""Mixing sources to target weights by repeating and leaving out documents.

Tokens are summed by source.  All tokens are shared out by weight; no source
stands for more than ``most`` times its own tokens, and what it cannot take is
shared among the others by weight, until none is above.  So there is one level
with target = min(most x tokens, level x weight) for every source.  Sources in
the order of the ratio of their limit to their weight are limited up to one place
and free from there on, which running sums of limits and weights tell.

A source's repetition rate is its target by its tokens.  A document is
emitted floor(rate) times, and once more if a number in [0, 1), taken from a hash
of the seed and the document's id, is below the rest of the rate.  The same id
has the same number in every run.

Only one row per source is shuffled by source, and sources are ordered by
ranges: no task holds all of them.  Documents meet their source's row in a join
that Spark broadcasts while it is small and splits where a source is hot; a
copy is made where its document is, without a shuffle.

Weights are positive integers: a cycle over the sources in the order of their
code points, null last, or a table (source, weight) in which a source without a
row has weight 0.

Defined cases: a null or empty text, or one without words, has size 0; it is
repeated like others of its source.  A source without any word, or of weight 0, has
target 0 and none of its documents is emitted.  If the weighted sources together
cannot take all tokens, each takes ``most`` times its own.  A null source is a
source, a null id an id.  Rows with equal ids share their number, so repeated
rows are copied together.  An empty table gives an empty table.  Columns may
have any names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliosearch.llm.batches import free_names
from foliosearch.session import discard, scratch_path

SEED = "mix"
MOST = 3
WEIGHTS = (1, 2, 3)
WORD = r"[^\x20\x09-\x0D]+"
DIGITS = 13  # hexadecimal digits of the hash: 52 bits, exact in a double


def word_count(text: Column) -> Column:
    """Words of a text, by ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_number(id_: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) for an id, equally likely everywhere."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") / F.lit(float(16**DIGITS))


def running_sums(rows: DataFrame, order: Sequence[Column], sums: dict[str, str], path: str) -> DataFrame:
    """``rows`` with sums of columns over all rows before each, in an order without ties.

    Rows are dealt out by ranges and summed within each range; a range then adds
    what the ranges before it hold, which is one row for each.  ``path`` is a new
    folder, to be kept as long as the result is read.
    """
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(partitions, *order).withColumn("range", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    own = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("range").agg(*[F.sum(column).alias(f"of_{name}") for name, column in sums.items()])
    # One row for each partition of the shuffle, whatever the data.
    ahead = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("range", *[F.coalesce(F.sum(f"of_{name}").over(ahead), F.lit(0)).alias(f"of_{name}") for name in sums])
    return (
        rows.withColumns({name: F.coalesce(F.sum(column).over(own), F.lit(0)) for name, column in sums.items()})
        .join(F.broadcast(ranges), "range")
        .withColumns({name: F.col(name) + F.col(f"of_{name}") for name in sums})
        .drop("range", *[f"of_{name}" for name in sums])
    )


def source_targets(sizes: DataFrame, weights: Sequence[int] | DataFrame = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from a table (source, source_size)."""
    spark = sizes.sparkSession
    sizes = sizes.select("source", "source_size")
    by_name, by_limit, path = (scratch_path(spark, f"sources-{k}") for k in ("name", "limit", "weight"))
    if isinstance(weights, DataFrame):
        of = weights.select(F.col("source").alias("of"), F.col("weight").cast("long"))
        weighted = sizes.join(of, F.col("source").eqNullSafe(F.col("of")), "left")
        weighted = weighted.select("source", "source_size", F.coalesce("weight", F.lit(0)).alias("weight"))
    else:
        counted = sizes.withColumn("one", F.lit(1).cast("long"))
        numbered = running_sums(counted, [F.col("source").asc_nulls_last()], {"number": "one"}, by_name)
        cycle = F.array(*[F.lit(w).cast("long") for w in weights])
        weighted = numbered.withColumn("weight", F.get(cycle, (F.col("number") % len(weights)).cast("int"))).drop("number", "one")
    weighted.withColumn("most", F.when(F.col("weight") > 0, F.col("source_size") * most).otherwise(0)).write.parquet(path)
    weighted = spark.read.parquet(path)

    # Limited sources come first in this order: their limit is below what the
    # tokens left, shared by the weights left, would give them.
    order = [(F.col("most") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    placed = running_sums(weighted.where("weight > 0"), order, {"taken": "most", "weight_before": "weight"}, by_limit)
    whole = weighted.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("weight"), F.lit(0)).alias("weight")).first()
    left, weight_left = F.lit(whole.tokens) - F.col("taken"), F.lit(whole.weight) - F.col("weight_before")
    free = placed.where(_product(left, F.col("weight")) <= _product(F.col("most"), weight_left))
    # All free sources share one level: that of the first of them.
    level = free.agg(F.min_by(F.struct(left.alias("tokens"), weight_left.alias("weight")), "weight_before").alias("level")).first().level
    for done in (by_name, by_limit):
        discard(spark, done)
    target = F.col("most").cast("double")
    if level is not None:  # else none is free: all take the most
        tokens, weight = F.lit(level.tokens), F.lit(level.weight)
        limited = _product(F.col("most"), weight) < _product(tokens, F.col("weight"))
        target = F.when(limited, target).otherwise(tokens * F.col("weight") / weight)
    return weighted.select("source", "source_size", F.when(F.col("weight") > 0, target).otherwise(0.0).alias("target"))


def _product(a: Column, b: Column) -> Column:
    """Exact, whatever the tokens and the number of sources."""
    return a.cast("decimal(19,0)") * b.cast("decimal(19,0)")


def _copies(id_: Column, size: str, target: str, seed: str) -> Column:
    """How often a document of a source with this size and target is taken."""
    rate = F.when(F.col(size) > 0, F.col(target) / F.col(size)).otherwise(0.0)
    return F.floor(rate) + F.when(unit_number(id_, seed) < rate - F.floor(rate), 1).otherwise(0)


def plan_mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    id_: str = "doc_id",
    weights: Sequence[int] | DataFrame = WEIGHTS,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """(id, size, source_size, target, copies) for every row: how often the mix takes it."""
    spark = docs.sparkSession
    path = scratch_path(spark, "sizes")
    docs.select(F.col(id_).alias("id"), F.col(source).cast("string").alias("source"), word_count(F.col(text).cast("string")).alias("size")).write.parquet(path)
    sized = spark.read.parquet(path)
    sources = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    sources = sources.withColumnRenamed("source", "of")
    planned = sized.join(sources, F.col("source").eqNullSafe(F.col("of")))
    return planned.select("id", "size", "source_size", "target", _copies(F.col("id"), "source_size", "target", seed).alias("copies"))


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    id_: str = "doc_id",
    weights: Sequence[int] | DataFrame = WEIGHTS,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` as the mix has them: each row as often as it is taken, with its own columns.

    Only (source, size) is read for the rates, and documents are not shuffled to
    be copied unless the sources are too many to broadcast.
    """
    sizes = docs.select(F.col(source).cast("string").alias("source"), word_count(F.col(text).cast("string")).alias("size"))
    sources = source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    of, own_size, target, copy = free_names(docs.columns, "of", "source_size", "target", "copy")
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "targets")
    sources.select(F.col("source").alias(of), F.col("source_size").alias(own_size), F.col("target").alias(target)).write.parquet(path)
    rows = docs.join(spark.read.parquet(path), F.col(source).cast("string").eqNullSafe(F.col(of)))
    copies = _copies(F.col(id_), own_size, target, seed)
    return rows.withColumn(copy, F.explode(F.array_repeat(F.lit(1), copies.cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])
