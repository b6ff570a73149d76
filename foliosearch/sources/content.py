"""Where documents come from: the content view and whole repositories."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliosearch import model as m


def table(spark: SparkSession, folder: str, name: str, spread_by: str | None = None) -> DataFrame:
    """A table of a data folder; ``spread_by`` names its key.

    Work that is heavy on each row, as text analysis is, should not wait for
    the few cores that small files occupy.  Up to two splits per core Spark cuts
    files finer than their row groups, so most splits may be empty; then rows are
    spread by key first, and the grouping by key that follows needs no shuffle of
    its own.  With more splits, rows stay where they are read.
    """
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    if spread_by is None:
        return rows
    cores = spark.sparkContext.defaultParallelism
    # A bare scan: counting its splits runs nothing.
    return rows if rows.rdd.getNumPartitions() > 2 * cores else rows.repartition(2 * cores, spread_by)


def _words(*values: str):
    return F.array(*[F.lit(value) for value in values])


def content(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """Every document of a data folder as rows of ``CONTENT_SCHEMA``.

    ``spread=True`` prepares few files for heavy work, as in ``table``.

    The labels are grouped by document first.  One label row per document is
    then a known fact, and Catalyst drops the join from every query that does
    not read the life-cycle state.
    """
    documents = table(spark, folder, "documents", "doc_id" if spread else None)
    labels = (
        table(spark, folder, "labels")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"), F.max("quality").alias("quality"))
        .withColumn("labelled", F.lit(True))
    )
    rows = documents.join(labels, "doc_id", "left")

    number = F.col("doc_id")
    text_number = number.cast("string")
    folder_path = F.concat(F.lit("/"), F.col("source"), F.lit("/"), F.col("lang"))
    day = F.date_add(F.lit("2016-01-01").cast("date"), (number % 730).cast("int"))
    kind = (
        F.when(number % 5 == 0, "Note")
        .when(number % 5 == 1, "Article")
        .when(number % 5 == 2, "File")
        .when(number % 5 == 3, "Picture")
        .otherwise("Folder")
    )
    columns = {
        m.REPOSITORY: F.when(number % 10 == 0, "archive").otherwise("default"),
        m.UUID: F.concat(F.lit("doc-"), text_number),
        m.PATH: F.concat(folder_path, F.lit("/"), text_number),
        m.PRIMARY_TYPE: kind,
        m.STATE: F.when(F.col("toxic") == 1, "deleted")
        .when(F.col("quality") == 1, "approved")
        .when(F.col("labelled"), "project"),
        m.PARENT_ID: folder_path,
        m.ANCESTOR_IDS: F.array(F.concat(F.lit("/"), F.col("source")), folder_path),
        m.VERSION_LABEL: F.concat((number % 4).cast("string"), F.lit("."), (number % 10).cast("string")),
        m.MIXINS: F.when(number % 17 == 0, F.lit(None))
        .when(number % 4 == 0, _words("Folderish", "Commentable"))
        .when(number % 3 == 0, _words("HiddenInNavigation"))
        .otherwise(_words("Downloadable", "Versionable")),
        m.CHANGE_TOKEN: F.concat(F.lit("ct-"), text_number),
        m.ACL: F.when(number % 19 == 0, F.lit(None))
        .when(number % 4 == 0, _words("Everyone", "members"))
        .when(number % 4 == 1, _words("members"))
        .when(number % 4 == 2, _words("staff", "administrators"))
        .otherwise(F.array(F.concat(F.lit("user-"), (number % 50).cast("string")))),
        m.IS_VERSION: number % 11 == 0,
        m.IS_PROXY: number % 13 == 0,
        m.IS_CHECKED_IN: number % 9 == 0,
        m.POS: (number % 100).cast("int"),
        m.BINARY_TEXT: F.col("text"),
        m.TITLE: F.substring("text", 1, 60),
        m.DESCRIPTION: F.substring("text", 61, 200),
        m.SUBJECTS: F.when(
            number % 6 != 0, F.array(F.col("lang"), F.concat(F.lit("topic"), (number % 8).cast("string")))
        ),
        m.CREATED: day.cast("timestamp"),
        m.EXPIRED: F.when(number % 3 == 0, F.date_add(day, 365).cast("timestamp")),
        m.MODIFIED: day.cast("timestamp"),
        m.ISSUED: day,
        m.NOTE: F.col("text"),
        m.ICON: F.concat(F.lit("/icons/"), F.lower(kind), F.lit(".gif")),
        m.WEB_ID: F.concat(F.lit("web-"), text_number),
        m.RECORD_VARIABLES: F.create_map(
            F.lit("source"), F.initcap("source"), F.lit("lang"), F.upper("lang")
        ),
        m.THUMBNAIL: F.when(
            number % 5 == 3, F.create_map(F.lit("name"), F.concat(F.lit("thumb-"), text_number))
        ),
        m.PICTURE_VIEWS: F.when(
            number % 5 == 3, F.create_map(F.lit("title"), F.concat(F.lit("view-"), text_number))
        ),
    }
    return rows.select(*[columns[field.name].alias(field.name) for field in m.CONTENT_SCHEMA])


def in_repository(df: DataFrame, repository: str) -> DataFrame:
    """One repository: a partition filter on an index table."""
    return df.where(F.col(m.REPOSITORY) == repository)


def all_repositories(frames: Sequence[DataFrame]) -> DataFrame:
    """Several repositories as one; a column missing from one reads as null."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def concatenate(batches: Sequence[DataFrame]) -> DataFrame:
    """Result batches one after another, duplicates kept."""
    return reduce(lambda left, right: left.unionByName(right), batches)


def fetch_source(
    df: DataFrame, include: Sequence[str] | None = None, exclude: Sequence[str] = tuple(m.SOURCE_EXCLUDES)
) -> DataFrame:
    """The stored columns of a hit: all of them, or those named, less the excluded.

    Columns derived for the index are never stored fields.
    """
    names = [
        name
        for name in df.columns
        if name not in exclude
        and not name.startswith(m.DERIVED_PREFIX + ":")
        and (include is None or name in include)
    ]
    return df.select(*[F.col(f"`{name}`") for name in names])
