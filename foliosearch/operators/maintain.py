"""Rebuilding an index, wholly or in part, as a function of tables.

Each function takes the index as it stands and the source documents, and
returns either the index as it should be, or (``…_changes``) only the rows to
change.  ``plans.index_table`` stores the outcome.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliosearch import model as m

log = logging.getLogger(__name__)

INSERT = "INSERT"
DELETE = "DELETE"
SEQUENCE = "change_seq"
CHANGE = "change_type"

COMMAND_SCHEMA = "seq bigint, type string, docId string, repo string, recurse boolean, sync boolean"

# A command's text where it could not be read, and why a command is refused.
UNREADABLE = "unreadable"
REASON = "reason"

# The order of commands on a document; the newest one counts, in whatever batch it came.
ORDER = "command_order"
RECURSIVE = "recursive"
KEY_SCHEMA = f"`{m.REPOSITORY}` string, `{m.UUID}` string"
NUMBER_SCHEMA = f"{KEY_SCHEMA}, {ORDER} bigint, {RECURSIVE} boolean"
DIFFERING_SCHEMA = f"{KEY_SCHEMA}, type string"


def _in_repository(repository: str) -> Column:
    """Never null, so its negation takes the documents without a repository."""
    return F.col(m.REPOSITORY).eqNullSafe(F.lit(repository))


def in_subtree(root_id: str) -> Column:
    """The root or anything below it; never null."""
    below = F.array_contains(m.ANCESTOR_IDS, root_id)
    return F.coalesce(F.col(m.UUID) == root_id, F.lit(False)) | F.coalesce(below, F.lit(False))


def reindex_all(index: DataFrame, source: DataFrame, repository: str) -> DataFrame:
    """One repository rebuilt from its source, the others untouched.

    Two filters and a union: no shuffle, and the old rows of the repository's
    partition are not even read.
    """
    kept = index.where(~_in_repository(repository))
    return kept.unionByName(source.where(_in_repository(repository)))


def subtree(rows: DataFrame, repository: str, root_id: str) -> DataFrame:
    return rows.where(_in_repository(repository)).where(in_subtree(root_id))


def subtree_of_live_root(source: DataFrame, repository: str, root_id: str) -> DataFrame:
    """The root and its subtree, or nothing once the root is gone."""
    here = source.where(_in_repository(repository))
    root_exists = here.where(F.col(m.UUID) == root_id).agg((F.count(F.lit(1)) > 0).alias("exists")).scalar()
    return here.where(in_subtree(root_id)).where(root_exists)


def reindex_subtree(index: DataFrame, source: DataFrame, repository: str, root_id: str | None) -> DataFrame:
    """A subtree rebuilt: its rows deleted, then inserted anew if the root lives.

    Subtrees are told by the ancestors in each row, so this too is filters and
    a union.  A blank root changes nothing.
    """
    if not root_id or not root_id.strip():
        log.warning("subtree rebuild asked for without a root: nothing is done")
        return index
    kept = index.where(~(_in_repository(repository) & in_subtree(root_id)))
    return kept.unionByName(subtree_of_live_root(source, repository, root_id))


def reindex_query(
    index: DataFrame, source: DataFrame, repository: str, predicate: Column | None
) -> DataFrame:
    """The documents that a predicate selects in the source, upserted.

    Rows of the index that are not selected stay, also where their document
    would no longer be selected.  No predicate changes nothing.
    """
    if predicate is None:
        log.warning("rebuild by query asked for without a query: nothing is done")
        return index
    selected = source.where(_in_repository(repository)).where(predicate)
    return index.join(selected.select(*m.KEY), m.KEY, "left_anti").unionByName(selected)


def subtree_changes(index: DataFrame, source: DataFrame, repository: str, root_id: str) -> DataFrame:
    """The rows a subtree rebuild changes: all there was is deleted, all there
    is is inserted.  Where a document has both, the insertion counts."""
    gone = subtree(index, repository, root_id).select(*m.KEY)
    found = subtree_of_live_root(source, repository, root_id)
    return _changes(gone, found)


def _changes(gone: DataFrame, found: DataFrame) -> DataFrame:
    deleted = gone.select(*m.KEY, F.lit(DELETE).alias(CHANGE))
    return found.withColumn(CHANGE, F.lit(INSERT)).unionByName(deleted, allowMissingColumns=True)


def content_digest(df: DataFrame, language: str = "") -> Column:
    """The digest of a source row: of all its columns but derived ones, and of the language
    its terms are derived by.  Null values and missing ones differ."""
    names = sorted(name for name in df.columns if not name.startswith(m.DERIVED_PREFIX + ":"))
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    text = F.to_json(F.struct(*[F.col(f"`{name}`") for name in names]), options)
    return F.sha2(F.concat_ws("\n", F.lit(language), text), 256)


def differing(held: DataFrame, found: DataFrame) -> DataFrame:
    """``(key, type)``: what is to be done so that ``held`` becomes ``found``; both are ``(key, digest)``.

    A document that is the same on both sides isn't named.  One grouping of keys and
    digests, combined inside the tasks.  Documents without an id can't be told from
    each other and are left alone; one that comes several times is written anew.
    """
    sides = held.select(*m.KEY, m.DIGEST, F.lit(True).alias("old")).unionByName(found.select(*m.KEY, m.DIGEST, F.lit(False).alias("old")))
    told = (
        sides.where(F.col(m.UUID).isNotNull() & F.col(m.REPOSITORY).isNotNull())
        .groupBy(*m.KEY)
        .agg(F.count_if("old").alias("held"), F.count_if(~F.col("old")).alias("found"), F.min(m.DIGEST).alias("low"), F.max(m.DIGEST).alias("high"))
    )
    same = (F.col("held") == 1) & (F.col("found") == 1) & (F.col("low") == F.col("high"))
    return told.where(~same).select(*m.KEY, F.when(F.col("found") > 0, INSERT).otherwise(DELETE).alias("type"))


def query_changes(source: DataFrame, repository: str, predicate: Column) -> DataFrame:
    """The rows a rebuild by query changes: insertions."""
    selected = source.where(_in_repository(repository)).where(predicate)
    return selected.withColumn(CHANGE, F.lit(INSERT))


def checked_commands(commands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Commands to apply, and those to refuse with the reason."""
    unreadable = F.col(UNREADABLE).isNotNull() if UNREADABLE in commands.columns else F.lit(False)
    reason = (
        F.when(unreadable, "unreadable")
        .when(F.col("type").isNull() | ~F.col("type").isin(INSERT, DELETE), "unknown type")
        .when(F.col("docId").isNull(), "no document")
        .when(F.col("repo").isNull(), "no repository")
        .when(F.col("seq").isNull(), "no number")
    )
    judged = commands.withColumn(REASON, reason)
    return judged.where(F.col(REASON).isNull()).drop(REASON, UNREADABLE), judged.where(F.col(REASON).isNotNull())


def _order(kind: Column) -> Column:
    """Numbers as one order: of a deletion and an insertion with one number, the
    insertion comes later.  The type rides in the lowest bit."""
    return F.col("seq") * 2 + (kind == INSERT).cast("long")


def _recursive_roots(commands: DataFrame, kind: str) -> DataFrame:
    """``(repository, root, order)`` of the recursive commands of one type, the newest of each root."""
    return (
        commands.where((F.col("type") == kind) & F.col("recurse"))
        .groupBy(F.col("repo").alias(m.REPOSITORY), F.col("docId").alias("root"))
        .agg(F.max(_order(F.lit(kind))).alias(ORDER))
    )


def _targets(df: DataFrame, commands: DataFrame, kind: str) -> DataFrame:
    """``(key, order)``: the documents of ``df`` that recursive commands reach.

    Ancestors are exploded from narrow rows only and met with the commands by
    equality; Catalyst broadcasts the commands when they are few.  An index table
    gives only the rows in the ranges that the commands can reach.
    """
    members = df.select(*m.KEY, F.explode(m.ANCESTOR_IDS).alias("root"))
    return members.join(_recursive_roots(commands, kind), [m.REPOSITORY, "root"]).select(*m.KEY, ORDER)


def newest_commands(commands: DataFrame, source: DataFrame, index: DataFrame, recursive: bool = True) -> DataFrame:
    """``(key, command_order, recursive, type)``: the newest command of each document.

    A recursive deletion also reaches what the index holds below its document, a
    recursive insertion what the source holds.  A side without such a command is
    not searched; ``recursive=False`` promises that there is none.  Roots of
    recursive deletions come once more, with ``recursive``: what they reach later
    is not known yet.
    """
    commands = commands.where(F.col("type").isin(INSERT, DELETE))
    direct = commands.select(
        F.col("repo").alias(m.REPOSITORY), F.col("docId").alias(m.UUID), _order(F.col("type")).alias(ORDER), F.lit(False).alias(RECURSIVE)
    )
    kinds = {row.type for row in commands.where("recurse").select("type").distinct().collect()} if recursive else set()
    for kind, rows in ((DELETE, index), (INSERT, source)):
        if kind in kinds:  # one of the two names
            direct = direct.unionByName(_targets(rows, commands, kind).withColumn(RECURSIVE, F.lit(False)))
    if DELETE in kinds:
        roots = _recursive_roots(commands, DELETE).withColumnRenamed("root", m.UUID)
        direct = direct.unionByName(roots.withColumn(RECURSIVE, F.lit(True)))
    # A hash aggregate with one partial row per document and task: a document
    # with a third of all commands gathers nowhere.
    newest = direct.groupBy(*m.KEY, RECURSIVE).agg(F.max(ORDER).alias(ORDER))
    kind = F.when(F.col(ORDER) % 2 == 1, INSERT).otherwise(DELETE)
    return newest.select(*m.KEY, ORDER, RECURSIVE, kind.alias("type"))


def newest_numbers(numbers: DataFrame) -> DataFrame:
    """The order of the newest command that each document has had, by rows of several batches."""
    return numbers.groupBy(*m.KEY, RECURSIVE).agg(F.max(ORDER).alias(ORDER))


def fresh_commands(newest: DataFrame, numbers: DataFrame) -> DataFrame:
    """The newest commands without those that come after a newer one, or a second time.

    The batch is the small side; of the numbers only the batch's documents are grouped.
    """
    named = numbers.join(newest.select(*m.KEY, RECURSIVE), [*m.KEY, RECURSIVE], "left_semi")
    known = newest_numbers(named).withColumnRenamed(ORDER, "known")
    joined = newest.join(known, [*m.KEY, RECURSIVE], "left")
    return joined.where(F.col("known").isNull() | (F.col(ORDER) > F.col("known"))).drop("known")


def overruled(found: DataFrame, newest: DataFrame, roots: DataFrame) -> DataFrame:
    """Keys of documents whose insertion is older than the recursive deletion of an ancestor.

    ``roots`` has the recursive deletions of earlier batches.  The ancestors are those
    of the documents to insert, not of the whole source.
    """
    own = newest.where(~F.col(RECURSIVE)).select(*m.KEY, F.col(ORDER).alias("own"))
    below = found.select(*m.KEY, F.explode(m.ANCESTOR_IDS).alias("root")).join(own, m.KEY)
    gone = roots.select(m.REPOSITORY, F.col(m.UUID).alias("root"), F.col(ORDER).alias("gone"))
    return below.join(gone, [m.REPOSITORY, "root"]).where("gone > own").select(*m.KEY).distinct()


def command_changes(
    newest: DataFrame,
    source: DataFrame,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    roots: DataFrame | None = None,
) -> DataFrame:
    """Row changes for the newest commands.

    Every named document is deleted; one to index is inserted as the source has
    it now.  So a document that is gone from the source stays deleted, and one
    below a root that a newer command deleted (``roots``) too.  ``prepare`` adds
    index columns, to the named documents only.
    """
    named = newest.where(~F.col(RECURSIVE)) if RECURSIVE in newest.columns else newest
    found = source.join(named.where(F.col("type") == INSERT).select(*m.KEY), m.KEY, "left_semi")
    if roots is not None:
        found = found.join(overruled(found, newest, roots), m.KEY, "left_anti")
    return _changes(named, prepare(found) if prepare else found)


def newest_insertions(changes: DataFrame) -> DataFrame:
    """The changes that are the newest of their document and insert it; an
    insertion beats the deletion that was written with it.

    Only keys and numbers are grouped.  The changes meet them by a semi join, so
    what a search filters and reads reaches the scan of the changes.
    """
    order = F.col(SEQUENCE) * 2 + (F.col(CHANGE) == INSERT).cast("long")
    newest = changes.groupBy(*m.KEY).agg(F.max(order).alias("newest")).where("newest % 2 = 1")
    newest = newest.select(*m.KEY, F.shiftright("newest", 1).alias(SEQUENCE))
    return changes.where(F.col(CHANGE) == INSERT).join(newest, [*m.KEY, SEQUENCE], "left_semi")


def apply_changes(index: DataFrame, changes: DataFrame) -> DataFrame:
    """The index without the changed documents, and with the inserted ones.

    Numbered changes may name a document often, the newest counts; changes
    without numbers insert it at most once.  Only keys meet the index, and need no
    grouping for that.  Read from files, their size is known when the join is
    planned, and Catalyst broadcasts them while they are small: then the index is
    not shuffled.
    """
    kept = index.join(changes.select(*m.KEY), m.KEY, "left_anti")
    inserted = newest_insertions(changes) if SEQUENCE in changes.columns else changes.where(F.col(CHANGE) == INSERT)
    return kept.unionByName(inserted.select(*[F.col(f"`{name}`") for name in index.columns]))


def audit_rows(spark: SparkSession, comment: str, principal: str) -> DataFrame:
    """One audit row: who had what rebuilt, and when."""
    row = [(m.AUDIT_CATEGORY, m.AUDIT_EVENT, comment, principal)]
    return spark.createDataFrame(row, "category string, event string, comment string, principal string").withColumn(
        "logged_at", F.current_timestamp()
    )
