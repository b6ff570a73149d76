"""An index kept as Parquet files, with rebuilds that readers never notice.

A folder holds

    data/n=N       a whole index, or one repository of it, partitioned by
                   repository
    changes/n=N    rows changed since
    numbers/n=N    the newest command of each document that commands named
    classes/n=N    the distinct ACLs of the rows that a write holds, by class
    subtrees/n=N   the range of paths below each ancestor that its rows name
    rejects        commands that were refused, by batch
    commits        one line per finished write, numbered in order
    audit          one line per rebuild

A write goes to a folder of its own and counts once its commit line exists.  So
a lost executor or driver leaves the last committed state, and nothing is
overwritten while it is read.  Partial rebuilds write the rows they change, not
the index; ``compact`` folds those in, and all commit lines into one.  One writer
at a time.

Commands count by their numbers, not by the batch they come in: a command that
is older than one already applied to its document changes nothing.  The numbers
are kept for that, for deleted documents too, and outlast rebuilds.
"""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliosearch import model as m
from foliosearch.operators import maintain, subtrees
from foliosearch.operators.fields import derive_fields
from foliosearch.operators.security import acl_dictionary
from foliosearch.session import discard, remove, scratch_path

log = logging.getLogger(__name__)

# ``schema`` tells the columns of a version, also where it holds no row and so no file.
# ``numbers`` is true where the write has a folder of command numbers.
COMMIT_SCHEMA = "n bigint, kind string, repository string, label string, schema string, numbers boolean"
AUDIT_SCHEMA = "category string, event string, comment string, principal string, logged_at timestamp"

DATA = "data"
CHANGES = "changes"
NUMBERS = "numbers"
CLASSES = "classes"
SUBTREES = "subtrees"
REJECTS = "rejects"

COMPACT = "compact"

REINDEX_TYPES = ("ALL", "ROOT", "QUERY")

# Rows per file of an index version; large enough for the scan, small enough to
# spread a large repository over many tasks.
ROWS_PER_FILE = 1_000_000


# A Bloom filter of the document ids in each row group: a page of hits, or a batch of
# commands, then reads the row groups that may have its documents.
ID_FILTER = {
    f"parquet.bloom.filter.enabled#{m.UUID}": "true",
    f"parquet.bloom.filter.expected.ndv#{m.UUID}": str(ROWS_PER_FILE),
}


class IndexTable:
    """``derive=False`` stores documents without their index columns."""

    def __init__(self, spark: SparkSession, path: str, *, derive: bool = True, language: str = "fulltext"):
        self.spark = spark
        self.path = path.rstrip("/")
        self.derive = derive
        self.language = language

    def commits(self) -> list:
        """Commit lines in order: one per write, a few bytes each."""
        try:
            lines = self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.path}/commits").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise  # an index that can't be read isn't an empty one
            return []
        return sorted(lines, key=lambda line: line.n)

    def _commit(
        self, n: int, kind: str, repository: str | None, label: str, schema: str | None = None, numbers: bool = False
    ) -> None:
        line = self.spark.createDataFrame([(n, kind, repository, label, schema, numbers)], COMMIT_SCHEMA)
        line.coalesce(1).write.mode("append").json(f"{self.path}/commits")

    def _next(self) -> int:
        return 1 + max((line.n for line in self.commits()), default=0)

    # -- read ----------------------------------------------------------------

    def version(self) -> int:
        """The number of the last finished write; 0 without any."""
        return max((line.n for line in self.commits()), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        """The index as it stands: what was written whole, and changes since.

        With a ``version``, as it stood after that write, unless ``compact`` has
        folded it away.
        """
        commits = [line for line in self.commits() if version is None or line.n <= version]
        whole = max((line.n for line in commits if line.kind == DATA and line.repository is None), default=0)
        renewed = {
            line.repository: line.n for line in commits if line.kind == DATA and line.repository and line.n > whole
        }
        schemas = {line.n: line.schema for line in commits}
        parts = []
        if whole:
            base = self._data(whole, schemas[whole])
            others = F.col(m.REPOSITORY).isNull() | ~F.col(m.REPOSITORY).isin(*renewed)
            parts.append(base.where(others) if renewed else base)
        for repository, n in renewed.items():
            parts.append(self._data(n, schemas[n]).where(F.col(m.REPOSITORY) == repository))
        if not parts:
            raise ValueError(f"no index at {self.path}")
        index = reduce(DataFrame.unionByName, parts)

        oldest = min([whole, *renewed.values()]) if whole else min(renewed.values())
        folders = [f"{self.path}/{CHANGES}/n={line.n}" for line in commits if line.kind == CHANGES and line.n > oldest]
        if not folders:
            return index
        changes = self.spark.read.parquet(*folders)
        for repository, n in renewed.items():
            outdated = F.col(m.REPOSITORY).eqNullSafe(F.lit(repository)) & (F.col(maintain.SEQUENCE) < n)
            changes = changes.where(~outdated)
        return maintain.apply_changes(index, changes)

    def difference(self, before: int, after: int, columns: Sequence[str]) -> DataFrame:
        """``(key, *columns, sign)``: what left the index between two versions (-1), and what came (1).

        Only documents that a write between the two names are looked at, and
        those that are the same on both sides are left out.
        """
        lines = [line for line in self.commits() if before < line.n <= after]
        renewed = sorted({line.repository for line in lines if line.kind == DATA and line.repository})
        whole = any(line.kind == DATA and not line.repository and line.label != COMPACT for line in lines)
        folders = [f"{self.path}/{CHANGES}/n={line.n}" for line in lines if line.kind == CHANGES]
        named = self.spark.read.parquet(*folders).select(*m.KEY).distinct() if folders else None
        in_renewed = F.coalesce(F.col(m.REPOSITORY).isin(*renewed), F.lit(False)) if renewed else F.lit(False)
        sides = []
        for version, sign in ((before, -1), (after, 1)):
            rows = self.read(version)
            parts = [rows] if whole else [rows.where(in_renewed)] if renewed else []
            if named is not None and not whole:
                parts.append(rows.where(~in_renewed).join(named, m.KEY, "left_semi"))
            if not parts:
                parts = [rows.where(F.lit(False))]
            for part in parts:
                held = F.struct(*[F.col(f"`{name}`") for name in columns]).alias("held")
                sides.append(part.select(*m.KEY, held, F.lit(sign).alias("sign")))
        digest = F.sha2(F.to_json("held", {"ignoreNullFields": "false"}), 256)
        net = (
            reduce(DataFrame.unionByName, sides)
            .groupBy(*m.KEY, digest.alias("digest"))
            .agg(F.any_value("held").alias("held"), F.sum("sign").cast("int").alias("sign"))
            .where("sign <> 0")
        )
        return net.select(*m.KEY, *[F.col("held").getField(name).alias(name) for name in columns], "sign")

    def _data(self, n: int, told: str | None) -> DataFrame:
        """A stored version.  Repository names stay text, even if they look like
        numbers or dates in the folder names they are read from."""
        path = f"{self.path}/{DATA}/n={n}"
        schema = T.StructType.fromJson(json.loads(told)) if told else self.spark.read.parquet(path).schema
        schema[m.REPOSITORY].dataType = T.StringType()
        return self.spark.read.schema(schema).parquet(path)

    # -- write ---------------------------------------------------------------

    def _indexed(self, df: DataFrame) -> DataFrame:
        if not self.derive:
            return df
        return derive_fields(df.withColumn(m.DIGEST, maintain.content_digest(df, self.language)), self.language)

    def _digests(self, rows: DataFrame) -> DataFrame:
        """``(key, digest)``: the stored digest where rows of the index have one."""
        digest = F.col(m.DIGEST) if m.DIGEST in rows.columns else maintain.content_digest(rows, self.language)
        return rows.select(*m.KEY, digest.alias(m.DIGEST))

    def _write_data(self, df: DataFrame, label: str, repository: str | None = None, numbers: DataFrame | None = None) -> None:
        """Tasks write the rows they hold into the repositories' folders.  They
        are not shuffled by repository first: that would put a repository with
        most of the rows into one task.  Writing by repository sorts each task's
        rows anyway; sorted by path as well, a file's row groups hold neighbouring
        paths, and a search below a path skips most of them."""
        n = self._next()
        order = [m.REPOSITORY, m.PATH] if m.PATH in df.columns else [m.REPOSITORY]
        (
            df.sortWithinPartitions(*order)
            .write.mode("overwrite")
            .partitionBy(m.REPOSITORY)
            .option("maxRecordsPerFile", ROWS_PER_FILE)
            .options(**ID_FILTER)
            .parquet(f"{self.path}/{DATA}/n={n}")
        )
        self._write_numbers(n, numbers)
        self._write_classes(n, DATA)
        self._write_subtrees(n, DATA)
        self._commit(n, DATA, repository, label, df.schema.json(), numbers is not None)

    def _write_classes(self, n: int, kind: str) -> None:
        """From the written rows: only their classes and ACLs are read again."""
        if self.derive:
            rows = self.spark.read.parquet(f"{self.path}/{kind}/n={n}") if self._holds_rows(n, kind) else None
            if rows is not None and m.ACL_CLASS in rows.columns:
                acl_dictionary(rows).write.mode("overwrite").parquet(f"{self.path}/{CLASSES}/n={n}")

    def _holds_rows(self, n: int, kind: str) -> bool:
        """A version without rows may have no file, and then no columns to read."""
        try:
            return bool(self.spark.read.parquet(f"{self.path}/{kind}/n={n}").columns)
        except AnalysisException:
            return False

    def acl_classes(self) -> DataFrame:
        """``(class, acl)`` of the ACLs in the index; some of them may no longer be in use.

        For ``operators.security``.  Every write adds the classes of its rows.
        """
        commits = self.commits()
        whole = max((line.n for line in commits if line.kind == DATA and not line.repository), default=0)
        numbers = [line.n for line in commits if line.n >= whole]
        parts = [part for n in numbers if (part := self._classes(n)) is not None]
        if not parts:
            return acl_dictionary(self.read()).select("class", "acl")
        return reduce(DataFrame.unionByName, parts).groupBy("class").agg(F.any_value("acl").alias("acl"))

    def _classes(self, n: int) -> DataFrame | None:
        try:
            return self.spark.read.schema("class string, acl array<string>").parquet(f"{self.path}/{CLASSES}/n={n}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _write_subtrees(self, n: int, kind: str) -> None:
        """From the written rows: only their paths and ancestors are read again."""
        rows = self.spark.read.parquet(f"{self.path}/{kind}/n={n}") if self._holds_rows(n, kind) else None
        if rows is None:
            intervals = self.spark.createDataFrame([], subtrees.INTERVAL_SCHEMA)
        elif {m.PATH, m.ANCESTOR_IDS} <= set(rows.columns):
            named = rows.withColumn(m.REPOSITORY, F.col(m.REPOSITORY).cast("string"))
            intervals = subtrees.subtree_intervals(named).sortWithinPartitions(subtrees.ROOT)
        else:
            return
        intervals.write.mode("overwrite").parquet(f"{self.path}/{SUBTREES}/n={n}")

    def subtrees(self) -> DataFrame | None:
        """``(repository, root, low, high, unplaced)`` by write, as ``operators.subtrees`` says.

        Rows of all ancestors that documents of the index name, and of some that no longer do.
        None where a write left none.
        """
        commits = self.commits()
        whole = max((line.n for line in commits if line.kind == DATA and not line.repository), default=0)
        folders = [f"{self.path}/{SUBTREES}/n={line.n}" for line in commits if line.n >= whole]
        try:
            return self.spark.read.schema(subtrees.INTERVAL_SCHEMA).parquet(*folders)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def below(self, root_id: str, repository: str | None = None) -> Column:
        """The documents below an ancestor and the ancestor itself, as a predicate on ``read()``.

        It carries the ranges of paths that can hold them as the index stands now, so the
        scan skips the row groups outside, and reads the ancestors of the rest.
        """
        intervals = self.subtrees()
        decided = maintain.in_subtree(root_id)
        if intervals is None:
            return decided
        named = intervals.where(F.col(subtrees.ROOT) == root_id)
        if repository is not None:
            named = named.where(F.col(m.REPOSITORY) == repository)
        return ((F.col(m.UUID) == root_id) | subtrees.within(subtrees.reach(named))) & decided

    def _within_reach(self, commands: DataFrame) -> DataFrame:
        """The index without the rows that no recursive deletion among the commands can reach."""
        intervals = self.subtrees()
        if intervals is None:
            return self.read()
        recursive = commands.where((F.col("type") == maintain.DELETE) & F.col("recurse"))
        roots = recursive.select(F.col("repo").alias(m.REPOSITORY), F.col("docId").alias(subtrees.ROOT))
        named = intervals.join(roots, [m.REPOSITORY, subtrees.ROOT], "left_semi")
        return self.read().where(subtrees.within(subtrees.reach(named)))

    def _write_numbers(self, n: int, numbers: DataFrame | None) -> None:
        if numbers is not None:
            shown = numbers.select(*m.KEY, maintain.ORDER, maintain.RECURSIVE)
            shown.write.mode("overwrite").parquet(f"{self.path}/{NUMBERS}/n={n}")

    def _write_changes(self, changes: DataFrame, label: str, numbers: DataFrame | None = None) -> None:
        """The write's number orders these changes after all earlier ones."""
        n = self._next()
        self._write_numbers(n, numbers)
        numbered = changes.withColumn(maintain.SEQUENCE, F.lit(n).cast("long"))
        numbered.write.mode("overwrite").parquet(f"{self.path}/{CHANGES}/n={n}")
        self._write_classes(n, CHANGES)
        self._write_subtrees(n, CHANGES)
        self._commit(n, CHANGES, None, label, numbers=numbers is not None)

    def create(self, source: DataFrame) -> None:
        """(Re)create the whole index from source documents."""
        self._write_data(self._indexed(source), "create")

    def compact(self) -> None:
        """Fold the changes into a whole index again, the numbers into one table, and
        the commit lines into one.

        The new line stands for all before it, so they may go one by one.
        """
        numbers = self.numbers()
        self._write_data(self.read(), COMPACT, None, None if numbers is None else maintain.newest_numbers(numbers))
        last = self.version()
        read = self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.path}/commits")
        lines = read.groupBy(F.input_file_name().alias("file")).agg(F.max("n").alias("n")).where(F.col("n") < last)
        remove(self.spark, [line.file for line in lines.collect()])  # one line per write since the last time

    def numbers(self) -> DataFrame | None:
        """``(key, command_order, recursive)`` of the commands applied so far; None without any.

        A document may come once for each batch that named it.
        """
        told = [line for line in self.commits() if line.numbers]
        folded = max((line.n for line in told if line.kind == DATA), default=0)
        folders = [f"{self.path}/{NUMBERS}/n={line.n}" for line in told if line.n >= folded]
        return self.spark.read.schema(maintain.NUMBER_SCHEMA).parquet(*folders) if folders else None

    def rejects(self) -> DataFrame:
        """The commands refused so far, with ``reason`` and the ``batch`` they came in."""
        try:
            return self.spark.read.parquet(f"{self.path}/{REJECTS}").drop("of")
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            columns = f"{maintain.COMMAND_SCHEMA}, {maintain.UNREADABLE} string, {maintain.REASON} string, batch string"
            return self.spark.createDataFrame([], columns)

    # -- rebuild -------------------------------------------------------------

    def audit(self) -> DataFrame:
        try:
            return self.spark.read.schema(AUDIT_SCHEMA).json(f"{self.path}/audit")
        except AnalysisException:
            return self.spark.createDataFrame([], AUDIT_SCHEMA)

    def _audit(self, comment: str, principal: str) -> None:
        maintain.audit_rows(self.spark, comment, principal).write.mode("append").json(f"{self.path}/audit")

    def reindex(
        self,
        kind: str,
        source: DataFrame,
        repository: str,
        *,
        root_id: str | None = None,
        predicate: Column | None = None,
        principal: str = "system",
        only_changed: bool = False,
    ) -> None:
        """Rebuild ``ALL`` of a repository, the part below a ``ROOT``, or what a
        ``QUERY`` selects in the source.

        The audit row is written before the work.  A blank root or query warns
        and does nothing.

        With ``only_changed`` the digests of the source's documents are compared
        with those that the index keeps.  Only documents that differ are analysed and written,
        and a rebuild that finds no difference writes nothing.  The index reads the same
        afterwards, but for documents without an id, which are left alone.
        """
        if kind == "ALL":
            self._audit(f"rebuild of repository {repository!r}", principal)
            own = source.where(F.col(m.REPOSITORY) == repository)
            if only_changed and self.version():
                held = self.read().where(F.col(m.REPOSITORY) == repository)
                self._write_differing(held, own, "reindex all")
                return
            self._write_data(self._indexed(own), "reindex all", repository)
        elif kind == "ROOT":
            if not root_id or not root_id.strip():
                log.warning("subtree rebuild asked for without a root: nothing is done")
                return
            self._audit(f"rebuild below document {root_id!r}", principal)
            held = self.read().where(self.below(root_id, repository))
            if only_changed:
                held, found = maintain.subtree(held, repository, root_id), maintain.subtree_of_live_root(source, repository, root_id)
                self._write_differing(held, found, "reindex root")
                return
            changes = maintain.subtree_changes(held, self._indexed(source), repository, root_id)
            self._write_changes(changes, "reindex root")
        elif kind == "QUERY":
            if predicate is None:
                log.warning("rebuild by query asked for without a query: nothing is done")
                return
            self._audit(f"rebuild of the documents where {predicate}", principal)
            if only_changed:
                here = F.col(m.REPOSITORY) == repository
                self._write_differing(self.read().where(here), source.where(here).where(predicate), "reindex query", delete=False)
                return
            self._write_changes(maintain.query_changes(self._indexed(source), repository, predicate), "reindex query")
        else:
            raise ValueError(f"unknown rebuild type {kind!r}: one of {REINDEX_TYPES}")

    def _write_differing(self, held: DataFrame, found: DataFrame, label: str, *, delete: bool = True) -> None:
        """Make ``held`` rows of the index what ``found`` in the source says.

        The keys of what differs are a table first, so their number is known when they
        meet the source, and it is seen whether there are any.
        """
        staged = scratch_path(self.spark, "differing")
        # ``held`` and ``found`` may come from one table; only keys and digests move.
        named = maintain.differing(self._digests(held), self._digests(found))
        (named if delete else named.where(F.col("type") == maintain.INSERT)).write.parquet(staged)
        named = self.spark.read.schema(maintain.DIFFERING_SCHEMA).parquet(staged)
        if not named.isEmpty():
            self._write_changes(maintain.command_changes(named, found, self._indexed), label)
        discard(self.spark, staged)

    def written(self, version: int) -> DataFrame:
        """``(key, change_type)`` of the rows that a partial write holds."""
        schema = f"{maintain.KEY_SCHEMA}, {maintain.CHANGE} string"
        return self.spark.read.schema(schema).parquet(f"{self.path}/{CHANGES}/n={version}")

    def apply_commands(
        self, commands: DataFrame, source: DataFrame, label: str, *, recursive: bool = True
    ) -> None:
        """Apply a batch of index commands once: a label that is committed already
        was applied already.

        Commands that can't be obeyed go to the rejects, under the batch's label.  Of
        the others, those that come after a newer one of their document are left
        out.  What remains is resolved to a table of keys first.  It is used
        several times, and as a file it has a known size when its joins are planned.
        A recursive deletion reaches what the index held before its batch, and
        what older commands of later batches would insert.
        """
        if any(line.label == label for line in self.commits()):
            return
        sound, refused = maintain.checked_commands(commands)
        self._write_rejects(refused, label)
        staged = scratch_path(self.spark, "commands")
        reached = self._within_reach(sound) if recursive else self.read()
        newest, known = maintain.newest_commands(sound, source, reached, recursive), self.numbers()
        (newest if known is None else maintain.fresh_commands(newest, known)).write.parquet(staged)
        newest = self.spark.read.parquet(staged)
        roots = None if known is None else known.where(maintain.RECURSIVE)
        self._write_changes(maintain.command_changes(newest, source, self._indexed, roots), label, newest)
        discard(self.spark, staged)

    def _write_rejects(self, refused: DataFrame, label: str) -> None:
        """A folder for each batch that has rejects; a batch that comes again writes the same one."""
        if refused.isEmpty():
            return
        if maintain.UNREADABLE not in refused.columns:
            refused = refused.withColumn(maintain.UNREADABLE, F.lit(None).cast("string"))
        folder = hashlib.sha256(label.encode()).hexdigest()[:32]
        refused.withColumn("batch", F.lit(label)).write.mode("overwrite").parquet(f"{self.path}/{REJECTS}/of={folder}")
