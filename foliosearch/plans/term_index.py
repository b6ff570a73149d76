"""Postings of a corpus on disk, for full-text queries that read little.

A folder holds, for each finished write n,

    postings/n=N      (repository, uuid, field, term, tf, length, sign); a file has those
                      of some documents, sorted by term
    statistics/n=N    (field, term, df); each file sorted by term
    corpus/n=N        one row: the number of documents
    commits           one line per finished write

A query names its terms as literals, so the scan skips the row groups and pages of
other terms in each file, and only hits are shuffled.

The first write holds a whole corpus.  ``follow`` brings the postings up to an
index table by the documents that its writes since then name: the postings of
what left come with sign -1, of what came with +1, and document frequencies and
corpus size as differences.  Sums over all writes are those of a fresh build.  A
write counts once its commit line exists; ``fold`` makes one of all.  One writer at
a time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliosearch import model as m
from foliosearch.operators.fulltext import FullTextQuery, fulltext_keys
from foliosearch.operators.relevance import difference_postings, field_postings, match_postings, net_postings, score_postings
from foliosearch.plans.index_table import IndexTable
from foliosearch.session import discard, remove, scratch_path

# ``whole`` is true for a write that stands for the whole corpus, in place of all before it.
COMMIT_SCHEMA = "n bigint, followed bigint, whole boolean"
POSTING_SCHEMA = f"`{m.REPOSITORY}` string, `{m.UUID}` string, field string, term string, tf bigint, length bigint, sign int"

# A file's terms are sorted, so a page holds few of them.  Queries read the pages that may
# hold theirs; a dictionary of all terms of the file would be read before any of them.
PAGES = {"parquet.page.row.count.limit": "2000", "parquet.enable.dictionary#term": "false"}


class TermIndex:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        *,
        fields: Sequence[str] = tuple(m.FIELD_BOOSTS),
        language: str = "fulltext",
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.fields = list(fields)
        self.language = language

    def commits(self) -> list:
        try:
            lines = self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.path}/commits").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        whole = max((line.n for line in lines if line.whole), default=0)
        return sorted((line for line in lines if line.n >= whole), key=lambda line: line.n)

    # -- write ---------------------------------------------------------------

    def build(self, df: DataFrame, followed: int | None = None) -> None:
        """Analyse a whole corpus, in place of what there was.

        ``followed`` is the version of the index table that ``df`` is.
        """
        self._write(df.select(*m.KEY, *self.fields), followed, whole=True)
        self._forget_replaced()

    def follow(self, index: IndexTable) -> None:
        """Bring the postings up to an index table, by the documents changed since the last time.

        Where the table has folded away the version followed last, the corpus is
        analysed anew.
        """
        lines, now = self.commits(), index.version()
        done = lines[-1].followed if lines else None
        if done == now:
            return
        if done is None or done not in {line.n for line in index.commits()}:
            self.build(index.read(), now)
        else:
            self._write(index.difference(done, now, self.fields), now, whole=False)

    def fold(self) -> None:
        """One write of all: what has left is no longer stored."""
        before = self.commits()
        n = before[-1].n + 1
        self._lay_out(net_postings(self.postings()).withColumn("sign", F.lit(1)), self.total(), n)
        self._commit(n, before[-1].followed, whole=True)
        self._forget_replaced()

    def _write(self, rows: DataFrame, followed: int | None, whole: bool) -> None:
        """Rows are (key, *fields) of a whole corpus, or (key, *fields, sign) of a difference.

        Rows of a whole corpus all count 1, which is said after the analysis: Catalyst puts
        a constant among the grouping keys in another place than where the texts are dealt
        by it, and would shuffle all postings for that, twice.
        """
        n = max((line.n for line in self.commits()), default=0) + 1
        changed = scratch_path(self.spark, "changed")
        if not whole:  # a difference is used twice
            rows.write.parquet(changed)
            rows = self.spark.read.parquet(changed)
        signs = F.lit(1) if whole else F.col("sign")
        found = rows.agg(F.coalesce(F.sum(signs), F.lit(0)).cast("long").alias("total"), F.count(F.lit(1)).alias("documents")).first()
        if whole:
            posted = field_postings(rows, m.KEY, self.fields, self.language, found.documents).withColumn("sign", F.lit(1))
        else:
            posted = difference_postings(rows, m.KEY, self.fields, self.language, found.documents)
        self._lay_out(posted, found.total, n)
        discard(self.spark, changed)
        self._commit(n, followed, whole)

    def _lay_out(self, postings: DataFrame, total: int, n: int) -> None:
        """Postings come dealt by document, and a task writes those of its documents sorted
        by term.  So they are neither shuffled nor staged, and a term found in every
        document fills many files; a query looks into each file for its terms.  Ids come
        before the repository, which most documents share: comparisons end there.
        """
        order = ["term", "field", *reversed(m.KEY)]
        columns = [*m.KEY, "field", "term", F.col("tf").cast("long").alias("tf"), F.col("length").cast("long").alias("length"), "sign"]
        path = f"{self.path}/postings/n={n}"
        postings.select(*columns).sortWithinPartitions(*order).write.mode("overwrite").options(**PAGES).parquet(path)
        (
            self.spark.read.schema(POSTING_SCHEMA)
            .parquet(path)
            .groupBy("field", "term")
            .agg(F.sum("sign").cast("long").alias("df"))
            .sortWithinPartitions("term", "field")
            .write.mode("overwrite")
            .parquet(f"{self.path}/statistics/n={n}")
        )
        self.spark.createDataFrame([(total,)], "total bigint").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/corpus/n={n}")

    def _commit(self, n: int, followed: int | None, whole: bool) -> None:
        line = self.spark.createDataFrame([(n, followed, whole)], COMMIT_SCHEMA)
        line.coalesce(1).write.mode("append").json(f"{self.path}/commits")

    def _forget_replaced(self) -> None:
        """Remove the lines that the last whole write has replaced; nobody reads them any more."""
        first = self.commits()[0].n
        read = self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.path}/commits")
        files = read.groupBy(F.input_file_name().alias("file")).agg(F.max("n").alias("n")).where(F.col("n") < first)
        remove(self.spark, [line.file for line in files.collect()])

    # -- read ----------------------------------------------------------------

    def _read(self, name: str, schema: str) -> DataFrame:
        folders = [f"{self.path}/{name}/n={line.n}" for line in self.commits()]
        if not folders:
            raise ValueError(f"no term index at {self.path}")
        return self.spark.read.schema(schema).parquet(*folders)

    def postings(self) -> DataFrame:
        """Signed postings of all writes."""
        return self._read("postings", POSTING_SCHEMA)

    def statistics(self) -> DataFrame:
        """``(field, term, df)`` of each write; their sums are the document frequencies."""
        return self._read("statistics", "field string, term string, df bigint")

    def total(self) -> int:
        return self._read("corpus", "total bigint").agg(F.sum("total").alias("total")).first().total

    def keys(self, query: FullTextQuery) -> DataFrame:
        """Keys of the documents that match a query in any field."""
        named = self.postings().where(F.col("term").isin(*query.all_terms))
        return fulltext_keys(net_postings(named), m.KEY, query)

    def scores(self, query: FullTextQuery, boosts: Mapping[str, float] = m.FIELD_BOOSTS) -> DataFrame:
        """``(*key, score)`` of the documents that hold a term of the query."""
        return score_postings(self.postings(), self.statistics(), self.total(), m.KEY, query.required_terms, boosts)

    def ranked(self, query: FullTextQuery, boosts: Mapping[str, float] = m.FIELD_BOOSTS) -> DataFrame:
        """``(*key, score)`` of the documents that match the query.

        All required words and none of the excluded ones; a query without
        required words has no score and finds nothing here.  Postings are read
        once: a document's match and its score are decided in one grouping.
        """
        return match_postings(self.postings(), self.statistics(), self.total(), m.KEY, query, boosts)
