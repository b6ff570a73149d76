"""Trigrams of a column on disk, for ``LIKE '%x%'`` that reads little.

A folder holds (trigram, repository, uuid), sorted by trigram: each document once for
each three characters in a row that its value has, in lower case.  A pattern's
literal stretches name the trigrams that a matching value must hold.  They reach
the scan as literals, so only their row groups are read; the documents that
have all of them are candidates, and the pattern itself decides.

Trigrams are those of the lower-cased value and the lower-cased stretch alike, so
``ILIKE`` may use them as ``LIKE`` does.  The one letter whose lower case depends on
what follows it, sigma, has one form.  A pattern without three literal characters in a row prunes
nothing and is tested on every document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliosearch import model as m
from foliosearch.functions import predicates as p

SIZE = 3


def trigrams(value: Column) -> Column:
    """The distinct trigrams of a value; none for one of fewer characters, or null."""
    low = F.translate(F.lower(value), "ς", "σ")
    last = F.length(low) - SIZE
    cuts = F.transform(F.sequence(F.lit(0), last), lambda at: F.substring(low, at + 1, F.lit(SIZE)))
    return F.array_distinct(F.when(last >= 0, cuts).otherwise(F.array().cast("array<string>")))


def literal_stretches(pattern: str) -> list[str]:
    """The stretches of a LIKE pattern between its wildcards, escapes resolved."""
    found, at, current = [], 0, ""
    while at < len(pattern):
        c = pattern[at]
        if c == "\\" and at + 1 < len(pattern):
            current += pattern[at + 1]
            at += 2
            continue
        if c in "%_":
            found.append(current)
            current = ""
        else:
            current += c
        at += 1
    return [stretch for stretch in [*found, current] if stretch]


class InfixIndex:
    """Trigrams of one column of an index or any table of documents."""

    def __init__(self, spark: SparkSession, path: str, column: str = m.TITLE):
        self.spark = spark
        self.path = path.rstrip("/")
        self.column = column

    def build(self, df: DataFrame) -> None:
        """Ranged by trigram and document: one that every document has still fills many files."""
        entries = df.select(*m.KEY, F.explode(trigrams(F.col(self.column))).alias("trigram"))
        entries.repartitionByRange("trigram", *m.KEY).sortWithinPartitions("trigram", *m.KEY).write.parquet(self.path)

    def named(self, pattern: str) -> list[str]:
        """The trigrams that a matching value holds, worked out as those of the documents are."""
        stretches = literal_stretches(pattern)
        if not stretches:
            return []
        rows = self.spark.createDataFrame([(s,) for s in stretches], "stretch string")
        return sorted({r[0] for r in rows.select(F.explode(trigrams(F.col("stretch")))).collect()})

    def candidates(self, pattern: str) -> DataFrame | None:
        """Keys of the documents that hold all of the pattern's trigrams; None if it names none."""
        wanted = self.named(pattern)
        if not wanted:
            return None
        entries = self.spark.read.parquet(self.path).where(F.col("trigram").isin(*wanted))
        return entries.groupBy(*m.KEY).agg(F.count(F.lit(1)).alias("held")).where(F.col("held") == len(wanted)).select(*m.KEY)

    def search(self, df: DataFrame, pattern: str, *, any_case: bool = False) -> DataFrame:
        """The documents whose column matches: the same rows as the plain predicate."""
        matching = df.where((p.ilike if any_case else p.like)(self.column, pattern))
        found = self.candidates(pattern)
        return matching if found is None else matching.join(found, m.KEY, "left_semi")
