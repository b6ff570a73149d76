"""Analyzers: from a text column to a table of terms.

Both analyzers run the same chain and differ in language; ``fulltext`` is
another name for the French one.

    strip HTML → words → word parts → lowercase → stop words → stem
    → fold accents (keeping the original) → [French] drop the article

The article goes last: the kept word ``l'arche`` is stemmed with its article,
its part ``arche`` without.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliosearch.functions import text as t


@dataclass(frozen=True)
class Analyzer:
    stop_words: list[str]
    stem: Callable[[Column], Column]
    finish: Callable[[Column], Column]


ANALYZERS = {
    "en": Analyzer(t.ENGLISH_STOP_WORDS, t.stem_english, lambda word: word),
    "fr": Analyzer(t.FRENCH_STOP_WORDS, t.stem_french, t.drop_article),
}
ANALYZERS["fulltext"] = ANALYZERS["fr"]


def tokens(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    """``(*keep, pos, word)``: the words of a column, in order."""
    words = t.words(t.strip_html(F.col(text)))
    return df.select(*keep, F.posexplode(words).alias("pos", "word"))


def analyze(df: DataFrame, keep: list[str], text: str, language: str) -> DataFrame:
    """``(*keep, pos, part, term)``: the terms of a column.

    ``pos`` numbers the words, ``part`` the parts of a word; the word itself
    shares part 0 with its first part.  Terms that share both are alternatives
    of each other.  Words are exploded first, so that every later step is a flat
    expression inside generated code; nothing here shuffles.
    """
    analyzer = ANALYZERS[language]
    words = tokens(df, keep, text)
    parts = words.select(
        *keep, "pos", F.posexplode(t.with_word_parts(F.col("word"))).alias("part", "word")
    ).select(
        *keep, "pos", F.greatest(F.col("part") - 1, F.lit(0)).alias("part"), t.lowercase(F.col("word")).alias("word")
    )
    stemmed = parts.where(~t.is_stop_word(F.col("word"), analyzer.stop_words)).select(
        *keep, "pos", "part", analyzer.stem(F.col("word")).alias("word")
    )
    folded = stemmed.select(*keep, "pos", "part", F.explode(t.with_folded(F.col("word"))).alias("word"))
    return folded.select(*keep, "pos", "part", analyzer.finish(F.col("word")).alias("term")).where(
        F.col("term") != ""
    )


def analyzed_terms(text: Column, language: str) -> Column:
    """The distinct terms of a text as an array inside its own row.

    The same chain as ``analyze``, for columns an index keeps beside the
    document: it needs no regrouping, hence no shuffle.
    """
    return terms_of_words(distinct_words(text), language)


def distinct_words(text: Column) -> Column:
    """The words of a text, each once, as an array inside its own row."""
    return F.array_distinct(t.words(t.strip_html(text)))


def terms_of_words(words: Column, language: str) -> Column:
    """The distinct terms of an array of words; each word has its own, whatever stands around it."""
    analyzer = ANALYZERS[language]
    found = F.flatten(F.transform(words, t.with_word_parts))
    found = F.array_distinct(F.transform(found, t.lowercase))
    found = F.filter(found, lambda word: ~t.is_stop_word(word, analyzer.stop_words))
    found = F.flatten(F.transform(F.transform(found, analyzer.stem), t.with_folded))
    return F.array_distinct(F.filter(F.transform(found, analyzer.finish), lambda term: term != ""))


def stack_fields(df: DataFrame, keep: list[str], fields: Mapping[str, str]) -> DataFrame:
    """``(*keep, field, text)``: several columns, given by field name, as rows."""
    entries = [F.struct(F.lit(name).alias("field"), F.col(column).alias("text")) for name, column in fields.items()]
    stacked = df.select(*keep, F.explode(F.array(*entries)).alias("entry"))
    return stacked.select(*keep, "entry.field", "entry.text")


def analyze_fields(df: DataFrame, keep: list[str], fields: Mapping[str, str], language: str) -> DataFrame:
    """``(*keep, field, pos, part, term)`` for several columns in one pass."""
    return analyze(stack_fields(df, keep, fields), [*keep, "field"], "text", language)


def by_document(df: DataFrame, keep: list[str], documents: int | None = None) -> DataFrame:
    """Rows partitioned by document, ahead of analysis that is counted per document.

    A text is several times smaller than its postings, each of which repeats the
    document's key.  So the text is what is shuffled, once; groupings by document
    that follow find its terms together.  The number of partitions is explicit,
    since adaptive execution would size them by the small text, not by the work; it
    follows the size of the input.  Where the number of rows is given as ``documents``, a few
    of them don't spread over more tasks than they are worth, each of which may write a file.
    """
    spark = df.sparkSession
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    if documents is not None:
        partitions = min(partitions, max(1, -(-documents // TASK_DOCUMENTS)))
    return df.repartition(max(partitions, -(-_known_bytes(df) // TEXT_BYTES)), *keep)


# Bytes of stored text that one task analyses.  The task's hash table of postings took
# 1,410 MB for some 30 MB of them.
TEXT_BYTES = 16 << 20

# Documents that are worth a task of their own, unless their texts are long.
TASK_DOCUMENTS = 128


# A table whose size Spark doesn't know counts as larger than this.
UNKNOWN_BYTES = 1 << 60


def _known_bytes(df: DataFrame) -> int:
    """The size of the files and tables that ``df`` is made of, as far as Spark knows it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


def postings(terms: DataFrame, keep: list[str]) -> DataFrame:
    """``(*keep, term, tf)`` from a table of terms: how often a document has each.

    Counts are combined inside each task before any shuffle, and the key holds
    the document, so a term found everywhere is still spread over all tasks.
    """
    return terms.groupBy(*keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_postings(df: DataFrame, keep: list[str], text: str, language: str) -> DataFrame:
    """``postings`` of a text column, with the texts as the only shuffle."""
    texts = by_document(df.select(*keep, text), keep)
    return postings(analyze(texts, keep, text, language), keep)


def term_statistics(posted: DataFrame) -> DataFrame:
    """``(term, df, cf)`` over the whole corpus, from its postings.

    Postings hold a document once per term, so counting rows counts documents:
    no distinct, and one partial row per term and task in the shuffle.
    """
    return posted.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
