"""The training-data pipeline: five operators, each on all that the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, folder) and
returns a table.  All but the last return the columns of ``documents``.

1. language_id: documents in no learned language go (null text, or no letter);
2. line_dedup: later repeated runs of lines are deleted, and texts left blank go;
3. simhash: of each group of near-duplicates the least doc_id stays;
4. decontaminate: documents that hold a benchmark passage go;
5. sentencepiece: the token counts and digests of what is left.

No stage's rows are SQL's to say, so ``ORACLE_SQL`` is None.  The tests compare each
stage with its operator, and the operators with brute force or the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliosearch.llm import op01_language, op05_lines, op06_pieces, op07_simhash, op10_decontaminate
from foliosearch.llm.queries import tokenizer
from foliosearch.session import scratch_path, ship_package


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    ship_package(spark)
    return op01_language.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    ship_package(spark)
    return op05_lines.drop_repeated_lines(docs)


def simhash(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    ship_package(spark)
    return op07_simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    ship_package(spark)
    return op10_decontaminate.clean_documents(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    ship_package(spark)
    return op06_pieces.encode_documents(docs, tokenizer(), with_ids=False)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash", simhash),
    ("decontaminate", decontaminate),
    ("sentencepiece", sentencepiece),
]

ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
