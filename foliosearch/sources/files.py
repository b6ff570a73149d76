"""Files that hits are written to and read back from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliosearch import model as m
from foliosearch.operators.envelope import ENTITY_TYPE, ENVELOPE_FIELDS, envelope_json
from foliosearch.sources.content import fetch_source


def export(df: DataFrame, path: str, batch: int = m.EXPORT_BATCH) -> None:
    """Every match as Parquet, at most ``batch`` hits per file.

    Tasks write their own rows: nothing is collected, and a sorted frame stays
    sorted over the files in name order.
    """
    fetch_source(df).write.mode("overwrite").option("maxRecordsPerFile", batch).parquet(path)


def write_envelope(df: DataFrame, path: str, prefixes: Sequence[str] = ()) -> None:
    """One JSON envelope per hit and line."""
    envelope_json(df, prefixes).write.mode("overwrite").option("maxRecordsPerFile", m.EXPORT_BATCH).text(path)


def write_raw(df: DataFrame, path: str) -> None:
    """The hits as they are, as JSON lines."""
    fetch_source(df).write.mode("overwrite").option("maxRecordsPerFile", m.EXPORT_BATCH).json(path)


def envelope_schema(properties: T.DataType | None = None) -> T.StructType:
    fields = [T.StructField(ENTITY_TYPE, T.StringType())]
    for field, name in ENVELOPE_FIELDS.items():
        kind = m.CONTENT_SCHEMA[name].dataType if field == "facets" else T.StringType()
        fields.append(T.StructField(field, kind))
    properties = properties or T.MapType(T.StringType(), T.StringType())
    return T.StructType([*fields, T.StructField("properties", properties)])


def read_envelope(spark: SparkSession, path: str) -> DataFrame:
    """Saved envelopes as rows: one per hit.

    Takes both layouts: a hit per line, and a page per line whose hits are in
    ``entries``.  The schema is given, so the files are read once; property
    values come back as JSON text.
    """
    hit = envelope_schema()
    schema = T.StructType([*hit.fields, T.StructField("entries", T.ArrayType(hit))])
    lines = spark.read.schema(schema).json(path)
    own = F.struct(*[F.col(f"`{name}`") for name in hit.names])
    hits = F.when(F.col("entries").isNotNull(), F.col("entries")).otherwise(F.array(own))
    return lines.select(F.explode(hits).alias("hit")).select("hit.*")
