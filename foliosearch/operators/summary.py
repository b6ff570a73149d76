"""All that one reading of the matches can tell: total, facets, and where a page ends."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliosearch import model as m
from foliosearch.operators.facets import Facet, stacked_buckets, top_buckets
from foliosearch.operators.page import SortKey, sort_values
from foliosearch.session import scratch_path

# The buckets of hits stand beside the facets' under this id.
HITS = ""

# Cells for each hit up to the end of the page: with 16, some k of 32 hits share a cell with
# a better one, so a bound lets about three per cent more hits through than the page needs.
CELLS_PER_HIT = 16

# A page that ends further on than this is cut without a bound.
MOST_BOUNDED = 10_000

# How many bytes of a text its code holds.
TEXT_BYTES = 7


@dataclass(frozen=True)
class Summary:
    """``bound`` is a predicate on matches that all hits up to the page's end obey, or None."""

    facets: DataFrame
    total: int
    bound: Column | None


def _whole(column: Column) -> Column:
    return column.cast("long")


def _text_code(column: Column) -> Column:
    """The first bytes of a text as a number: never falling where the text rises."""
    start = F.hex(F.substring(column.cast("binary"), 1, TEXT_BYTES))
    return F.conv(F.rpad(start, 2 * TEXT_BYTES, "0"), 16, 10).cast("long")


def _text_start(code: int) -> str:
    """The ASCII letters that a text of this code begins with."""
    start = ""
    for byte in code.to_bytes(TEXT_BYTES, "big"):
        if not 0 < byte < 0x7F:
            break
        start += chr(byte)
    return start


def _code(column: Column, kind: T.DataType) -> tuple[Column, Callable[[object], Column]] | None:
    """What stands for a sort value in an aggregate, and the way back; None if nothing does.

    Numbers of fixed width, so that Spark keeps them in a hash table and sorts nothing.
    """
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column), lambda code: F.timestamp_micros(F.lit(code))
    if isinstance(kind, T.DateType):
        return F.unix_date(column), lambda code: F.date_from_unix_date(F.lit(code))
    if isinstance(kind, T.BooleanType):
        return _whole(column), lambda code: F.lit(bool(code))
    if isinstance(kind, T.IntegralType):
        return _whole(column), F.lit
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return column.cast("double"), F.lit
    if isinstance(kind, T.DecimalType):
        return column, F.lit
    return None


def _bound(column: Column, kind: T.DataType, ascending: bool, code: object) -> Column:
    """The rows whose leading sort value is as good as the one of this code, or better."""
    if not isinstance(kind, T.StringType):
        value = _code(column, kind)[1](code)
        return (column <= value) if ascending else (column >= value)
    exact = (_text_code(column) <= code) if ascending else (_text_code(column) >= code)
    start = _text_start(code)
    if not start:
        return exact
    # The plain comparison is wider, and reaches the scan where the column does.
    beyond = start[:-1] + chr(ord(start[-1]) + 1)
    return ((column < beyond) if ascending else (column >= start)) & exact


def count_all(matches: DataFrame, wanted: Sequence[Facet], cells: int, code: Column, ascending: bool) -> DataFrame:
    """``(agg_id, bucket_key, doc_count, best)`` of all buckets and cells, in one grouping."""
    cell = F.pmod(F.xxhash64(*m.KEY), F.lit(cells)).cast("string")
    hit = F.array(F.struct(F.lit(HITS).alias("agg_id"), cell.alias("bucket_key")))
    stacked = F.concat(stacked_buckets(matches, wanted), hit) if wanted else hit
    return (
        matches.select(code.alias("code"), F.explode(stacked).alias("bucket"))
        .select("bucket.agg_id", "bucket.bucket_key", "code")
        .where(F.col("bucket_key").isNotNull())
        .groupBy("agg_id", "bucket_key")
        .agg(F.count(F.lit(1)).alias("doc_count"), (F.min if ascending else F.max)("code").alias("best"))
    )


def summarise(matches: DataFrame, wanted: Sequence[Facet], hits: int, keys: Sequence[SortKey] = ()) -> Summary:
    """Facets, total, and the bound of the first ``hits`` matches, in one grouping of all.

    Each match becomes its facet buckets and one cell, chosen by its key's hash.  Tasks
    count them and keep each cell's best leading sort value before the one
    shuffle: at most ``CELLS_PER_HIT * hits`` cells and the buckets leave a task,
    never a match.  The best of ``hits`` different cells are as many matches, so none
    of the first ``hits`` is worse than the last of them.  Matches that tie with it on
    the leading sort value (of a text: on its first bytes) pass the bound too, so
    the page must still be sorted and cut.

    ``hits`` 0 asks for no bound.  There is none either where fewer cells have a leading
    value, where it ends beyond ``MOST_BOUNDED``, or where the leading column has no
    order by number.  The outcome is a table in the shared folder; only the cells,
    whose number is set by the page, come to the driver.
    """
    if any(facet.agg_id == HITS for facet in wanted):
        raise ValueError("a facet needs an id")
    spark = matches.sparkSession
    values = sort_values(matches, keys) if 0 < hits <= MOST_BOUNDED else []
    leading, ascending = values[0] if values else (F.lit(None).cast("long"), True)
    kind = matches.select(leading.alias("leading")).schema["leading"].dataType
    coded = (_text_code(leading), None) if isinstance(kind, T.StringType) else _code(leading, kind)
    if coded is None:
        values, coded = [], (F.lit(None).cast("long"), None)

    counts = count_all(matches, wanted, CELLS_PER_HIT * hits if values else 1, coded[0], ascending)
    path = scratch_path(spark, "summary")
    top_buckets(counts, wanted).write.parquet(path)
    written = spark.read.parquet(path)

    of_hits = written.where(F.col("agg_id") == HITS).select("doc_count", "best").collect()
    total = sum(row.doc_count for row in of_hits)
    codes = [row.best for row in of_hits if row.best is not None]
    codes.sort(key=lambda code: (code != code, code), reverse=not ascending)  # NaN is the greatest
    found = written.where(F.col("agg_id") != HITS).select("agg_id", "bucket_key", "doc_count")
    reached = bool(values) and len(codes) >= hits
    return Summary(found, total, _bound(leading, kind, ascending, codes[hits - 1]) if reached else None)
