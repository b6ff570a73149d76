"""Line dedup by winnowing: repeated runs of lines are deleted, the first stays.

Lines are compared without the spaces around them, and blank lines take no
part.  A line is one unit, or two (its halves) if it has ``long_words`` words or
more.  Of every ``window`` consecutive units the one with the least hash (the
last of equals) is a fingerprint, so two texts that share ``window`` units in a
row select the same fingerprint in them: a long line, or several short ones.

Positions are joined by fingerprint.  Where a fingerprint comes more than once,
it is extended both ways to each of the full windows around it; a window's
units and their place relative to the fingerprint are a key, whose first
occurrence is its least (document, position).  Adjacent windows continue each
other, so their union is the match as far as it reaches, against all
earlier texts at once.  A line that stands in very many documents costs a row
for each, never a pair.  Units are compared by BLAKE2b digests: a key holds 64 bits
of the fingerprint's and 64 of the window's, so no text is deleted for
another one that somebody could find.

Lines that lie wholly in windows seen before are deleted where they make a run
of at least ``least_words`` words; a text of which only blank lines are left goes.

Texts are ordered by id and then by a hash of the text.  Defined cases: a null
or blank text stays as it is; rows with equal id and text are one text, so
neither is the later; a row without id comes first; the column ``length``, if
there is one, becomes the length of the new text; other columns are kept; an
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliosearch.llm.batches import append_columns, column_at, free_names, groups, text_bytes
from foliosearch.llm.wordhash import word_ranges
from foliosearch.session import discard, scratch_path

WINDOW = 2
LONG_WORDS = 8
LEAST_WORDS = 6

IN_LINE = np.ones(256, bool)
IN_LINE[0x0A] = False
IN_WORD = np.ones(256, bool)
IN_WORD[[0x20, *range(0x09, 0x0E)]] = False


class Units:
    """The lines and units of texts: byte ranges, words of each line, first of each row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, long_words: int) -> None:
        first, last = word_ranges(data, offsets, IN_LINE)
        words, ends = word_ranges(data, offsets, IN_WORD)
        lo, hi = np.searchsorted(words, first), np.searchsorted(words, last)
        some = hi > lo  # the others are blank
        lo, hi = lo[some], hi[some]
        self.lines = np.stack([first[some], last[some]], 1)  # without the newline
        self.words = hi - lo
        start, end = words[lo] if len(lo) else lo, ends[hi - 1] if len(hi) else hi  # without spaces around
        self.pieces = np.where(self.words >= long_words, 2, 1)
        self.line = np.repeat(np.arange(len(lo)), self.pieces)
        first_unit = np.cumsum(self.pieces) - self.pieces
        middle = (start + end) // 2
        self.start, self.end = start[self.line], end[self.line]
        long = self.pieces == 2
        self.end[first_unit[long]] = middle[long]
        self.start[first_unit[long] + 1] = middle[long]
        self.line_rows = np.searchsorted(self.lines[:, 0], offsets)
        self.rows = np.append(first_unit, len(self.line))[self.line_rows]


DIGEST = 16


def digests_of(raw: bytes, starts: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """64 bits for each unit, and for each ``window`` units that follow each other."""
    units = b"".join(
        hashlib.blake2b(raw[s:e], digest_size=DIGEST).digest() for s, e in zip(starts.tolist(), ends.tolist())
    )
    last = len(units) - window * DIGEST
    windows = b"".join(
        hashlib.blake2b(units[at : at + window * DIGEST], digest_size=8).digest() for at in range(0, last + 1, DIGEST)
    )
    return np.frombuffer(units, np.uint64)[:: DIGEST // 8], np.frombuffer(windows, np.uint64)


def marks_of(units: np.ndarray, keys: np.ndarray, rows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the fingerprints, and for each the hashes of the windows around it.

    Column ``k`` is the window that starts ``k`` units before; 0 where the row
    has no such window.
    """
    n = len(units)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    if n < window:
        return np.empty(0, np.int64), np.empty((0, window), np.int64)
    whole = row[: n - window + 1] == row[window - 1 :]
    stack = np.stack([units[k : n - window + 1 + k] for k in range(window)], 1)
    pick = window - 1 - stack[:, ::-1].argmin(axis=1)
    chosen = np.zeros(n, bool)
    chosen[(np.arange(n - window + 1) + pick)[whole]] = True
    keys = np.where(whole, keys | np.uint64(1), np.uint64(0)).view(np.int64)
    at = np.flatnonzero(chosen)
    out = np.zeros((len(at), window), np.int64)
    for k in range(window):
        inside = (at - k >= 0) & (at - k < len(keys))
        out[inside, k] = keys[at[inside] - k]
    return at, out


def fingerprints(docs: DataFrame, window: int, long_words: int) -> DataFrame:
    """(id, text_key, pos, fp, keys) of every fingerprint of a table (id, text_key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for lo, hi in groups(offsets):
                part = offsets[lo : hi + 1] - offsets[lo]
                raw = data[offsets[lo] : offsets[hi]]
                units = Units(raw, part, long_words)
                hashes, windows = digests_of(raw.tobytes(), units.start, units.end, window)
                at, keys = marks_of(hashes, windows, units.rows, window)
                row = np.searchsorted(units.rows, at, side="right") - 1
                rows = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array((at - units.rows[row]).astype(np.int32)),
                        pa.array(hashes[at].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * window), pa.array(keys.ravel())),
                    ],
                    names=["id", "text_key", "pos", "fp", "keys"],
                )

    return docs.mapInArrow(run, "id long, text_key long, pos int, fp long, keys array<long>")


def repeated_windows(marks: DataFrame) -> DataFrame:
    """(id, text_key, starts): the windows of each text that an earlier place has too."""
    spark = marks.sparkSession
    paths = [scratch_path(spark, f"lines-{k}") for k in ("marks", "repeated", "windows", "first")]
    marks.write.parquet(paths[0])
    marks = spark.read.parquet(paths[0])
    marks.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp").write.parquet(paths[1])
    again = marks.join(spark.read.parquet(paths[1]), "fp", "left_semi")
    again.select("fp", "id", "text_key", "pos", F.posexplode("keys").alias("before", "key")).where("key <> 0").select(
        "fp", "key", "before", F.struct("id", "text_key", (F.col("pos") - F.col("before")).alias("start")).alias("place")
    ).write.parquet(paths[2])
    windows = spark.read.parquet(paths[2])
    windows.groupBy("fp", "key", "before").agg(F.min("place").alias("first"), F.max("place").alias("last")).where(
        "first < last"
    ).drop("last").write.parquet(paths[3])
    later = windows.join(spark.read.parquet(paths[3]), ["fp", "key", "before"]).where("place > first")
    return later.groupBy("place.id", "place.text_key").agg(F.array_sort(F.collect_set("place.start")).alias("starts"))


def _without_runs(raw: bytes, starts: list[int], window: int, long_words: int, least_words: int) -> str | None:
    """A text without its repeated lines; None if only blank lines are left."""
    data = np.frombuffer(raw, np.uint8)
    units = Units(data, np.array([0, len(data)]), long_words)
    covered = np.zeros(len(units.line) + 1, np.int64)
    np.add.at(covered, np.array(starts), 1)
    np.add.at(covered, np.array(starts) + window, -1)
    free = np.zeros(len(units.words), bool)
    free[units.line[np.cumsum(covered[:-1]) == 0]] = True
    edge = np.flatnonzero(np.diff(np.concatenate([[True], free, [True]])))
    for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist()):
        if units.words[a:b].sum() < least_words:
            free[a:b] = True
    if not free.any():
        return None
    lines = raw.split(b"\n")
    index = np.cumsum(data == 0x0A)
    index = np.concatenate([[0], index])[units.lines[:, 0]]
    gone = set(index[~free].tolist())
    return b"\n".join(line for k, line in enumerate(lines) if k not in gone).decode()


def drop_repeated_lines(
    docs: DataFrame,
    text: str = "text",
    id_: str = "doc_id",
    length: str | None = "n_chars",
    window: int = WINDOW,
    long_words: int = LONG_WORDS,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``docs`` with later repeated runs of lines deleted, and their columns otherwise."""
    key = F.xxhash64(F.col(text).cast("string"))
    marks = fingerprints(
        docs.select(F.col(id_).cast("long").alias("id"), key.alias("text_key"), F.col(text).cast("string").alias("text")),
        window,
        long_words,
    )
    spark = docs.sparkSession
    path = scratch_path(spark, "lines-later")
    repeated_windows(marks).write.parquet(path)
    of_id, of_key, found, own, made = free_names(docs.columns, "id", "key", "starts", "own", "cut")
    later = spark.read.parquet(path).select(F.col("id").alias(of_id), F.col("text_key").alias(of_key), F.col("starts").alias(found))
    joined = docs.withColumn(own, key).join(
        later, F.col(id_).cast("long").eqNullSafe(F.col(of_id)) & (F.col(own) == F.col(of_key)), "left"
    )
    marked = joined.drop(of_id, of_key, own)
    text_at, starts_at = column_at(marked.columns, text), marked.columns.index(found)

    def compute(batch: pa.RecordBatch) -> list:
        texts, starts = batch.column(text_at).cast(pa.string()), batch.column(starts_at)
        hit = starts.is_valid()
        cut = [
            _without_runs(texts[k].as_py().encode(), starts[k].as_py(), window, long_words, least_words)
            for k in np.flatnonzero(hit.to_numpy(zero_copy_only=False)).tolist()
        ]
        return [pc.replace_with_mask(texts, hit, pa.array(cut, pa.string()))]

    cut = append_columns(marked, T.StructType([T.StructField(made, T.StringType())]), compute)
    cut = cut.where(F.col(made).isNotNull() | F.col(found).isNull())
    new = {docs.columns[column_at(docs.columns, text)]: F.col(made)}
    if length and length.lower() in [c.lower() for c in docs.columns]:
        length = docs.columns[column_at(docs.columns, length)]
        new[length] = F.when(F.col(found).isNull(), F.col(f"`{length}`")).otherwise(F.length(made)).cast(docs.schema[length].dataType)
    return cut.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
