"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Words are runs of a-z, 0-9 and non-ASCII characters after A-Z is lower-cased.
Every ``size`` consecutive words of a test item are a window; an item of fewer
words, but not none, is one window.  The windows of all items are a set of
64-bit hashes that each task gets as a broadcast; a scan of the training
table hashes the windows of its words as flat arrays, looks them up, and
compares the words of each hit with those of the test window, so that equal
hashes alone never count.

The size of the set is checked: windows are dealt by hash into blocks of at
most ``block_bytes``, and where there are several blocks the table is scanned
once for each, with the words hit so far carried along.  Nothing is shuffled
but the test windows.

Defined cases: a null or empty text has no words and no hit; items without
words have no window; a null item id still marks words but is not listed;
repeated items count once; an empty table gives an empty table; other columns
of the training table are kept, and one named like a new column is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliosearch.llm.batches import ASCII_LOWER, append_columns, column_at, free_names, groups, row_sums, set_aside, text_bytes, without
from foliosearch.llm.wordhash import word_table
from foliosearch.session import discard, scratch_path

SIZE = 10
BLOCK_BYTES = 64 << 20
FILTER_BITS = 22

#: Bytes that belong to words, after lower-casing.
WORD = np.ones(256, bool)
WORD[0x00:0x30] = WORD[0x3A:0x61] = WORD[0x7B:0x80] = False

# Odd multipliers, one for each place in a window; any fixed odd numbers do.
PLACES = np.random.default_rng(10).integers(1 << 62, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("hit_words", T.BinaryType()),
    ]
)
CLASHING = [*HITS.names, "hit_words_before", "items_before"]


def place_hashes(size: int) -> np.ndarray:
    extra = np.random.default_rng(11).integers(1 << 62, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return PLACES[:size] if size <= len(PLACES) else extra


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for every ``size`` consecutive words, in the order of their first."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    places = place_hashes(size)
    out = hashes[:n] * places[0]
    for j in range(1, size):
        out += hashes[j : j + n] * places[j]
    return out ^ (out >> np.uint64(29))


def test_windows(items: DataFrame, item: str, text: str, size: int) -> DataFrame:
    """The distinct windows of all items with the ids of the items that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            words = word_table(ASCII_LOWER[data], offsets, WORD)
            out: list[tuple] = []
            for row, id_ in enumerate(batch.column(0).to_pylist()):
                lo, hi = words.rows[row], words.rows[row + 1]
                if lo == hi:
                    continue
                width = min(size, hi - lo)
                spelled = words.spelled(lo, hi)
                for i, h in enumerate(window_hashes(words.hashes[lo:hi], width)):
                    out.append((width, int(h.view(np.int64)), b" ".join(spelled[i : i + width]).decode(), id_))
            width, h, spelled, ids = zip(*out) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(width, pa.int32()), pa.array(h, pa.int64()), pa.array(spelled, pa.string()), pa.array(ids, pa.string())],
                names=["width", "hash", "words", "item"],
            )

    rows = items.select(F.col(item).cast("string"), F.col(text).cast("string"))
    found = rows.mapInArrow(run, "width int, hash long, words string, item string")
    return found.groupBy("width", "hash", "words").agg(F.sort_array(F.collect_set("item")).alias("items"))


class WindowSet:
    """One block of test windows, as each task holds it."""

    def __init__(self, rows: list) -> None:
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.entries: dict[tuple[int, int], list[tuple[bytes, list[str]]]] = {}
        hashes: dict[int, list[int]] = {}
        for width, h, words, items in rows:
            hashes.setdefault(width, []).append(h)
            self.entries.setdefault((width, h), []).append((words.encode(), items))
        for width, values in hashes.items():
            known = np.unique(np.array(values, np.int64).view(np.uint64))
            table = np.zeros(1 << FILTER_BITS, bool)
            table[(known >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.by_width[width] = (known, table)

    def mark(self, words, hit: np.ndarray, items: list[set[str]]) -> None:
        """Set ``hit`` for all words in occurrences, and add to each row's items."""
        edges = np.zeros(len(hit) + 1, np.int64)
        row_of = np.repeat(np.arange(len(words.rows) - 1), np.diff(words.rows))
        for width, (known, table) in self.by_width.items():
            found = window_hashes(words.hashes, width)
            at = np.flatnonzero(table[(found >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            at = at[row_of[at] == row_of[at + width - 1]]
            place = np.minimum(np.searchsorted(known, found[at]), len(known) - 1)
            at = at[known[place] == found[at]]
            for i in at.tolist():
                spelled = b" ".join(words.spelled(i, i + width))
                for test, ids in self.entries[width, int(found[i].view(np.int64))]:
                    if test == spelled:
                        edges[i] += 1
                        edges[i + width] -= 1
                        items[row_of[i]].update(ids)
        hit |= np.cumsum(edges[:-1]) > 0


_last: list = []


def _built(rows: list) -> WindowSet:
    """The set of a block; a worker builds it once and holds one at a time."""
    if not _last or _last[0] is not rows:
        _last[:] = [rows, WindowSet(rows)]
    return _last[1]


def _scan(df: DataFrame, text: str, block, earlier: bool) -> DataFrame:
    if earlier:  # read what was found so far, and write it anew
        df = df.withColumnsRenamed({"hit_words": "hit_words_before", "items": "items_before"})
    names = without(df, HITS.names).columns
    place, before = column_at(names, text), [names.index(c) for c in ("hit_words_before", "items_before")] if earlier else []

    def compute(batch: pa.RecordBatch) -> list:
        known = _built(block.value)
        data, offsets = text_bytes(batch.column(place))
        n_words, n_hit, listed, bits = [], [], [], []
        for lo, hi in groups(offsets):
            part = offsets[lo : hi + 1]
            words = word_table(ASCII_LOWER[data[part[0] : part[-1]]], part - part[0], WORD)
            hit, items = np.zeros(len(words.hashes), bool), [set() for _ in range(hi - lo)]
            if before:
                for k in range(lo, hi):
                    a, b = words.rows[k - lo], words.rows[k - lo + 1]
                    packed = np.frombuffer(batch.column(before[0])[k].as_py(), np.uint8)
                    hit[a:b] = np.unpackbits(packed, count=b - a)
                    items[k - lo].update(batch.column(before[1])[k].as_py())
            known.mark(words, hit, items)
            n_words += np.diff(words.rows).tolist()
            n_hit += row_sums(hit, words.rows).tolist()
            listed += [sorted(x) for x in items]
            bits += [np.packbits(hit[a:b]).tobytes() for a, b in zip(words.rows[:-1], words.rows[1:])]
        return [n_words, n_hit, listed, bits]

    return append_columns(df, HITS, compute).drop("hit_words_before", "items_before")


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = SIZE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with n_words, n_hit, items (ids, sorted) and hit_words.

    ``hit_words`` has a bit for each word of the text, set where the word lies
    in an occurrence of a test window.
    """
    spark = docs.sparkSession
    docs = without(docs, CLASHING)
    path = scratch_path(spark, "test-windows")
    cost = F.sum(F.length("words") + 64 + F.coalesce(F.expr("aggregate(items, 0L, (n, x) -> n + length(x) + 16)"), F.lit(0)))
    test_windows(items, item, item_text, size).write.parquet(path)
    windows = spark.read.parquet(path)
    blocks = max(1, -(-(windows.agg(cost.alias("bytes")).first()["bytes"] or 0) // block_bytes))
    found = docs
    for k in range(blocks):
        rows = windows.where(F.pmod("hash", F.lit(blocks)) == k)
        known = [tuple(row) for row in rows.select("width", "hash", "words", "items").collect()]
        found = _scan(found, text, spark.sparkContext.broadcast(known), earlier=k > 0)
        if k < blocks - 1:
            step = scratch_path(spark, "hits")
            found.write.parquet(step)
            found = spark.read.parquet(step)
    discard(spark, path)
    return found


def report(hits: DataFrame) -> DataFrame:
    """What the benchmark query returns, from the output of :func:`find_hits`."""
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents without any hit, with their own columns."""
    rows, names = set_aside(docs, CLASHING)
    clean = find_hits(rows, items, text=names[column_at(docs.columns, text)], **options).where(F.col("n_hit") == 0)
    return clean.select(*[F.col(f"`{name}`").alias(c) for name, c in zip(names, docs.columns)])


def remove_spans(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents with every hit word cut out of the text.

    A run of hit words goes with what stands between its words; what stands
    before its first and after its last word stays.
    """
    rows, names = set_aside(docs, CLASHING)
    text = names[column_at(docs.columns, text)]
    marked = find_hits(rows, items, text=text, **options)
    places = [column_at(marked.columns, c) for c in (text, "n_hit", "hit_words")]
    (made,) = free_names(marked.columns, "cut")

    def compute(batch: pa.RecordBatch) -> list:
        texts, counts, bits = (batch.column(p) for p in places)
        out = []
        for value, n, packed in zip(texts.to_pylist(), counts.to_pylist(), bits.to_pylist()):
            if n:
                raw = np.frombuffer(value.encode(), np.uint8)
                words = word_table(ASCII_LOWER[raw], np.array([0, len(raw)]), WORD)
                hit = np.unpackbits(np.frombuffer(packed, np.uint8), count=len(words.hashes)).astype(bool)
                edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
                first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
                cuts = np.stack([words.starts[first], words.ends[last]], 1).ravel().tolist()
                bounds = [0, *cuts, len(raw)]
                value = b"".join(raw[a:b].tobytes() for a, b in zip(bounds[::2], bounds[1::2])).decode()
            out.append(value)
        return [out]

    result = append_columns(marked, T.StructType([T.StructField(made, T.StringType())]), compute)
    changed = column_at(names, text)
    return result.select(*[F.col(made if k == changed else f"`{name}`").alias(c) for k, (name, c) in enumerate(zip(names, docs.columns))])


def items_digest(items: list[str]) -> str:
    """The digest that :func:`report` gives for a list of item ids."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
