"""Language-model scores by a probabilistic suffix tree, beside a unigram base.

A text is its words, spelled in bytes with A-Z lower-cased, a space after each,
and an end.  The tree's states are contexts of up to ``order`` bytes.  All grams
of the training texts are counted.  A context is retained if its next-symbol
distribution diverges from that of the context one byte shorter by enough: its
count times the Kullback-Leibler divergence, in bits, exceeds half the number of
its distinct next symbols times log2 of the corpus's symbols, the price of
those parameters; with it go its suffixes.  The evidence of a context grows with
the corpus and the price only by its logarithm, so a larger corpus has more
states.  ``gain`` may ask for so many bits for each symbol of the corpus
besides; 0 asks for none.

The states stay in Spark.  A tree of at most ``HELD_CELLS`` states times symbol
classes is collected and broadcast.  A larger one is met by joins: each block of
texts has a dictionary of its grams, whose distinct grams get their code
lengths level by level, and the lengths go back to the blocks.

Distributions are smoothed by the shorter context's: (n + a p) / (N + a), where a
is half the number of distinct symbols seen, and 1 at least; below the
empty context all bytes are equally likely.  A text's score is the sum over its
symbols of the log probability in the longest suffix state, as log10.

The base score and known words need the corpus count of every word of a text.
Texts are read in blocks of a bounded number of tokens, each with a dictionary of
its words.  Only the dictionaries are summed over the corpus, by word, so the
commonest word has one row for each block; the counts then go back to their
blocks, where they meet the texts' word numbers.

Defined cases: a null or blank text is its end alone; a row without an id is
held out; repeated rows count as often as they come and are scored alike;
with no training text N and V are 0 and every symbol is equally likely; an
empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from foliosearch.llm.batches import text_bytes
from foliosearch.llm.contexts import gram_keys, longest_contexts, merged, node_sums
from foliosearch.session import discard, scratch_path

ORDER = 5
GAIN = 0.0
HELD_CELLS = 8_000_000  # 8 bytes each on the driver and in each task
UNIT = 1 << 16
END = 0x0A  # no word has it
GROUP_BYTES = 2 << 20
COUNTED_BYTES = 512 << 10  # grams of a group take 30 times that
SCORED_BYTES = 128 << 10  # arrays of a group stay in a core's cache
BLOCK_TOKENS = 4_000_000
GRAMS_HELD = 2_000_000


def held_out(id_: str = "doc_id", folds: int = 7, fold: int = 2) -> Column:
    """Rows that training never sees; also those without an id."""
    return F.coalesce(F.crc32(F.col(id_).cast("string")) % folds == fold, F.lit(True))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def _streams(column: pa.Array, limit: int) -> Iterator[list[list[bytes]]]:
    """The words of each text, in groups of texts of bounded size.

    Texts are copied one by one: a copy of the whole batch would stay in the worker's memory.
    """
    data, offsets = text_bytes(column)
    group, size = [], 0
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if group and size + b - a > limit:
            yield group
            group, size = [], 0
        group.append(words_of(data[a:b].tobytes()))
        size += b - a
    if group:
        yield group


def spelled(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as symbols: words, a space after each, and an end."""
    parts = [b" ".join([*words, b"\n"]) for words in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0] + [len(p) for p in parts])


# -- the tree -------------------------------------------------------------


def gram_counts(texts: DataFrame, order: int) -> DataFrame:
    """(gram, n) over the texts, summed in tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list = []
        for batch in batches:
            for group in _streams(batch.column(0), COUNTED_BYTES):
                symbols, offsets = spelled(group)
                parts.append(np.unique(gram_keys(symbols, offsets, order, END), return_counts=True))
                if len(parts) > 16:
                    parts = [merged(parts)]
                if len(parts[0][0]) > GRAMS_HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged(parts)], names=["gram", "n"])
                    parts = []
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged(parts)], names=["gram", "n"])
        pa.default_memory_pool().release_unused()

    return texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def retained(grams: DataFrame, order: int, gain: float) -> DataFrame:
    """(depth, key, n): next-symbol counts of the retained contexts and the empty one.

    ``key`` is the context's bytes above the symbol's.
    """
    depth = F.explode(F.sequence(F.lit(0), F.lit(order))).alias("depth")
    masks = F.array(*[F.lit((1 << 8 * size) - 1).cast("long") for size in range(1, order + 2)])
    mask = lambda size: F.element_at(masks, size)
    counts = (
        grams.select("gram", "n", depth)
        .select("depth", F.col("gram").bitwiseAND(mask(F.col("depth") + 1)).alias("key"), "n")
        .groupBy("depth", "key")
        .agg(F.sum("n").alias("n"))
        .withColumn("context", F.shiftright("key", 8))
    )
    # A context has 256 symbols at most.
    counts = counts.withColumn("total", F.sum("n").over(Window.partitionBy("depth", "context")))
    spark = grams.sparkSession
    path = scratch_path(spark, "context-counts")
    counts.write.parquet(path)
    counts = spark.read.parquet(path)
    corpus = counts.where("depth = 0").agg(F.sum("n")).first()[0] or 0
    shorter = counts.select(
        (F.col("depth") + 1).alias("depth"), F.col("key").alias("suffix"), F.col("n").alias("m"), F.col("total").alias("of")
    )
    diverges = (
        counts.where("depth > 0")
        .withColumn("suffix", F.col("key").bitwiseAND(mask(F.col("depth"))))
        .join(shorter, ["depth", "suffix"])
        .groupBy("depth", "context")
        .agg(
            F.sum(F.col("n") * F.log2(F.col("n") / F.col("total") * F.col("of") / F.col("m"))).alias("bits"),
            F.count("*").alias("seen"),
        )
        .where((F.col("bits") > F.col("seen") / 2 * math.log2(max(corpus, 2))) & (F.col("bits") >= gain * corpus))
    )
    suffixes = diverges.select("context", F.explode(F.sequence(F.lit(1), "depth")).alias("depth")).select(
        "depth", F.col("context").bitwiseAND(mask(F.col("depth"))).alias("context")
    )
    kept = suffixes.distinct()
    return counts.join(kept, ["depth", "context"], "left_semi").unionByName(counts.where("depth = 0")).select("depth", "key", "n")


@dataclass
class Tree:
    """States as a trie, and the code length of each symbol class in each state."""

    order: int
    symbol: np.ndarray  # 256: class of a byte; the last class is all unseen bytes
    child: np.ndarray
    cost: np.ndarray  # states x classes, flat: units
    classes: int


def build(depth: np.ndarray, key: np.ndarray, n: np.ndarray, order: int) -> Tree:
    """The tree of the retained counts."""
    root = depth == 0
    seen = np.unique(key[root])
    symbol = np.full(256, len(seen), np.int64)
    symbol[seen] = np.arange(len(seen))
    classes = len(seen) + 1
    child, dist = [np.full((1, classes), -1, np.int32)], []
    above = np.zeros(1, np.int64)
    below = np.full((1, classes), 1 / 256)
    for length in range(order + 1):
        own = depth == length
        contexts = np.unique(key[own] >> 8) if length else np.zeros(1, np.int64)
        if length:
            first = sum(len(c) for c in child)
            parent = np.searchsorted(above, contexts & ((1 << 8 * (length - 1)) - 1))
            child[-1][parent, symbol[contexts >> (8 * (length - 1))]] = first + np.arange(len(contexts))
            child.append(np.full((len(contexts), classes), -1, np.int32))
            below = dist[-1][parent]
        counts = np.zeros((len(contexts), classes))
        np.add.at(counts, (np.searchsorted(contexts, key[own] >> 8), symbol[key[own] & 0xFF]), n[own])
        weight = np.maximum((counts > 0).sum(axis=1, keepdims=True) / 2, 1)
        dist.append((counts + weight * below) / (counts.sum(axis=1, keepdims=True) + weight))
        above = contexts
    cost = np.rint(-np.log2(np.concatenate(dist)) * UNIT).astype(np.int32)
    return Tree(order, symbol, np.concatenate(child).ravel(), cost.ravel(), classes)


def learn(texts: DataFrame, order: int = ORDER, gain: float = GAIN) -> DataFrame:
    """The retained counts of a table (text), written."""
    spark = texts.sparkSession
    path, states_path = scratch_path(spark, "grams"), scratch_path(spark, "states")
    gram_counts(texts, order).write.parquet(path)
    retained(spark.read.parquet(path), order, gain).write.parquet(states_path)
    discard(spark, path)
    return spark.read.parquet(states_path)


def cells(states: DataFrame) -> int:
    """States times symbol classes of a tree."""
    contexts = states.select("depth", F.shiftright("key", 8).alias("context")).distinct().count()
    return contexts * (states.where("depth = 0").count() + 1)


def collected(states: DataFrame, order: int) -> Tree:
    found = states.toArrow()
    return build(*(found.column(c).to_numpy() for c in ("depth", "key", "n")), order)


def train(texts: DataFrame, order: int = ORDER, gain: float = GAIN) -> Tree:
    """The tree of a table (text)."""
    return collected(learn(texts, order, gain), order)


def gram_units(grams: DataFrame, states: DataFrame, order: int) -> DataFrame:
    """(gram, units): the code length of each distinct gram's symbol, in its longest suffix state."""
    spark = grams.sparkSession
    path = scratch_path(spark, "distinct-grams")
    grams.select("gram").distinct().write.parquet(path)
    grams, level, paths = spark.read.parquet(path), None, [path]
    for depth in range(order + 1):
        own = states.where(F.col("depth") == depth)
        of = own.groupBy(F.shiftright("key", 8).alias("context")).agg(
            F.sum("n").alias("total"), F.greatest(F.count("*") / 2, F.lit(1.0)).alias("weight")
        )
        keys = grams.select(F.col("gram").bitwiseAND(F.lit((1 << 8 * (depth + 1)) - 1).cast("long")).alias("key")).distinct()
        found = keys.join(of, F.shiftright("key", 8) == F.col("context"), "left").join(
            own.select(F.col("key").alias("known"), "n"), F.col("key") == F.col("known"), "left"
        )
        below = F.lit(1 / 256)
        if level is not None:
            shorter = level.select(F.col("key").alias("suffix"), F.col("p").alias("below"))
            found = found.join(shorter, F.col("key").bitwiseAND(F.lit((1 << 8 * depth) - 1).cast("long")) == F.col("suffix"))
            below = F.col("below")
        smoothed = (F.coalesce("n", F.lit(0)) + F.col("weight") * below) / (F.col("total") + F.col("weight"))
        path = scratch_path(spark, "gram-level")
        found.select("key", F.when(F.col("total").isNull(), below).otherwise(smoothed).alias("p")).write.parquet(path)
        level = spark.read.parquet(path)
        paths.append(path)
    for used in paths[:-1]:
        discard(spark, used)
    return level.select(F.col("key").alias("gram"), F.rint(-F.log2("p") * UNIT).cast("long").alias("units"))


def text_units(tree: Tree, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code length of each spelled text, in units."""
    if len(symbols) > 4 * GROUP_BYTES:  # one long text: pieces that see the bytes before them
        out = np.zeros(1, np.int64)
        for at in range(0, len(symbols), GROUP_BYTES):
            before = min(at, tree.order)
            part = symbols[at - before : at + GROUP_BYTES]
            out += text_units(tree, part, np.array([0, len(part)])) - text_units(tree, part[:before], np.array([0, before]))
        return out
    classes = tree.symbol[symbols]
    state = longest_contexts(tree.child, tree.classes, classes, offsets, tree.order, int(tree.symbol[END]))
    return node_sums(tree.cost.take(state + classes), offsets)


def joined_units(codes: list[np.ndarray], spelling: list[bytes], order: int, gram: np.ndarray, units: np.ndarray) -> np.ndarray:
    """The same for texts as word numbers, by the code lengths of their grams (sorted)."""
    out, group, size = [], [], 0
    for k, text in enumerate(codes):
        group.append([spelling[c] for c in text[:-1].tolist()])
        size += sum(map(len, group[-1])) + len(text)
        if size >= GROUP_BYTES or k == len(codes) - 1:
            symbols, offsets = spelled(group)
            out.append(node_sums(units[np.searchsorted(gram, gram_keys(symbols, offsets, order, END))], offsets))
            group, size = [], 0
    return np.concatenate(out) if out else np.empty(0, np.int64)


# -- scores ---------------------------------------------------------------

BLOCKS = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),  # 0 a text, 1 a word of the block's dictionary, 2 a gram of it
        T.StructField("block", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("codes", T.BinaryType()),  # 32-bit word numbers, the end among them
        T.StructField("word", T.BinaryType()),  # empty for the end
        T.StructField("code", T.IntegerType()),
        T.StructField("n", T.LongType()),  # in the block's training texts
        T.StructField("gram", T.LongType()),
    ]
)


def _log10(units: np.ndarray) -> np.ndarray:
    return units / -UNIT * np.log10(2)


class _Block:
    def __init__(self, number: int) -> None:
        self.number, self.codes, self.rows, self.trains = number, {b"": 0}, [], []
        self.grams: list[np.ndarray] = []

    def add(self, doc_id: int | None, out: bool, score: float | None, words: list[bytes]) -> None:
        known = self.codes
        codes = np.array([known.setdefault(w, len(known)) for w in words] + [0], np.int32)
        self.rows.append((doc_id, out, score, codes))

    def add_grams(self, grams: np.ndarray) -> None:
        self.grams.append(grams)
        if len(self.grams) > 8:
            self.grams = [np.unique(np.concatenate(self.grams))]

    def tokens(self) -> int:
        return sum(len(r[3]) for r in self.rows)

    def batches(self) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(self.codes), np.int64)
        for _, out, _, codes in self.rows:
            if not out:
                counts += np.bincount(codes, minlength=len(counts))
        rows, words = len(self.rows), len(self.codes)
        ids, outs, scores, codes = zip(*self.rows)
        yield self._batch(
            rows, kind=pa.array([0] * rows, pa.int32()), doc_id=pa.array(ids, pa.int64()), held_out=pa.array(outs),
            score=pa.array(scores, pa.float64()), codes=pa.array([c.tobytes() for c in codes], pa.binary()),
        )
        yield self._batch(
            words, kind=pa.array(np.ones(words, np.int32)), word=pa.array(list(self.codes), pa.binary()),
            code=pa.array(np.arange(words, dtype=np.int32)), n=pa.array(counts),
        )
        if self.grams:
            grams = np.unique(np.concatenate(self.grams))
            yield self._batch(len(grams), kind=pa.array(np.full(len(grams), 2, np.int32)), gram=pa.array(grams))

    def _batch(self, rows: int, **columns: pa.Array) -> pa.RecordBatch:
        kinds = {"kind": pa.int32(), "block": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(), "score": pa.float64()}
        kinds |= {"codes": pa.binary(), "word": pa.binary(), "code": pa.int32(), "n": pa.int64(), "gram": pa.int64()}
        columns["block"] = pa.array(np.full(rows, self.number))
        return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(rows, k)) for c, k in kinds.items()], names=list(kinds))


def _blocks(texts: DataFrame, tree: Tree | None, order: int) -> DataFrame:
    """Texts and dictionaries, by block, of a table (doc_id, held_out, text).

    With a tree the texts are scored; without one the blocks have their grams.
    """
    known = texts.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = known.value
        number = TaskContext.get().partitionId() << 32
        block, tokens = _Block(number), 0
        for batch in batches:
            at, ids, outs = 0, batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for group in _streams(batch.column(2), SCORED_BYTES):
                symbols, offsets = spelled(group)
                if tree is None:
                    block.add_grams(np.unique(gram_keys(symbols, offsets, order, END)))
                    scores = [None] * len(group)
                else:
                    scores = _log10(text_units(tree, symbols, offsets)).tolist()
                for words, cost in zip(group, scores):
                    block.add(ids[at], outs[at], cost, words)
                    tokens += len(words) + 1
                    at += 1
                if tokens >= BLOCK_TOKENS:
                    yield from block.batches()
                    number += 1
                    block, tokens = _Block(number), 0
        if block.rows:
            yield from block.batches()
        pa.default_memory_pool().release_unused()

    return texts.mapInArrow(run, BLOCKS)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, text: str = "text", id_: str = "doc_id", order: int = ORDER, gain: float = GAIN) -> DataFrame:
    """Every text's scores, learned from the texts that aren't held out."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_).cast("long").alias("doc_id"), held_out(id_).alias("held_out"), F.col(text).cast("string").alias("text"))
    states = learn(texts.where("not held_out").select("text"), order, gain)
    tree = collected(states, order) if cells(states) <= HELD_CELLS else None

    blocks_path, known_path = scratch_path(spark, "blocks"), scratch_path(spark, "word-counts")
    _blocks(texts, tree, order).write.partitionBy("kind").option("compression", "zstd").parquet(blocks_path)
    blocks = spark.read.schema(BLOCKS).parquet(blocks_path)
    word = Window.partitionBy("word")
    blocks.where("kind = 1").select(
        "block", "code", "n", *(["word"] if tree is None else []), F.sum("n").over(word).alias("c"), (F.min("block").over(word) == F.col("block")).alias("first")
    ).write.parquet(known_path)
    known = spark.read.parquet(known_path)
    sums = known.agg(F.sum("n").alias("N"), F.sum((F.col("first") & (F.col("c") > 0)).cast("long")).alias("V")).first()
    tokens, distinct = sums["N"] or 0, sums["V"] or 0

    by_joins = tree is None
    dictionary = known.select("block", "code", "c", *(["word"] if by_joins else []))
    if by_joins:
        grams = blocks.where("kind = 2").select("block", "gram")
        dictionary = dictionary.unionByName(grams.join(gram_units(grams, states, order), "gram"), allowMissingColumns=True)

    def run(texts: pa.Table, counts: pa.Table) -> pa.Table:
        if by_joins:
            gram = counts.filter(pc.is_valid(counts.column("gram"))).sort_by("gram")
            counts = counts.filter(pc.is_null(counts.column("gram"))).sort_by("code")
        c = np.zeros(counts.num_rows, np.int64)
        c[counts.column("code").to_numpy()] = counts.column("c").to_numpy()
        codes = [np.frombuffer(x, np.int32) for x in texts.column("codes").to_pylist()]
        lengths = np.array([len(x) for x in codes], np.int64)
        starts = np.cumsum(lengths) - lengths
        scores = texts.column("score")
        if by_joins:
            known_grams = (gram.column(k).to_numpy() for k in ("gram", "units"))
            scores = pa.array(_log10(joined_units(codes, counts.column("word").to_pylist(), order, *known_grams)))
        each = c[np.concatenate(codes)] if codes else np.empty(0, np.int64)
        base = np.add.reduceat(np.log10((each + 1) / (tokens + distinct + 1)), starts) if codes else np.empty(0)
        known = np.add.reduceat((each > 0).astype(np.int64), starts) if codes else np.empty(0, np.int64)
        columns = [
            texts.column("doc_id"), texts.column("held_out"), pa.array(lengths), pa.array(known),
            pa.array(np.full(len(codes), tokens, np.int64)), pa.array(base), scores,
        ]
        return pa.table(columns, names=[f.split()[0] for f in SCORES.split(", ")])

    rows = blocks.where("kind = 0").select("block", "doc_id", "held_out", "score", "codes").groupBy("block")
    return rows.cogroup(dictionary.groupBy("block")).applyInArrow(run, SCORES)
