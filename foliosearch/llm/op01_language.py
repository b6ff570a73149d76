"""Language identification by prediction by partial matching over bytes.

Each language has a context tree: for every context of up to ``order`` bytes,
how often each byte came next.  A byte that a context has seen costs its share
of the context's counts; one it hasn't costs an escape, after which the
next shorter context predicts among the bytes not excluded (method C: a
context of ``n`` bytes, ``q`` of them distinct, escapes with q / (n + q)).  Below
the empty context all bytes are equally likely.  Counts are frozen, so the cost
of a byte after a context is a fixed number; all contexts of all languages share
one trie, and a table holds for each of its nodes and each byte the code
length in every language.

A text's code length in a language is the exact sum over its bytes (in units of
2^-16 bits, so sums don't depend on order).  The language with the least is
predicted; ties go to the first name.  The score is its probability among the
learned languages, each as likely before.

Training is bounded: of each language's labelled rows of up to ``most_bytes``
bytes it draws ``per_language`` rows on average, by a hash; of their contexts it
keeps the ``contexts`` most frequent.  All three are parameters.  Every text is scored whole, whatever its length.

Defined cases: a null text, and one without a letter, is ``und`` with score 0;
rows with a null language teach nothing; without any labelled row every text is
``und`` with score 0; repeated rows are scored alike, and repeated training
rows count as often as they are drawn; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliosearch.llm.batches import append_columns, column_at, free_names, groups, set_aside, text_bytes
from foliosearch.llm.contexts import gram_keys, longest_contexts, node_sums

ORDER = 3
PER_LANGUAGE = 1000
MOST_BYTES = 1 << 16
CONTEXTS = 20_000
UNIT = 1 << 16
PAD = 0  # the bytes before a text
DRAWS = 1 << 40
SLICE = 1024  # contexts at a time while the table is built
UNKNOWN = "und"
GROUP_BYTES = 128 << 10  # arrays of a group stay in a core's cache

FIELDS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


@dataclass
class Model:
    """Bytes by class, the trie of contexts, and code lengths by node and class."""

    languages: list[str]
    order: int
    symbol: np.ndarray  # 256: class of a byte; one class is all unseen bytes
    child: np.ndarray  # nodes x classes: node of the context one byte longer, or -1
    cost: np.ndarray  # (nodes x classes) x languages: units
    classes: int
    pad: int  # class of the bytes before a text; only contexts have it


def count_grams(texts: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n) over a table (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for name in sorted(set(names)):
                data, offsets = text_bytes(batch.column(1).filter(pa.array(names == name)))
                keys, counts = np.unique(gram_keys(data, offsets, order, PAD), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], names=["lang", "gram", "n"]
                )

    return texts.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def sample(labelled: DataFrame, per_language: int, most_bytes: int) -> DataFrame | None:
    """The training rows (lang, text) of a table (lang, text, draw), or None if there are none.

    ``draw`` is a hash of the row; a language's rows are taken where it lies in
    the share that gives ``per_language`` rows on average.
    """
    rows = labelled.where((F.octet_length("text") <= most_bytes) & F.col("lang").isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    taken = F.lit(False)
    for name, count in sorted(counts.items()):
        share = min(DRAWS, DRAWS * per_language // count)
        taken = taken | ((F.col("lang") == name) & (F.pmod("draw", F.lit(DRAWS)) < share))
    return rows.where(taken).select("lang", "text")


def build(names: np.ndarray, gram: np.ndarray, n: np.ndarray, order: int, contexts: int) -> Model:
    """The model of gram counts: language, gram and count."""
    languages = sorted(set(names))
    lang = np.searchsorted(np.array(languages, object), names)
    seen = np.unique(gram & 0xFF)
    symbol = np.full(256, len(seen), np.int64)
    symbol[seen] = np.arange(len(seen))
    classes = len(seen) + 2
    pad = int(symbol[PAD]) if PAD in seen else classes - 1
    copies = np.ones(classes)
    copies[-2:] = max(256 - len(seen), 1), 0  # how many bytes a class stands for

    # Of each language its most frequent contexts, of equals the shorter: the
    # suffixes of a context come at least as often, so they are kept with it.
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    for length in range(1, order + 1):
        values, where = np.unique((gram >> 8) & ((1 << 8 * length) - 1), return_inverse=True)
        often = np.zeros((len(values), len(languages)), np.int64)
        np.add.at(often, (where, lang), n)
        kept.append((values, often))
    often, lengths = np.concatenate([t for _, t in kept]), np.repeat(np.arange(order), [len(v) for v, _ in kept])
    taken = np.zeros(len(often), bool)
    for k in range(len(languages)):
        best = np.lexsort((lengths, -often[:, k]))[:contexts]
        taken[best[often[best, k] > 0]] = True
    node_of: list[tuple[np.ndarray, int]] = [(np.zeros(1, np.int64), 0)]
    nodes = 1
    for length, (values, _) in enumerate(kept):
        values = values[taken[lengths == length]]
        node_of.append((values, nodes))
        nodes += len(values)

    child = np.full((nodes, classes), -1, np.int32)
    dist = np.zeros((nodes, classes, len(languages)), np.float32)
    cost = np.zeros((nodes, classes, len(languages)), np.int32)
    for length, (values, first) in enumerate(node_of):
        context = (gram >> 8) & ((1 << 8 * length) - 1)
        order_ = np.argsort(context, kind="stable")
        ordered = context[order_]
        for lo in range(0, len(values), SLICE):
            part = values[lo : lo + SLICE]
            rows_ = order_[np.searchsorted(ordered, part[0]) : np.searchsorted(ordered, part[-1], side="right")]
            at = np.searchsorted(part, context[rows_])
            inside = part[at] == context[rows_]
            at, rows_ = at[inside], rows_[inside]
            table = np.zeros((len(part), classes, len(languages)))
            np.add.at(table, (at, symbol[gram[rows_] & 0xFF], lang[rows_]), n[rows_])
            here = slice(first + lo, first + lo + len(part))
            if length:
                shorter_values, shorter_first = node_of[length - 1]
                shorter = shorter_first + np.searchsorted(shorter_values, part & ((1 << 8 * (length - 1)) - 1))
                oldest = part >> (8 * (length - 1))
                child[shorter, np.where(oldest == PAD, pad, symbol[oldest])] = np.arange(here.start, here.stop)
                below = dist[shorter].astype(float)
            else:
                below = np.full((1, classes, len(languages)), 1 / 256)
            value = _blend(table, below, copies)
            dist[here] = value
            cost[here] = np.rint(-np.log2(np.maximum(value, 1e-30)) * UNIT)
    return Model(languages, order, symbol, child.ravel(), cost.reshape(nodes * classes, len(languages)), classes, pad)


def _blend(table: np.ndarray, below: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """Probabilities of contexts x classes x languages from counts and the shorter contexts'."""
    total = table.sum(axis=1, keepdims=True)
    distinct = (table > 0).sum(axis=1, keepdims=True)
    open_ = np.where(table > 0, 0.0, below)
    rest = (open_ * copies[None, :, None]).sum(axis=1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        known = np.where(rest > 0, table / (total + distinct), table / total)
        escaped = distinct / (total + distinct) * open_ / rest
    return np.where(total > 0, np.where(table > 0, known, escaped), below)


def train(
    labelled: DataFrame,
    order: int = ORDER,
    per_language: int = PER_LANGUAGE,
    most_bytes: int = MOST_BYTES,
    contexts: int = CONTEXTS,
) -> Model | None:
    """The model of a table (lang, text, draw); None if no row is labelled.

    The counts that reach the driver are those of the bounded sample.
    """
    rows = sample(labelled, per_language, most_bytes)
    if rows is None:
        return None
    found = count_grams(rows, order).toArrow()
    return build(*(found.column(c).to_numpy() for c in ("lang", "gram", "n")), order, contexts) if found.num_rows else None


def code_lengths(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts x languages: code lengths in units."""
    symbols = model.symbol[data]
    node = longest_contexts(model.child, model.classes, symbols, offsets, model.order, model.pad)
    at = node + symbols
    return np.stack([node_sums(model.cost[at, k], offsets) for k in range(len(model.languages))], 1)


def long_code_lengths(model: Model, data: np.ndarray, piece: int) -> np.ndarray:
    """Code lengths of one long text, taken in pieces that each see the bytes before."""
    out = np.zeros(len(model.languages), np.int64)
    for at in range(0, len(data), piece):
        before = min(at, model.order)
        part = data[at - before : at + piece]
        whole = code_lengths(model, part, np.array([0, len(part)]))[0]
        out += whole - code_lengths(model, part[:before], np.array([0, before]))[0]
    return out


def has_letter(text: str | Column) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}") if isinstance(text, str) else text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score; a text's own bytes are all that counts."""
    if model is None:
        names = {f.name.lower() for f in FIELDS}
        rest = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in names])
        return rest.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    known = docs.sparkSession.sparkContext.broadcast(model)
    (mark,) = free_names([*docs.columns, *FIELDS.names], "lettered")
    lettered = docs.withColumn(mark, has_letter(text))
    place = [c for c in lettered.columns if c.lower() not in FIELDS.names]
    text_at, letter_at = column_at(place, text), place.index(mark)

    def compute(batch: pa.RecordBatch) -> list:
        model = known.value
        names = np.array(model.languages, object)
        data, offsets = text_bytes(batch.column(text_at))
        lengths = []
        for lo, hi in groups(offsets, GROUP_BYTES):
            part = data[offsets[lo] : offsets[hi]]
            if len(part) > GROUP_BYTES:
                lengths.append(long_code_lengths(model, part, GROUP_BYTES)[None])
            else:
                lengths.append(code_lengths(model, part, offsets[lo : hi + 1] - offsets[lo]))
        units = np.concatenate(lengths)
        best = units.argmin(axis=1)
        gap = (units - units.min(axis=1, keepdims=True)) / UNIT
        score = 1 / np.exp2(-np.minimum(gap, 1000)).sum(axis=1)
        lettered = batch.column(letter_at).to_numpy(zero_copy_only=False)
        return [np.where(lettered, names[best], UNKNOWN).tolist(), np.where(lettered, score, 0.0)]

    return append_columns(lettered, FIELDS, compute).drop(mark)


def held_out(id_: str = "doc_id", folds: int = 5, fold: int = 0) -> Column:
    """Rows that training never sees; also those without an id."""
    return F.coalesce(F.crc32(F.col(id_).cast("string")) % folds == fold, F.lit(True))


def identify(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with lang_pred and score, learned from its own labelled rows that aren't held out."""
    labelled = docs.where(~held_out()).select(
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("doc_id").cast("string"), "text").alias("draw"),
    )
    return predict(docs, train(labelled, **options))


def keep_identified(docs: DataFrame, **options) -> DataFrame:
    """The documents in a learned language, with their own columns."""
    rows, names = set_aside(docs, FIELDS.names)
    found = identify(rows, **options).where(F.col("lang_pred") != UNKNOWN)
    return found.select(*[F.col(f"`{name}`").alias(c) for name, c in zip(names, docs.columns)])
