"""Hard negatives by inner product, pruned by coordinates as LEMP does.

Vectors become integers, floor(scale x component), so scores are exact.  They are
ordered by label, falling length and id, and cut into blocks of neighbours by
ranges; in a block, the vectors of a label make length buckets of ``BUCKET_ROWS``,
each with every coordinate of its normalised vectors as a sorted list.

An anchor asks a bucket for scores of at least t.  With its own and the bucket's
greatest length, t bounds the cosine from below.  If the bound is over 1, the
whole bucket is passed over.  Otherwise, in each of the anchor's ``FOCUS`` largest
coordinates only vectors within one range of values can reach it: cosines are
angles there, and the two angles may differ by that of the bound at most.  The
ranges are looked up in the sorted lists, their candidates intersected,
beginning with the shortest range, and only these are scored, exactly.

First, anchors meet the blocks that hold their label, and t is the last of the
best positives so far.  Then, with the scores of their positives, they meet all
blocks; t is the least score that may still be a negative of one of the
positives: the lower end of its range, or its last negative so far.  A block meets
anchors in parts, and each pair of block and part is a group of bounded size of a
shuffled join, so that no machine needs all anchors or all vectors.  Blocks give
at most the asked number for each anchor and positive; the best of all blocks are
ranked over small windows.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component, take no part.  Of rows with the same id, the one with the least
label and vector takes part, so repeated rows count once, and an anchor is never its
own positive.  Ties go by id.  Vectors of several lengths are compared as
if the shorter went on with zeros.  Components beyond 2^31 after scaling are
cut there, and scores beyond 2^63.  An anchor without a positive, and a positive
without a negative, have no row.  An empty table gives an empty table.
Columns other than the three named are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliosearch.session import scratch_path

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # percent of the positive's score

BUCKET_ROWS = 512
FOCUS = 4
SLACK = 1e-9  # on cosines, for rounding: candidates are checked exactly

# Only how work is dealt out: rows of a block at least, and how many blocks at most.
BLOCK_ROWS = 4096
MOST_BLOCKS = 4000
INT_MAX = 2**31 - 1
EXACT = 2.0**53


def sound_vectors(vectors: DataFrame, anchor: Column, id_: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, label, v, anchor): a row for each id that takes part."""
    value = F.col(vector)
    finite = ~F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col(id_).isNotNull() & F.col(label).isNotNull() & value.isNotNull()).where(finite)

    def whole(x: Column) -> Column:
        return F.least(F.greatest(F.floor(x.cast("double") * scale).cast("double"), F.lit(float(-INT_MAX))), F.lit(float(INT_MAX))).cast("int")

    own = F.struct(F.col(label).cast("long").alias("label"), F.transform(value, whole).alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    return rows.select(F.col(id_).cast("long").alias("id"), own.alias("own")).groupBy("id").agg(F.min("own").alias("own")).select("id", "own.*")


# -- one block ------------------------------------------------------------


def matrix(column: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Lists of numbers as rows, with zeros after the shorter ones."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))))
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, place] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class Bucket:
    """Vectors of one label and like lengths, with a sorted list of each coordinate."""

    def __init__(self, label: int, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.label, self.ids, self.vectors = label, ids, vectors
        length = np.sqrt((vectors * vectors).sum(axis=1))
        self.longest = float(length.max())
        unit = vectors / np.where(length > 0, length, 1)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(unit, self.order, axis=0).T)
        self.order = np.ascontiguousarray(self.order.T)
        self.rank = np.empty_like(self.order)
        np.put_along_axis(self.rank, self.order, np.arange(len(ids))[None, :], axis=1)

    def scores(self, rows: np.ndarray | slice, anchor: np.ndarray, length: float) -> np.ndarray:
        """Exact inner products, as integers."""
        if self.longest * length < EXACT:
            return (self.vectors[rows] @ anchor).astype(np.int64)
        exact = [sum(int(a) * int(b) for a, b in zip(v, anchor)) for v in self.vectors[rows]]
        return np.array([min(max(x, -(2**63)), 2**63 - 1) for x in exact], np.int64)


def buckets_of(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> list[Bucket]:
    length = (vectors * vectors).sum(axis=1)
    order = np.lexsort((ids, -length, labels))
    ids, labels, vectors = ids[order], labels[order], vectors[order]
    edges = [0, *(1 + np.flatnonzero(labels[1:] != labels[:-1])).tolist(), len(ids)]
    return [
        Bucket(int(labels[at]), ids[at : min(at + BUCKET_ROWS, hi)], vectors[at : min(at + BUCKET_ROWS, hi)])
        for lo, hi in zip(edges[:-1], edges[1:])
        for at in range(lo, hi, BUCKET_ROWS)
    ]


class Anchors:
    """The anchors that a block meets, with their lengths and focus coordinates."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.length = np.sqrt((vectors * vectors).sum(axis=1))
        unit = vectors / np.where(self.length > 0, self.length, 1)[:, None]
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        self.angle = np.arccos(np.clip(np.take_along_axis(unit, self.focus, axis=1), -1, 1))


def candidates(bucket: Bucket, anchors: Anchors, who: np.ndarray, least: np.ndarray) -> list[tuple[int, np.ndarray | slice]]:
    """(anchor, rows) of the bucket that may have a score of ``least`` with the anchors ``who``."""
    reach = anchors.length[who] * bucket.longest
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(reach > 0, least / reach, np.where(least > 0, np.inf, -np.inf)) - SLACK
    who, cosine = who[cosine <= 1], cosine[cosine <= 1]
    out: list[tuple[int, np.ndarray | slice]] = [(a, slice(None)) for a in who[cosine <= 0].tolist()]
    who, cosine = who[cosine > 0], cosine[cosine > 0]
    if not len(who):
        return out
    turn = np.arccos(cosine)[:, None]
    lowest = np.cos(np.minimum(anchors.angle[who] + turn, np.pi)) - SLACK
    highest = np.cos(np.maximum(anchors.angle[who] - turn, 0)) + SLACK
    focus = anchors.focus[who]
    lo, hi = np.empty(focus.shape, np.int64), np.empty(focus.shape, np.int64)
    for f in np.unique(focus).tolist():
        at = focus == f
        lo[at] = np.searchsorted(bucket.sorted[f], lowest[at])
        hi[at] = np.searchsorted(bucket.sorted[f], highest[at], side="right")
    size = hi - lo
    shortest = np.argsort(size, axis=1)
    for k in np.flatnonzero(size.min(axis=1) > 0).tolist():
        first, *others = shortest[k].tolist()
        rows = bucket.order[focus[k, first], lo[k, first] : hi[k, first]]
        for other in others:
            if size[k, other] == len(bucket.ids):
                break  # they come by size
            rank = bucket.rank[focus[k, other], rows]
            rows = rows[(rank >= lo[k, other]) & (rank < hi[k, other])]
        if len(rows):
            out.append((int(who[k]), rows))
    return out


def _best(scores: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:most]
    return scores[order], ids[order]


_NONE = (np.empty(0, np.int64), np.empty(0, np.int64))


def best_positives(buckets: list[Bucket], anchors: Anchors, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each anchor the best (scores, ids) of its label, itself left out."""
    best = [_NONE] * len(anchors.ids)
    least = np.full(len(anchors.ids), -np.inf)
    for bucket in buckets:
        who = np.flatnonzero(anchors.labels == bucket.label)
        for a, rows in candidates(bucket, anchors, who, least[who]):
            ids, scores = bucket.ids[rows], bucket.scores(rows, anchors.vectors[a], anchors.length[a])
            good = (ids != anchors.ids[a]) & (scores >= least[a])
            if good.any():
                best[a] = _best(np.concatenate([best[a][0], scores[good]]), np.concatenate([best[a][1], ids[good]]), most)
                if len(best[a][0]) == most:
                    least[a] = best[a][0][-1]
    return best


def best_negatives(
    buckets: list[Bucket], anchors: Anchors, ranges: list[list[tuple[int, int]]], most: int
) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """For each anchor and each of its ranges of scores, the best (scores, ids) of other labels within it."""
    best = [[_NONE] * len(r) for r in ranges]
    floor = [[low if low <= high else np.inf for low, high in r] for r in ranges]
    least = np.array([min(f, default=np.inf) for f in floor])
    for bucket in buckets:
        who = np.flatnonzero((anchors.labels != bucket.label) & (least < np.inf))
        for a, rows in candidates(bucket, anchors, who, least[who]):
            ids, scores = bucket.ids[rows], bucket.scores(rows, anchors.vectors[a], anchors.length[a])
            good = scores >= least[a]
            ids, scores = ids[good], scores[good]
            if not len(ids):
                continue
            for k, (_, high) in enumerate(ranges[a]):
                within = (scores >= floor[a][k]) & (scores <= high)
                if within.any():
                    held = best[a][k]
                    best[a][k] = _best(np.concatenate([held[0], scores[within]]), np.concatenate([held[1], ids[within]]), most)
                    if len(best[a][k][0]) == most:
                        floor[a][k] = best[a][k][0][-1]
            least[a] = min(floor[a])
    return best


# -- all blocks -----------------------------------------------------------


def _met(rows: DataFrame, anchors: DataFrame, parts: int, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Each block of rows with each part of the anchors that ``anchors`` deals to it."""
    part = F.pmod(F.xxhash64("id"), F.lit(parts))
    left = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    right = anchors.withColumn("part", part)
    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(work, schema)


def _ids(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy().astype(np.int64)


def _block(rows: pa.Table, anchors: pa.Table) -> tuple[list[Bucket], Anchors]:
    width = max(int(np.diff(x.offsets.to_numpy()).max(initial=0)) for t in (rows, anchors) for x in t["v"].chunks)
    buckets = buckets_of(_ids(rows, "id"), _ids(rows, "label"), matrix(rows["v"], width))
    return buckets, Anchors(_ids(anchors, "id"), _ids(anchors, "label"), matrix(anchors["v"], width))


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    id_: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` tells the anchors.  A negative has another label than its anchor and
    ``low`` to ``high`` percent of the positive's score, both included.
    """
    spark = vectors.sparkSession
    sound_path, blocks_path, positives_path = (scratch_path(spark, f"negatives-{k}") for k in ("sound", "blocks", "positives"))
    sound_vectors(vectors, anchor, id_, vector, label, scale).write.parquet(sound_path)
    sound = spark.read.parquet(sound_path)
    rows, asked = sound.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    block_rows = max(BLOCK_ROWS, -(-rows // MOST_BLOCKS))
    blocks, parts = max(1, -(-rows // block_rows)), max(1, -(-asked // (4 * block_rows)))
    length = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    sound.withColumn("length", length).repartitionByRange(blocks, "label", F.col("length").desc(), "id").drop("length").withColumn(
        "block", F.spark_partition_id()
    ).write.parquet(blocks_path)
    # Three reads, so that what is grouped together has columns of its own.
    dealt, anchors, members = (spark.read.parquet(blocks_path) for _ in range(3))
    anchors = anchors.where("anchor").select("id", "label", "v")
    members = members.select("block", "id", "label", "v")

    def positive_work(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = best_positives(*_block(rows, anchors), positives) if len(rows) and len(anchors) else []
        return pa.table(
            {
                "anchor_id": np.repeat(_ids(anchors, "id")[: len(found)], [len(s) for s, _ in found]),
                "positive_id": np.concatenate([_NONE[1], *(i for _, i in found)]),
                "positive_score": np.concatenate([_NONE[0], *(s for s, _ in found)]),
            }
        )

    def negative_work(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        columns = {name: [] for name in ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")}
        if len(rows) and len(anchors):
            given = anchors["positives"].to_pylist()
            ranges = [[(-(-low * p["score"] // 100), high * p["score"] // 100) for p in own] for own in given]
            found = best_negatives(*_block(rows, anchors), ranges, negatives)
            for anchor_id, own, best in zip(_ids(anchors, "id").tolist(), given, found):
                for p, (scores, ids) in zip(own, best):
                    columns["anchor_id"] += [anchor_id] * len(ids)
                    columns["positive_id"] += [p["id"]] * len(ids)
                    columns["positive_score"] += [p["score"]] * len(ids)
                    columns["negative_id"] += ids.tolist()
                    columns["negative_score"] += scores.tolist()
        return pa.table({name: pa.array(values, pa.int64()) for name, values in columns.items()})

    of_label = dealt.select("block", "label").distinct()
    own_blocks = anchors.join(of_label, "label").select("block", "id", "label", "v")
    found = _met(members, own_blocks, parts, positive_work, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
    given = F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))  # so many at most
    best.groupBy("anchor_id").agg(given.alias("positives")).write.parquet(positives_path)

    paired = anchors.join(spark.read.parquet(positives_path), F.col("id") == F.col("anchor_id")).drop("anchor_id")
    all_blocks = paired.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = _met(members, all_blocks, parts, negative_work, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
