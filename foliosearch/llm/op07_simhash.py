"""SimHash near-duplicates by a self-join of binary tries.

A fingerprint has a bit set where over half of the XXH64 values of the text's
shingles have it.  Texts are near when their fingerprints differ in few bits.

The distinct fingerprints are the leaves of a binary trie.  Its self-join
walks down pairs of nodes together, adds a differing bit where the two
branches differ, and drops a pair once the bits exceed the budget.  To deal it
over a cluster, the 64 bits are cut into ``budget + 2`` blocks: two
fingerprints within the budget agree on at least two blocks, so a trie for
each pair of blocks, with those blocks first, finds every link below one of
the nodes at which its first two blocks end, where nothing of the budget is
spent.  Each such node is one group of rows; a task walks many groups at once
in flat arrays.  A group of more than ``group_rows`` fingerprints is dealt
into parts, and pairs of parts are walked apart, so no task holds more than
two parts of it.

Equal texts meet before the join, as one fingerprint.  Node pairs whose leaves
are all connected already are dropped, and a group gives one link for
each fingerprint that it connects, not one for each pair; a large group of
near copies costs little more than its size.  Components of the links are
found over the whole table (``components``).

Defined cases: a text without words (null, empty, only spaces) has
fingerprint zero and is linked like any other; a text of fewer words than a
shingle is one shingle; repeated rows have equal fingerprints and component;
a row without doc_id has the component of the rows with its fingerprint, null
if none of them has a doc_id; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliosearch.llm.batches import free_names, groups, text_bytes
from foliosearch.llm.components import component_labels, local_labels
from foliosearch.session import discard, scratch_path

SEED = 42
SHINGLE = 4
BUDGET = 4
GROUP_ROWS = 2_000_000
WALK_PAIRS = 200_000
CHUNK_ROWS = 100_000


# -- fingerprints ---------------------------------------------------------


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of each shingle of a text, repeats included."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(ends) - size]] if len(ends) > size else [0]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[size - 1 :] or ends[-1:])]


def majority_bits(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of each range of hashes, the bits that over half of them have; zero for none."""
    out = np.zeros(len(offsets) - 1, np.uint64)
    counts = np.diff(offsets)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        sums = np.add.reduceat(bits, offsets[some], axis=0, dtype=np.int64)
        major = 2 * sums > counts[some, None]
        out[some] = np.packbits(major, axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, text: str = "text", id_: str = "doc_id", size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a long with the same 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            raw = data.tobytes()
            found = []
            for lo, hi in groups(offsets, 1 << 20):
                hashes: list[int] = []
                ends = [0]
                for k in range(lo, hi):
                    hashes += shingle_hashes(raw[offsets[k] : offsets[k + 1]], size)
                    ends.append(len(hashes))
                found.append(majority_bits(np.array(hashes, np.uint64), np.array(ends)))
            fp = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_).cast("long").alias("doc_id"), F.col(text).cast("string"))
    return rows.mapInArrow(run, "doc_id long, fp long")


# -- the walk -------------------------------------------------------------


def _near_in_order(fp: np.ndarray, group: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between neighbours in the orders of four rotations of the bits."""
    a, b = [], []
    for turn in (0, 16, 32, 48):
        turned = (fp << np.uint64(turn)) | (fp >> np.uint64(64 - turn)) if turn else fp
        order = np.lexsort((turned, group))
        x, y = order[:-1], order[1:]
        near = (group[x] == group[y]) & (np.bitwise_count(fp[x] ^ fp[y]) <= budget)
        a.append(x[near])
        b.append(y[near])
    return np.concatenate(a), np.concatenate(b)


def walk(fp: np.ndarray, group: np.ndarray, budget: int) -> np.ndarray:
    """For each fingerprint, the first row that links connect it to in its group.

    Rows are sorted by group and then by fingerprint (unsigned), and distinct.
    """
    n = len(fp)
    labels = local_labels(n, *_near_in_order(fp, group, budget))
    ones: dict[int, np.ndarray] = {}  # of the depth at hand: how many fingerprints before each have the bit
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    lo, hi = edge, np.append(edge[1:], n)
    many = hi - lo > 1
    zero = np.zeros(int(many.sum()), np.int64)
    # Node pairs (a_lo, a_hi, b_lo, b_hi, bits that differ), by depth, deepest last.
    stack = [(0, np.stack([lo[many], hi[many], lo[many], hi[many], zero]))]
    while stack:
        depth, pairs = stack.pop()
        if pairs.shape[1] > WALK_PAIRS:
            stack += [(depth, pairs[:, WALK_PAIRS:]), (depth, pairs[:, :WALK_PAIRS])]
            continue
        changes = np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])]) if n else labels
        while pairs.shape[1]:
            al, ah, bl, bh, bits = pairs
            # All leaves below both are connected already.
            known = (changes[al] == changes[ah - 1]) & (changes[bl] == changes[bh - 1]) & (labels[al] == labels[bl])
            leaves = (ah - al == 1) & (bh - bl == 1)
            if (last := leaves & ~known).any():
                x, y = al[last], bl[last]
                near = np.bitwise_count(fp[x] ^ fp[y]) <= budget
                if near.any():
                    labels = local_labels(n, x[near], y[near], labels)
                    changes = np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])])
            pairs = pairs[:, ~(known | leaves)]
            if not pairs.shape[1]:
                break
            if pairs.shape[1] > WALK_PAIRS:
                stack.append((depth, pairs))
                break
            al, ah, bl, bh, bits = pairs
            if depth not in ones:
                ones.clear()
                ones[depth] = np.concatenate([[0], np.cumsum((fp >> np.uint64(63 - depth)) & np.uint64(1), dtype=np.int64)])
            seen = ones[depth]
            am, bm = ah - (seen[ah] - seen[al]), bh - (seen[bh] - seen[bl])
            same = al == bl  # a node with itself: its second crossing is the first one mirrored
            pairs = np.concatenate(
                [
                    np.stack([al, am, bl, bm, bits]),
                    np.stack([am, ah, bm, bh, bits]),
                    np.stack([al, am, bm, bh, bits + 1]),
                    np.stack([am, ah, bl, bm, bits + 1])[:, ~same],
                ],
                axis=1,
            )
            pairs = pairs[:, (pairs[0] < pairs[1]) & (pairs[2] < pairs[3]) & (pairs[4] <= budget)]
            depth += 1
    return labels


def _links(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Links within the groups of rows sorted by group: (fp, representative) by group."""

    def done(part: list[np.ndarray]) -> pa.RecordBatch:
        key, sub, fp, rep = part
        order = np.lexsort((fp.view(np.uint64), sub, key))
        key, sub, fp, rep = key[order], sub[order], fp[order].view(np.uint64), rep[order]
        change = np.concatenate([[True], (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])])
        size = np.diff(np.append(np.flatnonzero(change), len(key)))
        group = np.cumsum(change) - 1
        some = size[group] > 1
        group, fp, rep = group[some], fp[some], rep[some]
        root = walk(fp, group, budget)
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(rep[root[linked]]), pa.array(rep[linked])], names=["a", "b"])

    held: list[list[np.ndarray]] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        rows += batch.num_rows
        if rows < CHUNK_ROWS:
            continue
        part = [np.concatenate(x) for x in zip(*held)]
        inner = np.flatnonzero((part[0] != part[0][-1]) | (part[1] != part[1][-1]))
        cut = int(inner[-1]) + 1 if len(inner) else 0  # the last group may go on
        if cut:
            yield done([x[:cut] for x in part])
        held, rows = [[x[cut:] for x in part]], len(part[0]) - cut
    if rows:
        yield done([np.concatenate(x) for x in zip(*held)])


def _block_keys(fp: Column, budget: int) -> Column:
    """An array of longs: for each pair of blocks, its number and the bits of both."""
    blocks = budget + 2
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    part = [
        F.shiftrightunsigned(fp, 64 - e).bitwiseAND((1 << (e - s)) - 1) for s, e in zip(edges[:-1], edges[1:])
    ]
    keys = []
    for number, (i, j) in enumerate(combinations(range(blocks), 2)):
        width = edges[j + 1] - edges[j]
        both = F.shiftleft(part[i], width).bitwiseOR(part[j])
        keys.append(both.bitwiseOR(F.lit(number << 44)))
    return F.array(*keys)


def near_links(classes: DataFrame, budget: int = BUDGET, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b): links that connect representatives whose fingerprints are near.

    ``classes`` has one row (fp, rep) for each distinct fingerprint.  The links
    connect whatever all near pairs connect.  The budget is 1 to 8 bits.
    """
    keyed = classes.select(F.explode(_block_keys(F.col("fp"), budget)).alias("key"), "fp", "rep")
    large = [tuple(r) for r in keyed.groupBy("key").count().where(F.col("count") > group_rows).collect()]  # few: rows / group_rows
    sub = F.array(F.lit(0).cast("long"))
    if large:
        parts = F.create_map(*[F.lit(x) for key, count in large for x in (key, -(-2 * count // group_rows))])[F.col("key")]
        own = F.pmod(F.xxhash64("fp"), parts)
        others = F.transform(
            F.sequence(F.lit(0).cast("long"), parts - 1), lambda k: F.least(k, own) * parts + F.greatest(k, own)
        )
        sub = F.when(parts.isNotNull(), others).otherwise(sub)
    dealt = keyed.select("key", F.explode(sub).alias("sub"), "fp", "rep")
    return (
        dealt.repartition("key", "sub")
        .sortWithinPartitions("key", "sub")
        .mapInArrow(lambda batches: _links(batches, budget), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    id_: str = "doc_id",
    size: int = SHINGLE,
    budget: int = BUDGET,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``component_id`` is the least doc_id that links reach.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "fingerprints")
    fingerprints(docs, text, id_, size).write.parquet(path)
    found = spark.read.parquet(path)

    classes_path = scratch_path(spark, "classes")
    found.groupBy("fp").agg(F.min("doc_id").alias("rep")).where("rep is not null").write.parquet(classes_path)
    classes = spark.read.parquet(classes_path)

    links_path = scratch_path(spark, "near-links")
    near_links(classes, budget, group_rows).write.parquet(links_path)
    labels = component_labels(spark.read.parquet(links_path))

    named = classes.join(labels, F.col("rep") == F.col("node"), "left").select(
        F.col("fp").alias("known"), F.coalesce("label", "rep").alias("component_id")
    )
    named_path = scratch_path(spark, "components")
    named.write.parquet(named_path)
    for used in (classes_path, links_path):
        discard(spark, used)
    return found.join(spark.read.parquet(named_path), F.col("fp") == F.col("known"), "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_: str = "doc_id", **options) -> DataFrame:
    """One row for each component: that of its least doc_id, with all columns.

    Rows without a doc_id can't be told apart and stay as they are.
    """
    found = near_duplicates(docs, id_=id_, **options)
    (least,) = free_names(docs.columns, "least")
    stays = found.where("doc_id = component_id").select(F.col("doc_id").alias(least)).distinct()
    kept = docs.join(stays, F.col(id_).cast("long") == F.col(least), "left_semi").dropDuplicates([id_])
    return kept.unionByName(docs.where(F.col(id_).isNull()))
