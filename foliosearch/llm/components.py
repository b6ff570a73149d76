"""Connected components of a table of links, by labels that shrink to the minimum."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliosearch.session import discard, scratch_path


def _written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def component_labels(links: DataFrame) -> DataFrame:
    """(node, label) for every node in ``links`` (a, b): the least node it reaches.

    Each round takes the least label among a node's neighbours and then the
    label of that label, so the number of rounds follows the logarithm of a
    component's width.  Each round is a written table: no lineage grows, and a
    lost executor costs one round at most.  All joins meet both sides by
    a shuffle, so that a node with very many links is split at run time.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both, both_path = _written(both, "links")
    labels, old_path = _written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("node") == F.col("a"), "left").select(
            "node", F.col("label").alias("before"), F.least("label", "near").alias("label")
        )
        step, step_path = _written(step, "labels")
        roots = step.select(F.col("node").alias("root"), F.col("label").alias("beyond"))
        jumped = step.join(roots, F.col("label") == F.col("root"), "left").select(
            "node", F.least("label", "beyond").alias("label"), "before"
        )
        jumped, new_path = _written(jumped, "labels")
        changed = not jumped.where(F.col("label") != F.col("before")).isEmpty()
        for path in (old_path, step_path):
            discard(jumped.sparkSession, path)
        labels, old_path = jumped.select("node", "label"), new_path
        if not changed:
            discard(jumped.sparkSession, both_path)
            return labels


def local_labels(n: int, a: np.ndarray, b: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """The same for nodes 0 to n-1 in memory; ``labels`` may hold earlier links."""
    labels = np.arange(n) if labels is None else labels.copy()
    while True:
        x, y = labels[a], labels[b]
        differ = x != y
        if not differ.any():
            return labels
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(nxt := labels[labels], labels):
            labels = nxt
