"""Byte contexts of texts as flat arrays: counting them, and finding them in a trie.

A gram of ``order`` + 1 bytes is a number whose low byte is the symbol, the next
the byte before it, and so on; bytes before a text's start are ``pad``.
"""

from __future__ import annotations

import numpy as np


def gram_keys(data: np.ndarray, offsets: np.ndarray, order: int, pad: int) -> np.ndarray:
    """The gram of every byte."""
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    keys = data.astype(np.int64)
    for back in range(1, order + 1):
        before = np.full(len(data), pad, np.int64)
        before[back:] = data[: len(data) - back]
        before[place < back] = pad
        keys |= before << (8 * back)
    return keys


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts by key, added over parts of (keys, counts)."""
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, where, np.concatenate([n for _, n in parts]))
    return keys, counts


def longest_contexts(child: np.ndarray, classes: int, symbols: np.ndarray, offsets: np.ndarray, order: int, pad: int) -> np.ndarray:
    """For every symbol, the trie's node of the longest known context before it, times ``classes``.

    ``child`` is nodes x classes, flat: the node of the context one symbol
    longer, or -1.  ``pad`` is the class of the bytes before a start.
    """
    place = np.arange(len(symbols), dtype=np.int32) - np.repeat(offsets[:-1].astype(np.int32), np.diff(offsets))
    near_start = [np.flatnonzero(place < back) for back in range(1, order + 1)]
    symbols, base = symbols.astype(np.int32), np.zeros(len(symbols), np.int32)
    live = None  # all
    for back in range(1, order + 1):
        before = np.empty_like(symbols)
        before[back:] = symbols[:-back] if back < len(symbols) else 0
        before[near_start[back - 1]] = pad
        if live is None:
            deeper = child.take(base + before)
            live = np.flatnonzero(deeper >= 0)
        else:
            deeper = child.take(base.take(live) + before.take(live))
            on = deeper >= 0
            live, deeper = live[on], deeper[on]
        base[live] = (deeper[deeper >= 0] if back == 1 else deeper) * classes
    return base


def node_sums(cost: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of integer costs over the ranges between offsets."""
    total = np.zeros(len(cost) + 1, np.int64)
    np.cumsum(cost, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
