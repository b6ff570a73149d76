"""Words of many texts at once: where they are, and a 64-bit hash of each."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# A fixed odd multiplier and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
PIECE = 1 << 18

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, at least ``n`` of them."""
    if not _powers or len(_powers[0][0]) < n:
        up, down = np.full(n, BASE, np.uint64), np.full(n, INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers[0] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _powers[0]


@dataclass
class Words:
    """Words in order; ``rows`` has the first word of each text, and the end."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    hashes: np.ndarray

    def spelled(self, lo: int, hi: int) -> list[bytes]:
        """The bytes of words ``lo`` to ``hi``."""
        return [self.data[s:e].tobytes() for s, e in zip(self.starts[lo:hi], self.ends[lo:hi])]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each range; equal ranges have equal hashes.

    Ranges are ascending and don't overlap.  Sums of byte times power are taken
    once over pieces of the data, and a range is the difference of two, shifted
    back to power 0.
    """
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = int(np.searchsorted(ends, base + PIECE, side="right"))
        last = max(last, first + 1)
        stop = int(ends[last - 1])
        up, down = _tables(max(stop - base, PIECE))
        sums = np.zeros(stop - base + 1, np.uint64)
        np.cumsum((data[base:stop].astype(np.uint64) + np.uint64(1)) * up[: stop - base], out=sums[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = (sums[e] - sums[s]) * down[s]
        first = last
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def word_ranges(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of member bytes; no run crosses a text's end."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = member[data]
    change = inside[1:] != inside[:-1]
    at = np.flatnonzero(change)
    starts, ends = at[0::2], at[1::2]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    if len(inner):
        split = np.unique(inner[inside[inner] & inside[inner + 1]])  # a run goes on across this end
        if len(split):
            starts, ends = np.sort(np.concatenate([starts, split])), np.sort(np.concatenate([ends, split]))
    return starts, ends


def word_table(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> Words:
    """All words of the texts between ``offsets``, with their hashes."""
    starts, ends = word_ranges(data, offsets, member)
    rows = np.searchsorted(starts, offsets)
    return Words(data, starts, ends, rows, range_hashes(data, starts, ends))
