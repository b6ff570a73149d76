"""Periodic runs of words, found in a Re-Pair grammar of each text.

A run is a stretch of words with least period q (words q apart are equal), of
``least`` words and twice its period at least, that no neighbouring word extends
with the same period.

The words of many texts are numbered together and compressed by Re-Pair in
rounds: a pair of neighbouring symbols that its text holds more than once
becomes a nonterminal.  A round replaces every pair that is more frequent than
the pairs it overlaps, so the order is that of the most frequent pair
wherever two compete.  When no pair comes twice, the start rule is cut into pairs
of neighbours until one symbol is left, so every stretch of two words or more has
a lowest symbol that holds it, and crosses the boundary of its two parts.

Runs that cross a symbol's boundary are worked out once, in one place of it: such
a run repeats the words at the boundary one period before or after, so periods
are the distances to equal word sequences within the symbol, and the run reaches
as far as they go on to be equal.  The sequences compared grow with the period,
and have exact numbers (by doubling), so nothing rests on a hash.  Runs are then
moved to all places at which the derivation has the symbol, and those that are
parts of one run are merged.

Nothing is shuffled.  A task holds the words of one group of texts of
``GROUP_BYTES``, or of one longer text.

Defined cases: a null text, an empty one and one without words have no runs and
the collapsed text ''; repeated rows have equal results; other columns are kept,
except those named like a new column, which it replaces; an empty table gives
an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from foliosearch.llm.batches import append_columns, column_at, groups, text_bytes
from foliosearch.llm.wordhash import word_ranges

LEAST = 12
GROUP_BYTES = 1 << 20
CANDIDATES = 1 << 20

IN_WORD = np.ones(256, bool)
IN_WORD[[0x20, *range(0x09, 0x0E)]] = False

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("collapsed", T.StringType()),
    ]
)


def spread(lo: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers of all ranges that start at ``lo``, one after another."""
    total = np.cumsum(count)
    return np.repeat(lo - total + count, count) + np.arange(int(total[-1]) if len(total) else 0)


# -- words and their repeats ----------------------------------------------


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words, by their bytes."""
    member = IN_WORD[data]
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data[member])])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def repeat_names(words: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
    """For k = 0, 1, … a number of the 2^k words that start at each place.

    Numbers are equal where the words and their text are; -1 where the text has
    the words only once, or ends before.  The last list has no number.
    """
    n = len(words)
    place, key = np.arange(n), row * (int(words.max(initial=0)) + 1) + words
    out = []
    while True:
        name, _ = pd.factorize(key)
        often = np.bincount(name)[name] > 1 if len(name) else np.empty(0, bool)
        place, name = place[often], name[often]
        full = np.full(n, -1, np.int64)
        full[place] = name
        out.append(full)
        if not len(place):
            return out
        step = 1 << (len(out) - 1)
        inside = place + step < n
        inside[inside] = (row[place[inside]] == row[place[inside] + step]) & (full[place[inside] + step] >= 0)
        place, name = place[inside], name[inside]
        key = name * n + full[place + step]


# -- the grammar ----------------------------------------------------------


class Symbols:
    """Pairs that became symbols: start, boundary and end of a place of each, and all its places.

    ``places[which[k] : which[k + 1]]`` are the starts of symbol ``k``.
    """

    def __init__(self, parts: list[tuple[np.ndarray, ...]], least: int) -> None:
        """Parts are (symbol, start, boundary, end), one row for each place."""
        symbol, start, boundary, end = (np.concatenate(x) for x in zip(*parts)) if parts else [np.empty(0, np.int64)] * 4
        long = end - start >= least  # no run fits into a shorter one
        symbol, start, boundary, end = symbol[long], start[long], boundary[long], end[long]
        order = np.lexsort((start, symbol))
        symbol, self.places = symbol[order], start[order]
        first = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]])[: len(symbol)])
        self.which = np.append(first, len(symbol))
        self.start, self.boundary, self.end = (x[order][first] for x in (start, boundary, end))


def compress(words: np.ndarray, row: np.ndarray, rows: np.ndarray, least: int) -> Symbols:
    """Re-Pair over all texts at once; ``words`` has -1 for words that come once in their text."""
    symbol, place, text = words.copy(), np.arange(len(words)), row
    stop = rows[row + 1] if len(row) else row  # where a word's text ends
    starts_symbol = np.ones(len(words) + 1, bool)
    next_symbol, parts = int(words.max(initial=0)) + 1, []
    while len(symbol):
        at = np.flatnonzero((symbol[:-1] >= 0) & (symbol[1:] >= 0) & (text[:-1] == text[1:]))
        pair, _ = pd.factorize(symbol[at] * next_symbol + symbol[at + 1])
        count = np.bincount(pair) if len(pair) else np.empty(0, np.int64)
        twice = count[pair] > 1
        at, pair = at[twice], pair[twice]
        if not len(at):
            break
        rank = np.empty(len(count), np.int64)
        tie = np.arange(len(count)) * 0x9E3779B1 % (1 << 32)  # not in order of place: neighbours would wait for each other
        rank[np.lexsort((tie, count))] = np.arange(1, len(count) + 1)
        here = np.zeros(len(symbol) + 1, np.int64)
        here[at] = rank[pair]
        won = (here[at] >= here[at - 1]) & (here[at] >= here[at + 1])  # the spare last place is the one before the first
        at, pair = at[won], pair[won]
        # Overlapping pairs of one kind (a run of one symbol): from the left, each second.
        run = np.concatenate([[True], at[1:] != at[:-1] + 1])
        first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        even = (np.arange(len(at)) - first) % 2 == 0
        at, pair = at[even], pair[even]
        middle = place[at + 1]
        after = np.append(place, 0)[at + 2 - (at + 2 > len(place))]
        end = np.where((at + 2 < len(place)) & (np.append(text, -1)[np.minimum(at + 2, len(text))] == text[at]), after, stop[place[at]])
        parts.append((pair + next_symbol, place[at], middle, end))
        symbol[at] = np.where(np.bincount(pair)[pair] > 1, pair + next_symbol, -1)
        next_symbol += len(count)
        starts_symbol[middle] = False
        left = np.ones(len(symbol), bool)
        left[at + 1] = False
        moving = np.zeros(int(text[-1]) + 1, bool)
        moving[text[at]] = True  # a text that has a repeated pair had one replaced
        left &= moving[text]
        symbol, place, text = symbol[left], place[left], text[left]
    # The start rules: neighbours are paired until each text is one symbol.
    place = np.flatnonzero(starts_symbol[:-1])
    while len(place):
        text = row[place]
        first = np.concatenate([[True], text[1:] != text[:-1]])
        number = np.arange(len(place)) - np.maximum.accumulate(np.where(first, np.arange(len(place)), 0))
        second = number % 2 == 1
        if not second.any():
            break
        at = np.flatnonzero(second)
        far = np.append(place, len(words))[at + 1]
        end = np.minimum(far, stop[place[at]])
        parts.append((next_symbol + np.arange(len(at)), place[at - 1], place[at], end))
        next_symbol += len(at)
        place = place[~second]
    return Symbols(parts, least)


# -- runs -----------------------------------------------------------------


def _reach(names: list[np.ndarray], x: np.ndarray, y: np.ndarray, room: np.ndarray, back: bool) -> np.ndarray:
    """How many words from ``x`` on equal those from ``y`` on (before them, if ``back``), ``room`` at most."""
    n, got = len(names[0]), np.zeros(len(x), np.int64)
    for k in range(len(names) - 1, -1, -1):
        step = 1 << k
        at, other = (x - got - step, y - got - step) if back else (x + got, y + got)
        fits = np.flatnonzero(got + step <= room)
        a = names[k][np.clip(at[fits], 0, n - 1)]
        same = (a >= 0) & (a == names[k][np.clip(other[fits], 0, n - 1)])
        got[fits[same]] += step
    return got


def _near_repeats(
    name: np.ndarray, sorted_places: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(which of ``at``, place) for the places from ``low`` to ``high`` with the name of ``at``."""
    n = len(name)
    base = name[at] * n
    lo, hi = np.searchsorted(sorted_places, base + low), np.searchsorted(sorted_places, base + high, side="right")
    count = np.maximum(hi - lo, 0)
    return np.repeat(np.arange(len(at)), count), sorted_places[spread(lo, count)] % n


def crossing_runs(names: list[np.ndarray], symbols: Symbols, least: int) -> tuple[np.ndarray, ...]:
    """(symbol, start, end, period) of the runs that cross a symbol's boundary, in its first place."""
    start, boundary, end = symbols.start, symbols.boundary, symbols.end
    # A run of period q has max(q, least - q) places or more in a row that equal
    # the one q further on, one of them next to the boundary.  With 2g - 2 such
    # places, g of them begin or end there.
    base = 0
    while 2 * (2 << base) - 2 <= -(-least // 2):
        base += 1
    out = []
    open_ = np.ones(len(start), bool)
    for k in range(base, len(names)):
        size = 1 << k
        least_q, most_q = (1 if k == base else 2 * size), 4 * size - 1
        name = names[k]
        alive = np.flatnonzero(name >= 0)
        if not len(alive):
            break
        sorted_places = np.sort(name[alive] * len(name) + alive)
        wide = np.flatnonzero(open_ & (end - start >= 2 * least_q))
        asked = [np.empty((3, 0), np.int64)]
        for anchor, ahead in ((boundary, False), (boundary - size + 1, False), (boundary - 1, True), (boundary - size, True)):
            at = anchor[wide]
            here = (at >= start[wide]) & (at + size <= end[wide])
            here[here] = name[at[here]] >= 0
            which, at = wide[here], at[here]
            if ahead:
                low, high = at + least_q, np.minimum(at + most_q, end[which] - size)
            else:
                low, high = np.maximum(start[which], at - most_q), at - least_q
            for lo in range(0, len(at), CANDIDATES // (most_q + 1) + 1):
                part = slice(lo, lo + CANDIDATES // (most_q + 1) + 1)
                mine, place = _near_repeats(name, sorted_places, at[part], low[part], high[part])
                node, q = which[part][mine], np.abs(place - at[part][mine])
                fits = 2 * q <= end[node] - start[node]
                asked.append(np.stack([node[fits], q[fits], np.full(int(fits.sum()), int(ahead))]))
        node, q, ahead = np.concatenate(asked, axis=1)
        key = np.unique((node * (most_q + 1) + q) * 2 + ahead)
        for lo in range(0, len(key), CANDIDATES):
            part = key[lo : lo + CANDIDATES]
            node, q, ahead = part // 2 // (most_q + 1), part // 2 % (most_q + 1), part % 2
            x = boundary[node] - np.where(ahead == 1, 1, q)
            on = _reach(names, x, x + q, end[node] - x - q, back=False)
            before = _reach(names, x, x + q, x - start[node], back=True)
            length = before + on + q
            good = (on > 0) & (length >= np.maximum(least, 2 * q))
            node, first, length, q = node[good], (x - before)[good], length[good], q[good]
            out.append((node, first, first + length, q))
            open_[node[length == (end - start)[node]]] = False  # longer periods of a periodic symbol are multiples
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 4


def merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Maximal runs, ordered by start and period, from parts of them.

    Parts of one run have its period and overlap by that at least.  A stretch
    that comes with several periods has the least.
    """
    if not len(start):
        return start, end, period
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    group = np.cumsum(np.concatenate([[0], period[1:] != period[:-1]]))
    wall = int(end.max()) + 1
    reached = np.maximum.accumulate(group * wall + end)
    fresh = np.concatenate([[True], (group * wall + start + period)[1:] > reached[:-1]])
    first = np.flatnonzero(fresh)
    start, period, end = start[first], period[first], reached[np.append(first[1:], len(start)) - 1] - group[first] * wall
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    least = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])])
    start, end, period = start[least], end[least], period[least]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def runs_of(words: np.ndarray, rows: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """(start, end, period) of the runs of texts, whose words are those between ``rows``."""
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    names = repeat_names(words, row)
    symbols = compress(names[0], row, rows, least)
    symbol, start, end, period = crossing_runs(names, symbols, least)
    count = symbols.which[symbol + 1] - symbols.which[symbol]
    moved = symbols.places[spread(symbols.which[symbol], count)] - np.repeat(symbols.start[symbol], count)
    return merged(*(np.repeat(x, count) + y for x, y in ((start, moved), (end, moved), (period, 0))))


# -- texts ----------------------------------------------------------------


def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    number = np.flatnonzero(kept)
    size = ends[number] - starts[number] + 1
    raw = np.append(data, np.uint8(0x20))
    source = spread(starts[number], size)
    total = np.concatenate([[0], np.cumsum(size)])
    source[total[1:] - 1] = len(data)  # a space after each word
    cut = total[np.searchsorted(number, rows)]
    some = np.diff(cut) > 0
    drop = np.ones(len(source), bool)
    drop[cut[1:][some] - 1] = False  # but not after a text's last
    offsets = cut - np.concatenate([[0], np.cumsum(some)])
    return pa.Array.from_buffers(pa.large_string(), len(rows) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw[source[drop]])])


def _group(data: np.ndarray, offsets: np.ndarray, least: int) -> list[pa.Array]:
    starts, ends = word_ranges(data, offsets, IN_WORD)
    rows = np.searchsorted(starts, offsets)
    start, end, period = runs_of(word_numbers(data, starts, ends), rows, least)
    gone = np.zeros(len(starts) + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, end, -1)
    row = np.searchsorted(rows, start, side="right") - 1
    at = np.searchsorted(start, rows)
    runs = pa.StructArray.from_arrays([pa.array(x) for x in (start - rows[row], end - start, period)], names=RUN.names)
    return [
        pa.array(np.diff(rows)),
        pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), runs),
        _texts(data, starts, ends, rows, np.cumsum(gone[:-1]) == 0).cast(pa.string()),
    ]


def find_runs(docs: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` with the number of words, the runs by start and period, and the collapsed text.

    ``runs`` has (start, length, period) of each, in words from 0.  ``collapsed``
    is the words without those that a run holds after its first period, joined by
    one space.
    """
    at = column_at([c for c in docs.columns if c.lower() not in FIELDS.names], text)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        data, offsets = text_bytes(batch.column(at).cast(pa.large_string()))
        parts = [
            _group(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], least) for lo, hi in groups(offsets, GROUP_BYTES)
        ]
        return [pa.concat_arrays(x) for x in zip(*parts)]

    return append_columns(docs, FIELDS, compute)
