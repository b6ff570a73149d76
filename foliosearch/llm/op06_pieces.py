"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

Text becomes symbols: a space is the mark U+2581, one mark goes before the
text, and every character is a symbol.  No piece of a supported model has the
mark after another character, so no merge crosses into a mark that follows
one, and the text falls into words there.  Each distinct word of a group of
texts is encoded once.

All words of a group are one flat array of symbol ids.  A round looks up the
piece that each pair of neighbours makes, takes the best rank in each word
(a segmented minimum), and merges the pairs of that rank from the left, where
they don't overlap; then it compacts the array.  Rounds end when no pair is
left.  Merging all pairs of a rank at once gives the library's result as long
as no new pair could rank before those that are left: pieces for which a longer
one ranks as high are known from the vocabulary, and of those only the
leftmost pair of a word is merged in a round.  A word of more than ``LONG`` symbols
is merged by itself: its places wait by rank, and a round touches only those of the
least rank and their neighbours, so a long word takes time by its merges.

Words are compared as they are spelled, not by a hash.

Characters without a piece become the pieces of their UTF-8 bytes.

Defined cases: a null text is empty; an empty text has the begin and end ids
only; repeated rows are encoded alike; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliosearch.llm.batches import groups, text_bytes

MARK = 0x2581
NO_RANK = np.int32(1 << 30)
GONE = np.iinfo(np.int32).min
GROUP_BYTES = 2 << 20
LONG = 512  # symbols of a word that is merged by itself


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, start, end) of the runs of equal values."""
    start = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[: len(values)])
    return values[start], start, np.append(start[1:], len(values))


def distinct_words(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For words that make up all ``points``: the number of each, and the first word of each number.

    Words are compared as they are spelled.
    """
    offsets = np.append(starts, len(points)) * 4
    wide = pa.py_buffer(points.astype(np.uint32))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), wide])
    which = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.empty(int(which.max(initial=-1)) + 1, np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]
    return which, first


class Pieces:
    """A vocabulary as flat tables.  It must be BPE with byte fallback, identity
    normalisation and a mark before the text; anything else is refused."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        special = [model.is_control(i) or model.is_unknown(i) for i in range(size)]
        byte = [model.is_byte(i) for i in range(size)]
        pieces = [model.id_to_piece(i) for i in range(size)]
        if model.normalize(" a  ﬁ\t") != "▁▁a▁▁ﬁ\t" or sum(byte) != 256:
            raise ValueError("only models with identity normalisation, a mark before the text and byte pieces are supported")
        plain = {p: i for i, p in enumerate(pieces) if not special[i] and not byte[i] and not model.is_unused(i)}
        if any(MARK in map(ord, p.lstrip(chr(MARK))) for p in plain):
            raise ValueError("a piece has the mark after another character")
        score = {i: model.get_score(i) for i in plain.values()}
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = np.full(size, NO_RANK, np.int32)
        for i, s in score.items():
            self.rank[i] = order[s]

        # Every way to make a piece of two; symbols without a piece never merge.
        left, right, made = [], [], []
        alone = np.zeros(size, bool)
        for p, i in plain.items():
            for cut in range(1, len(p)):
                a, b = plain.get(p[:cut]), plain.get(p[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(i)
                for part in (a, b):
                    if part is not None and self.rank[i] <= self.rank[part]:
                        alone[part] = True
        keys = np.array(left, np.uint64) << np.uint64(32) | np.array(right, np.uint64)
        self.alone = alone
        self.alone_rank = np.zeros(len(order), bool)
        self.alone_rank[self.rank[np.flatnonzero(alone)]] = True
        self._pair_table(keys, np.array(made, np.int32))

        # Characters: id of the piece, else -1 and the bytes' pieces later.
        single = {ord(p): i for p, i in plain.items() if len(p) == 1}
        self.char = np.full(max(single, default=0) + 2, -1, np.int32)
        for c, i in single.items():
            self.char[c] = i
        self.byte_id = np.zeros(256, np.int32)
        for i in np.flatnonzero(byte):
            self.byte_id[int(pieces[i][3:5], 16)] = i

        # Decoding: bytes of each piece, marks as spaces; a byte piece is its byte.
        surface = model.decode([self.unknown]) if self.unknown >= 0 else ""
        spelled = []
        for i, p in enumerate(pieces):
            if byte[i]:
                spelled.append(bytes([int(p[3:5], 16)]))
            elif special[i]:
                spelled.append(surface.encode() if i == self.unknown else b"")
            else:
                spelled.append(p.replace(chr(MARK), " ").encode())
        self.spell = np.frombuffer(b"".join(spelled) or b"\0", np.uint8)
        self.spell_at = np.cumsum([0] + [len(s) for s in spelled])
        self.is_byte = np.array(byte)
        self.is_control = np.array([model.is_control(i) for i in range(size)])
        self.starts_with_mark = np.array([p.startswith(chr(MARK)) and not b for p, b in zip(pieces, byte)])

    def _pair_table(self, keys: np.ndarray, made: np.ndarray) -> None:
        """Open addressing with a few probes: slot to key, slot to piece."""
        bits = 4
        while (1 << bits) < 4 * len(keys):
            bits += 1
        self.shift = np.uint64(64 - bits)
        self.key = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.made = np.full(1 << bits, -1, np.int32)
        slot = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        self.probes, left = 0, np.arange(len(keys))
        while len(left):
            at = (slot[left] + self.probes) & ((1 << bits) - 1)
            free = self.key[at] == np.uint64(0xFFFFFFFFFFFFFFFF)
            at, mine = at[free], left[free]
            first = np.unique(at, return_index=True)[1]
            self.key[at[first]], self.made[at[first]] = keys[mine[first]], made[mine[first]]
            left = np.setdiff1d(left, mine[first], assume_unique=True)
            self.probes += 1

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair of ids makes, or -1; negative ids make none."""
        keys = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        mask = len(self.key) - 1
        slot = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        out = np.where(self.key[slot] == keys, self.made[slot], np.int32(-1))
        open_ = np.flatnonzero((out < 0) & (self.key[slot] != np.uint64(0xFFFFFFFFFFFFFFFF)))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & mask
            there = self.key[slot[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.made[slot[open_[hit]]]
            open_ = open_[~hit & (there != np.uint64(0xFFFFFFFFFFFFFFFF))]
        out[(a < 0) | (b < 0)] = -1
        return out

    # -- merge rounds -----------------------------------------------------

    def merge_words(self, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All words merged to the end: the short ones together, each long one by itself."""
        sizes = np.diff(ends, prepend=0)
        long = sizes > LONG
        if not long.any():
            return self.merge(symbols, ends)
        merged, merged_ends = self.merge(symbols[np.repeat(~long, sizes)], np.cumsum(sizes[~long]))
        short = iter(np.split(merged, merged_ends[:-1]))
        parts = [self.merge_long(symbols[e - n : e]) if n > LONG else next(short) for e, n in zip(ends.tolist(), sizes.tolist())]
        return np.concatenate(parts), np.cumsum([len(x) for x in parts])

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """The same for one long word, in time by its merges.

        A round handles the places of the least rank there is, and looks up only
        the pairs around them; places are linked, and wait by rank.
        """
        symbols, n = symbols.copy(), len(symbols)
        after, before = np.arange(1, n + 2), np.arange(-1, n)  # place n is the end
        made = np.full(n + 1, -1, np.int32)
        made[: n - 1] = self.pair(symbols[:-1], symbols[1:])
        waiting: dict[int, list] = {}
        ranks: list[int] = []

        def put(at: np.ndarray) -> None:
            at = at[made[at] >= 0]
            rank = self.rank[made[at]]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            for r, lo, hi in zip(*(x.tolist() for x in _runs(rank))):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(ranks, r)
                if self.alone_rank[r]:  # place by place, from the left
                    for place in at[lo:hi].tolist():
                        heapq.heappush(waiting[r], place)
                else:
                    waiting[r].append(at[lo:hi])

        put(np.arange(n - 1))
        while ranks:
            r = ranks[0]
            if self.alone_rank[r]:
                at = np.empty(0, np.int64)
                while waiting[r] and not len(at):
                    place = heapq.heappop(waiting[r])
                    if made[place] >= 0 and self.rank[made[place]] == r:
                        at = np.array([place])
                if not waiting[r]:
                    heapq.heappop(ranks)
                    del waiting[r]
            else:
                heapq.heappop(ranks)
                at = np.unique(np.concatenate(waiting.pop(r)))
                at = at[made[at] >= 0]
                at = at[self.rank[made[at]] == r]
                if len(at):  # from the left without overlap
                    run = np.concatenate([[True], at[1:] != after[at[:-1]]])
                    first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
                    at = at[(np.arange(len(at)) - first) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            symbols[at] = made[at]
            made[gone] = -1
            after[at] = after[gone]
            before[after[at]] = at
            symbols[gone] = GONE
            touched = np.concatenate([at, before[at]])
            touched = np.unique(touched[touched >= 0])
            last = after[touched] >= n
            made[touched[last]] = -1
            touched = touched[~last]
            made[touched] = self.pair(symbols[touched], symbols[after[touched]])
            put(touched)
        return symbols[symbols != GONE]

    def merge(self, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the symbols of words (flat; ``ends`` after each word) to the end.

        Returns the final symbols and the ends.  Words without a pair left are
        set aside, so a round costs what is still moving.
        """
        n_words = len(ends)
        word = np.repeat(np.arange(n_words), np.diff(ends, prepend=0))
        done_symbols, done_words = [], []
        made = self._made(symbols, word)
        while len(symbols):
            rank = np.where(made >= 0, self.rank[made], NO_RANK)
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            finished = best == NO_RANK
            if finished.any():
                out = np.repeat(finished, sizes)
                done_symbols.append(symbols[out])
                done_words.append(word[out])
                symbols, word, made, rank = symbols[~out], word[~out], made[~out], rank[~out]
                best, sizes = best[~finished], sizes[~finished]
                if not len(symbols):
                    break
            take = rank == np.repeat(best, sizes)
            at = np.flatnonzero(take)
            # From the left without overlap: of neighbouring pairs each second goes.
            run = np.concatenate([[True], (at[1:] != at[:-1] + 1)])
            first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            # A piece that a longer one outranks: only the leftmost of the word.
            leftmost = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
            at = at[leftmost | ~self.alone[made[at]]]
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            position = np.cumsum(keep) - 1
            symbols, word, made = symbols[keep], word[keep], made[keep]
            fresh = position[at]
            touched = np.zeros(len(symbols) + 1, bool)
            touched[fresh] = touched[fresh - 1] = True  # -1 is the spare last place
            again = np.flatnonzero(touched[:-1])
            made[again] = self._made(symbols, word, again)
        if not done_symbols:
            return symbols, ends
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.cumsum(np.bincount(word, minlength=n_words))

    def _made(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """For each symbol (or those ``at``) the piece it makes with the next of its word."""
        at = np.arange(len(symbols)) if at is None else at
        out = np.full(len(at), -1, np.int32)
        inner = at < len(symbols) - 1
        inner[inner] = word[at[inner]] == word[at[inner] + 1]
        out[inner] = self.pair(symbols[at[inner]], symbols[at[inner] + 1])
        return out

    # -- texts ------------------------------------------------------------

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of UTF-8 texts, without begin and end: flat ids and offsets."""
        text = data.tobytes().decode("utf-8", "surrogatepass")
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        lead = (data & 0xC0) != 0x80
        count = np.concatenate([[0], np.cumsum(lead)])[offsets]
        # One mark before each text that isn't empty; spaces are marks.
        some = np.flatnonzero(np.diff(count))
        points = np.insert(np.where(points == 0x20, MARK, points), count[some], MARK)
        grown = count + np.concatenate([[0], np.cumsum(np.diff(count) > 0)])
        if not len(points):
            return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
        # Words begin at a text's start and at a mark after another character.
        mark = points == MARK
        begins = mark.copy()
        begins[1:] &= ~mark[:-1]
        begins[grown[:-1][some]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(points))
        # Each distinct word once.
        which, first = distinct_words(points, starts)
        sizes = ends[first] - starts[first]
        flat = np.repeat(starts[first] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(int(sizes.sum()))
        ids, word_ends = self._encode_words(points[flat], np.cumsum(sizes))
        word_starts = np.concatenate([[0], word_ends[:-1]])
        lengths = (word_ends - word_starts)[which]
        total = np.concatenate([[0], np.cumsum(lengths)])
        out = ids[np.repeat(word_starts[which] - total[:-1], lengths) + np.arange(int(total[-1]))]
        return out, total[np.searchsorted(starts, grown)]

    def _encode_words(self, points: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbols = self.char[np.minimum(points, len(self.char) - 1)]
        strange = symbols < 0
        symbols = np.where(strange, -1 - points, symbols).astype(np.int32)  # keeps the character
        symbols, ends = self.merge_words(symbols, ends)
        if not (symbols < 0).any():
            return symbols, ends
        # Bytes of the characters without a piece.
        lone = np.flatnonzero(symbols < 0)
        spelled = [chr(-1 - c).encode("utf-8", "surrogatepass") for c in symbols[lone].tolist()]
        sizes = np.ones(len(symbols), np.int64)
        sizes[lone] = [len(s) for s in spelled]
        at = np.cumsum(sizes) - sizes
        out = np.repeat(symbols, sizes)
        raw = np.frombuffer(b"".join(spelled), np.uint8)
        out[out < 0] = self.byte_id[raw]
        return out, np.concatenate([at, [len(out)]])[ends]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The UTF-8 text of each range of ids, as the library's decode gives it.

        Controls are silent.  The mark at the front of the first piece that
        isn't a control goes; bytes that are no UTF-8 become U+FFFD each.
        """
        begin, sizes = self.spell_at[ids], self.spell_at[ids + 1] - self.spell_at[ids]
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        spoken = np.flatnonzero(~self.is_control[ids])
        lead = spoken[np.concatenate([[True], row[spoken[1:]] != row[spoken[:-1]]])] if len(spoken) else spoken
        lead = lead[self.starts_with_mark[ids[lead]]]
        begin[lead] += 1
        sizes[lead] -= 1
        total = np.concatenate([[0], np.cumsum(sizes)])
        raw = self.spell[np.repeat(begin - total[:-1], sizes) + np.arange(int(total[-1]))].tobytes()
        cuts = total[offsets].tolist()
        out = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        # Runs of byte pieces stand alone: bytes over 0x7F may be no characters.
        high = self.is_byte[ids] & (self.spell[self.spell_at[ids]] > 0x7F)
        for k in np.unique(row[high]).tolist():
            lo, hi = offsets[k], offsets[k + 1]
            byte = self.is_byte[ids[lo:hi]]
            edges = [lo, *(lo + 1 + np.flatnonzero(byte[1:] != byte[:-1])).tolist(), hi]
            runs = [raw[total[a] : total[b]] for a, b in zip(edges[:-1], edges[1:])]
            out[k] = b"".join(_whole(r) if self.is_byte[ids[a]] else r for r, a in zip(runs, edges))
        return out


def _whole(raw: bytes) -> bytes:
    """The same with every byte that is no part of a UTF-8 character replaced."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            try:
                out.append(raw[at:].decode())
                break
            except UnicodeDecodeError as e:
                out.append(raw[at : at + e.start].decode() + "�")
                at += e.start + 1
        return "".join(out).encode()


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The vocabulary in this process."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, model: str, text: str = "text", id_: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded, decoded_sha256) for every row.

    ``model`` is the model file's path on the executors.  The ids have begin
    and end around them; ``decoded`` is the text they decode to.  Without
    ``with_ids`` the two long columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(model)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in groups(offsets, GROUP_BYTES):
                part = offsets[lo : hi + 1]
                ids, at = known.encode(data[part[0] : part[-1]], part - part[0])
                rows = hi - lo
                ids = np.insert(ids, np.stack([at[:-1], at[1:]], 1).ravel(), np.tile([known.begin, known.end], rows)).astype("<u4")
                at = at + 2 * np.arange(rows + 1)
                decoded = known.decode(ids.astype(np.int64), at)
                cuts = at.tolist()
                lists = [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                columns = [
                    batch.column(0).slice(lo, rows),
                    pa.array(np.diff(at)),
                    pa.array([hashlib.sha256(x).hexdigest() for x in lists], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))))
                    columns.append(pa.array([x.decode("utf-8", "replace") for x in decoded], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    names = [field.split()[0] for field in schema.split(", ")]
    return docs.select(F.col(id_).cast("long").alias("doc_id"), F.col(text).cast("string")).mapInArrow(run, schema)
