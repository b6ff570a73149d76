"""Language ID, suffix tree and SentencePiece against brute force and the library."""

import hashlib
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from foliosearch.llm import op01_language, op02_suffix_tree, op06_pieces
from foliosearch.llm.queries import QUERIES, tokenizer
from foliosearch.session import ship_package

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, langs=None):
    rows = [(k, t, (langs or ["en"] * len(texts))[k], "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    return ship_package(spark).createDataFrame(rows, SCHEMA)


# -- language ID ----------------------------------------------------------


def ppm_length(counts, order, text):
    """Code length in bits by the definition, one byte at a time."""
    seen = {g[-1] for g in counts[0]}

    def probability(context, symbol):
        if context is None:
            return 1 / 256
        shorter = context[1:] if context else None
        table = {s: n for (c, s), n in by_context[len(context)].get(context, {}).items()} if False else by_context[len(context)].get(context, {})
        if not table:
            return probability(shorter, symbol)
        total, distinct = sum(table.values()), len(table)
        if symbol in table:
            rest = 1 - sum(probability(shorter, s) for s in table)
            return table[symbol] / (total + distinct) if rest > 1e-12 else table[symbol] / total
        rest = sum(probability(shorter, s) for s in range(256) if s not in table)
        return distinct / (total + distinct) * probability(shorter, symbol) / rest

    by_context = [{} for _ in range(order + 1)]
    for gram, n in counts[0].items():
        for k in range(order + 1):
            context = gram[order - k : order]
            table = by_context[k].setdefault(context, {})
            table[gram[-1]] = table.get(gram[-1], 0) + n
    padded = b"\0" * order + text
    bits = 0.0
    for at in range(order, len(padded)):
        context = padded[at - order : at]
        while context and context not in by_context[len(context)]:
            context = context[1:]
        bits -= math.log2(probability(context, padded[at]))
    assert seen
    return bits


def test_code_lengths_are_those_of_the_definition():
    order = 2
    training = [b"abracadabra", b"abba", b"cab dab"]
    grams = Counter()
    for text in training:
        padded = b"\0" * order + text
        grams.update(padded[k : k + order + 1] for k in range(len(text)))
    keys = np.array([int.from_bytes(g, "big") for g in grams], np.int64)
    model = op01_language.build(np.array(["x"] * len(keys), object), keys, np.array(list(grams.values())), order, 10_000)
    for text in (b"abrac", b"zzz", b"dad cab", b"a"):
        data = np.frombuffer(text, np.uint8)
        found = op01_language.code_lengths(model, data, np.array([0, len(data)]))[0, 0] / op01_language.UNIT
        assert found == pytest.approx(ppm_length([grams], order, text), abs=1e-2)
        pieces = op01_language.long_code_lengths(model, data, 2)[0] / op01_language.UNIT
        assert pieces == pytest.approx(found, abs=1e-9)


def test_language_query(spark):
    rows = QUERIES["op1_language_id"](spark, FOLDER).collect()
    lang = {r[0]: r[1] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    texts = ["the cat and the dog of the house"] * 30 + ["der hund und die katze im haus"] * 30 + [None, "", "12 34", "?" * 5000]
    docs = docs_of(spark, texts, ["en"] * 30 + ["de"] * 30 + [None] * 4).selectExpr("*", "'x' as lang_pred", "1 as SCORE")
    found = {r.doc_id: r for r in op01_language.identify(docs).collect()}
    assert [found[k].lang_pred for k in (0, 30, 60, 61, 62, 63)] == ["en", "de", "und", "und", "und", "und"]
    assert found[60].score == 0.0
    kept = op01_language.keep_identified(docs_of(spark, texts, ["en"] * 30 + ["de"] * 30 + [None] * 4))
    assert kept.count() == 60 and kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    nothing = op01_language.identify(docs_of(spark, ["abc"], [None])).first()
    assert (nothing.lang_pred, nothing.score) == ("und", 0.0)
    assert op01_language.identify(docs_of(spark, [])).count() == 0


# -- suffix tree ----------------------------------------------------------


def test_suffix_tree_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op2_suffix_tree_scores"](spark, FOLDER).collect()}
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    words = {k: (t or "").encode().lower().split() + [b""] for k, t in texts.items()}
    out = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in texts}
    counts = Counter(w for k in texts if not out[k] for w in words[k])
    total, distinct = sum(counts.values()), len(counts)
    for k, row in rows.items():
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words[k])
        known = sum(counts[w] > 0 for w in words[k])
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (out[k], len(words[k]), known, total)
        assert row.base_score == pytest.approx(base, rel=1e-9)
    assert len(rows) == len(texts)


def test_suffix_tree_is_a_distribution_and_retains_what_diverges(spark):
    texts = ["ab ab ab ab ab ac", "ab ab", None, "", "  "] * 4
    tree = op02_suffix_tree.train(docs_of(spark, texts).select("text"), order=3, gain=1e-3)
    states = len(tree.cost) // tree.classes
    seen = tree.classes - 1
    mass = np.exp2(-tree.cost.reshape(states, -1) / op02_suffix_tree.UNIT)
    assert mass[:, :seen].sum(axis=1) + (256 - seen) * mass[:, seen] == pytest.approx(np.ones(states), abs=1e-3)
    strict = op02_suffix_tree.train(docs_of(spark, texts).select("text"), order=3, gain=8.0)
    assert len(strict.cost) == strict.classes < len(tree.cost)


def test_a_larger_corpus_keeps_the_contexts_of_rare_words(spark):
    def kept(times):
        symbols, offsets = op02_suffix_tree.spelled([[b"aa", b"ab", b"ba"], [b"xy", b"xz", b"yx"]])
        grams = op02_suffix_tree.gram_keys(symbols, offsets, 2, 10)
        rows = [(int(g), 1000 if k >= offsets[1] else times) for k, g in enumerate(grams)]
        rare = spark.createDataFrame(rows, "gram long, n long").groupBy("gram").sum("n").toDF("gram", "n")
        return {r.key >> 8 for r in op02_suffix_tree.retained(rare, 2, op02_suffix_tree.GAIN).where("depth = 1").collect()}

    assert {ord("x"), ord("y")} <= kept(1_000_000_000)
    assert kept(1000) <= kept(1_000_000_000)


def test_a_tree_met_by_joins_scores_like_a_held_one(spark, monkeypatch):
    texts = ["ab ab ab ab ab ac", "the cat and the dog", None, "", "  ", "Zé ab"] * 20 + ["unseen Ω bytes %d" % k for k in range(40)]
    held = {r.doc_id: r for r in op02_suffix_tree.score(docs_of(spark, texts)).collect()}
    monkeypatch.setattr(op02_suffix_tree, "HELD_CELLS", 0)
    monkeypatch.setattr(op02_suffix_tree, "BLOCK_TOKENS", 50)
    joined = {r.doc_id: r for r in op02_suffix_tree.score(docs_of(spark, texts)).collect()}
    assert len(held) == len(joined) == len(texts)
    for k, row in held.items():
        assert joined[k][:5] == row[:5]
        assert joined[k].base_score == pytest.approx(row.base_score) and joined[k].score == pytest.approx(row.score, abs=1e-2)
    assert op02_suffix_tree.score(docs_of(spark, [])).count() == 0


def test_suffix_tree_of_odd_rows(spark):
    rows = op02_suffix_tree.score(docs_of(spark, [None, "", " \t", "a b", "a b"])).collect()
    assert sorted(r.n_tokens for r in rows) == [1, 1, 1, 3, 3]
    long = "word " * 3000
    assert op02_suffix_tree.score(docs_of(spark, [long, "x"])).count() == 2
    assert op02_suffix_tree.score(docs_of(spark, [])).count() == 0


def test_long_text_in_pieces(monkeypatch):
    symbols = np.frombuffer(b"abcab\n" * 50, np.uint8)
    keys, n = np.unique(op02_suffix_tree.gram_keys(symbols, np.array([0, len(symbols)]), 2, 10), return_counts=True)
    depth = np.concatenate([np.full(len(keys), d) for d in range(3)])
    masked = np.concatenate([keys & ((1 << 8 * (d + 1)) - 1) for d in range(3)])
    tree = op02_suffix_tree.build(depth, masked, np.tile(n, 3), 2)
    whole = op02_suffix_tree.text_units(tree, symbols, np.array([0, len(symbols)]))
    monkeypatch.setattr(op02_suffix_tree, "GROUP_BYTES", 7)
    assert op02_suffix_tree.text_units(tree, symbols, np.array([0, len(symbols)])) == whole


# -- pieces ---------------------------------------------------------------

ODD = ["", " ", "   ", "a" * 70, " " * 40 + "x", "▁", "a▁b  c", "<s>", "</s><0x0A>", "\x00\t\r\n", "😀é中ﬁ", "ab" * 100, "x" + " " * 21 + "y"]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer())


def test_pieces_equal_the_library(library):
    random.seed(6)
    parts = ["a", "the", "ing", " ", "  ", "    ", "\n", "é", "▁", "😀", "中", "<s>", "12", ".", "aaaa", "ll", "oo", "́"]
    texts = ODD + ["".join(random.choices(parts, k=random.randint(0, 40))) for _ in range(1500)]
    raw = [t.encode() for t in texts]
    known = op06_pieces.pieces(tokenizer())
    ids, at = known.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(x) for x in raw]))
    for k, text in enumerate(texts):
        own = ids[at[k] : at[k + 1]].tolist()
        assert own == library.encode(text)
        assert known.decode(np.array([1, *own, 2]), np.array([0, len(own) + 2]))[0].decode() == library.decode([1, *own, 2])


def test_any_ids_decode_as_in_the_library(library):
    random.seed(7)
    known = op06_pieces.pieces(tokenizer())
    for _ in range(1500):
        ids = [random.choice([0, 1, 2, 3, 13, 131, 198, 200, 227, 230, 259, 28705, random.randrange(32000)]) for _ in range(random.randint(0, 10))]
        assert known.decode(np.array(ids, np.int64), np.array([0, len(ids)]))[0].decode() == library.decode(ids)


def test_pieces_query(spark, library):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op6_sentencepiece_round_trip"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id] or "", add_bos=True, add_eos=True)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert tuple(row) == (row.doc_id, len(ids), digest, decoded)


def test_pieces_of_odd_rows(spark):
    rows = {r.doc_id: r for r in op06_pieces.encode_documents(docs_of(spark, [None, *ODD, "same", "same"]), tokenizer()).collect()}
    assert rows[0].ids == [1, 2] and rows[0].decoded == ""
    assert all(rows[k + 1].decoded == t.replace("▁", " ") for k, t in enumerate(ODD))
    assert op06_pieces.encode_documents(docs_of(spark, []), tokenizer()).count() == 0


def test_words_of_a_batch_are_read_without_a_copy_of_it():
    column = pa.array(["two words " * 1000] * 2000)
    tracemalloc.start()
    try:
        found = sum(len(words) for group in op02_suffix_tree._streams(column, 1 << 17) for words in group)
        _, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert found == 4_000_000 and most < column.nbytes / 2
