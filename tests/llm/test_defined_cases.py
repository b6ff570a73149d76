"""Cases that once went wrong: colliding texts, long words, clashing names, odd schemas."""

import time

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from foliosearch.llm import op01_language, op04_tool_calls, op05_lines, op06_pieces, op07_simhash, op10_decontaminate, op12_mixing, op13_periodic
from foliosearch.llm.batches import text_bytes
from foliosearch.llm.queries import SCHEMAS, tokenizer
from foliosearch.session import ship_package


def thue_morse(a, b, n):
    """Letters whose polynomial hash modulo 2^64 is that of the same with both letters exchanged."""
    return "".join((a, b)[bin(k).count("1") % 2] for k in range(n))


def frame(spark, texts, names=("doc_id", "text"), **more):
    df = ship_package(spark).createDataFrame(list(enumerate(texts)), "a long, b string").toDF(*names)
    return df.select("*", *[F.lit(v).alias(k) for k, v in more.items()])


# -- equal hashes aren't equal texts ---------------------------------------


def test_lines_with_like_spelling_are_no_copies(spark):
    texts = ["one common line\n" + thue_morse(*pair, 2048) for pair in ("ab", "ba")]
    rows = op05_lines.drop_repeated_lines(frame(spark, texts)).collect()
    assert sorted(r.text for r in rows) == sorted(texts)


def test_windows_with_like_spelling_are_no_hits(spark):
    items = frame(spark, [thue_morse("a", "b", 2048) + " x"], ("item_id", "text"))
    docs = frame(spark, [thue_morse("b", "a", 2048) + " x", thue_morse("a", "b", 2048) + " x"])
    assert [r.doc_id for r in op10_decontaminate.clean_documents(docs, items).collect()] == [0]


@pytest.fixture(scope="module")
def library():
    path = tokenizer()
    return sentencepiece.SentencePieceProcessor(model_file=path), op06_pieces.pieces(path)


def ids_of(pieces, texts):
    data, offsets = text_bytes(pa.array(texts))
    ids, at = pieces.encode(data, offsets)
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


@pytest.mark.parametrize("pair", ["ab", "xy", "et", "ié"])
def test_words_with_like_spelling_have_their_own_pieces(library, pair):
    model, pieces = library
    words = [thue_morse(*p, n) for n in (512, 1024) for p in (pair, pair[::-1])]
    texts = [" ".join(words), *words]
    assert ids_of(pieces, texts) == [model.encode(t) for t in texts]


# -- long words -------------------------------------------------------------


def long_words(n, seed):
    rnd = np.random.default_rng(seed)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
    return "".join(letters[rnd.integers(0, 64, n)])


def test_long_words_equal_the_library(library, monkeypatch):
    model, pieces = library
    texts = [long_words(3000, 1), "a" * 3001, "ab" * 900 + "é的▁\n" * 70 + "ingtheion" * 99, "short " + long_words(700, 2) + " words"]
    assert ids_of(pieces, texts) == [model.encode(t) for t in texts]
    monkeypatch.setattr(op06_pieces, "LONG", 3)  # nearly every word by itself
    texts += ["the quick brown fox, and other words", "a bb ccc dddd", "", " ", "naïve  café\t的的"]
    assert ids_of(pieces, texts) == [model.encode(t) for t in texts]


def test_twice_the_word_takes_little_more_than_twice_the_time(library):
    _, pieces = library
    took = []
    for n in (40_000, 160_000):
        began = time.process_time()
        ids_of(pieces, [long_words(n, n)])
        took.append(time.process_time() - began)
    assert took[1] < 8 * took[0] + 1  # four times the letters; the square would be sixteen times


# -- names ------------------------------------------------------------------

CLASHING = {"N_Hit": 1, "items": 2, "hit_words": 3, "hit_words_before": 4, "Items_Before": 5, "score": 6, "LANG_PRED": 7, "lettered": 8}
CLASHING |= {"id": 9, "key": 10, "starts": 11, "own": 12, "Cut": 13, "least": 14, "own_": 15, "__key": 16, "__kept": 17}


def keeps(spark):
    items = frame(spark, ["w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"], ("item_id", "text"))
    return {
        "keep_identified": op01_language.keep_identified,
        "drop_repeated_lines": op05_lines.drop_repeated_lines,
        "keep_one": op07_simhash.keep_one,
        "clean_documents": lambda df: op10_decontaminate.clean_documents(df, items),
        "remove_spans": lambda df: op10_decontaminate.remove_spans(df, items),
        "mix": lambda df: op12_mixing.mix(df, weights=(1,)),
    }


@pytest.mark.parametrize("names", [("doc_id", "text"), ("Doc_ID", "TEXT")])
@pytest.mark.parametrize("kept", ["keep_identified", "drop_repeated_lines", "keep_one", "clean_documents", "remove_spans", "mix"])
def test_own_columns_survive(spark, kept, names):
    texts = ["some words of a text that has no copy", "quite another text with its own words here", "der dritte Text ist deutsch und hat Wörter"] * 2
    docs = frame(spark, [f"{t} {k}" for k, t in enumerate(texts)], names, lang="en", source="s", **CLASHING)
    got = keeps(spark)[kept](docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert rows and all(tuple(r)[4:] == tuple(CLASHING.values()) for r in rows)


def test_hits_replace_columns_of_their_names(spark):
    docs = frame(spark, ["x"], **CLASHING)
    got = op10_decontaminate.find_hits(docs, frame(spark, ["x"], ("item_id", "text")))
    assert [c for c in got.columns if c in op10_decontaminate.HITS.names] == op10_decontaminate.HITS.names
    assert got.first().n_hit == 1


def test_runs_of_a_column_in_another_case(spark):
    assert op13_periodic.find_runs(frame(spark, ["a " * 20], ("n_words", "TEXT"))).first().runs[0].length == 20


# -- schemas ----------------------------------------------------------------


@pytest.mark.parametrize(
    ("tool", "arguments", "valid"),
    [
        ("bare", "{}", True),
        ("bare", '{"x":1}', False),
        ("two", '{"p":1}', True),
        ("two", '{"p":"s"}', True),
        ("two", '{"p":true}', False),
        ("any", '{"p":[1]}', True),
        ("any", "{}", False),
        ("search", '{"words":1,"digest":"d"}', True),
    ],
)
def test_tools_without_parameters_and_with_several_kinds(spark, tool, arguments, valid):
    schemas = [*SCHEMAS, ("bare", None, None, None), ("two", "p", "integer", True), ("two", "p", "string", False), ("any", "p", None, True)]
    schemas = spark.createDataFrame(schemas, "tool string, param string, kind string, required boolean")
    calls = spark.createDataFrame([(1, 1, "c1", tool, arguments, [])], "conv_id long, turn long, call_id string, tool string, arguments string, after array<string>")
    results = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    assert op04_tool_calls.link(calls, results, schemas).first().valid == valid


# -- languages of unequal size ------------------------------------------------


def test_small_languages_keep_their_contexts(spark):
    rnd = np.random.default_rng(5)
    rows = []
    for k in range(10):
        letters = np.array(list("abcdefghijklmnop"))[rnd.permutation(16)[:8]]
        words = ["".join(letters[rnd.integers(0, 8, rnd.integers(2, 6))]) for _ in range(40)]
        rows += [(len(rows) + j, " ".join(rnd.choice(words, 30)), f"l{k}") for j in range(8 if k else 400)]
    docs = ship_package(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    got = op01_language.identify(docs, contexts=200).collect()
    small = [r for r in got if r.lang != "l0"]
    assert sum(r.lang_pred == r.lang for r in small) >= 0.95 * len(small)
