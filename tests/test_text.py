"""Analyzers, on hand-written text."""

import itertools
import time

import pytest
from pyspark.sql import functions as F

from foliosearch import model as m
from foliosearch.functions import text as t
from foliosearch.operators.analysis import analyze, analyzed_terms, postings, term_statistics
from foliosearch.operators.fields import catch_all, derive_fields


def apply(spark, function, *values):
    df = spark.createDataFrame([(value,) for value in values], "value string")
    return [row[0] for row in df.select(function(F.col("value"))).collect()]


def one(spark, function, value):
    return apply(spark, function, value)[0]


def positions(spark, text, language):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    found = {}
    for row in analyze(df, ["id"], "text", language).collect():
        found.setdefault((row.pos, row.part), []).append(row.term)
    return [sorted(terms) for _, terms in sorted(found.items())]


@pytest.mark.parametrize(
    "markup, text",
    [
        ("plain text", "plain text"),
        ("<b>x</b>&amp;y", "x&y"),
        ("a<!-- <p>hidden</p> -->b", "ab"),
        ("<p>one</p><p>two</p>", "\none\n\ntwo\n"),
        ("em<em>pha</em>sis<br/>next", "emphasis\nnext"),
        ("<SCRIPT type='x'>var a = '</p>';</SCRIPT>left", "\nleft"),
        ("<style>p{}</style>left", "\nleft"),
        ("&eacute;&#233;&#xE9;&#x1F600;", "ééé😀"),
        ("&amp;lt; &lt;b&gt; &#38;gt;", "&lt; <b> &gt;"),
        ("&unknown; &#0; 5 < 6 & 7", "&unknown; &#0; 5 < 6 & 7"),
        (None, None),
    ],
)
def test_strip_html(spark, markup, text):
    assert one(spark, t.strip_html, markup) == text


@pytest.mark.parametrize(
    "text, words",
    [
        ("L'École Wi-Fi", ["L'École", "Wi", "Fi"]),
        ("l’arche, l ' arc'he'", ["l’arche", "l", "arc'he"]),
        ("3,5 kg v1.2 a.b. x_y", ["3,5", "kg", "v1.2", "a.b", "x_y"]),
        ("1.a a.1 'quoted'", ["1", "a", "a", "1", "quoted"]),
        ("  …  ", []),
    ],
)
def test_words(spark, text, words):
    assert one(spark, t.words, text) == words


def test_words_of_hostile_text(spark):
    """Neither a very long word nor one that alternates overflows the matcher."""
    long_word, mixed = "a" * 300_000, "a1" * 150_000
    found = one(spark, t.words, f"{long_word} {mixed} a" + "'a" * 100_000)
    assert [len(word) for word in found] == [300_000, 300_000, 200_001]


@pytest.mark.parametrize(
    "word, parts",
    [
        ("word", ["word"]),
        ("Word", ["Word"]),
        ("WORD", ["WORD"]),
        ("PowerShot500", ["PowerShot500", "Power", "Shot", "500"]),
        ("l'arche", ["l'arche", "l", "arche"]),
        ("O'Neil's", ["O'Neil's", "O", "Neil"]),
        ("x_y", ["x_y", "x", "y"]),
        ("___", ["___"]),
        ("500", ["500"]),
        ("a1b2", ["a1b2", "a", "1", "b", "2"]),
    ],
)
def test_word_parts(spark, word, parts):
    assert one(spark, t.with_word_parts, word) == parts


def test_stem_english(spark):
    words = {"ponies": "pony", "classes": "classe", "bus": "bus", "class": "class", "shoes": "shoes", "cats": "cat",
             "is": "is", "ies": "ies", "zombaies": "zombaies", "employees": "employees", "word": "word"}
    assert apply(spark, t.stem_english, *words) == list(words.values())


def test_stem_french(spark):
    words = {"chevaux": "cheval", "canaux": "canal", "joyeux": "joyeu", "jeux": "jeux", "arche": "arche",
             "l'arche": "l'arch", "manger": "mang", "années": "an", "employée": "employ", "classes": "clas",
             "passéers": "pas", "100000": "100000"}
    assert apply(spark, t.stem_french, *words) == list(words.values())


def test_fold_accents(spark):
    assert apply(spark, t.fold_accents, "école", "Straße", "œuvre", "ÀÉÎÕÜ", "łódź", "plain", "l’arche") == [
        "ecole", "Strasse", "oeuvre", "AEIOU", "lodz", "plain", "l'arche"
    ]
    assert apply(spark, t.with_folded, "école", "plain") == [["ecole", "école"], ["plain"]]


def test_drop_article(spark):
    words = {"l'arche": "arche", "qu’il": "il", "d'": "", "aujourd'hui": "aujourd'hui", "lune": "lune"}
    assert apply(spark, t.drop_article, *words) == list(words.values())


def test_article_is_dropped_last(spark):
    """The kept word is stemmed with its article, its part without: two terms."""
    assert positions(spark, "l'arche", "fr") == [["arch"], ["arche"]]
    assert positions(spark, "arche", "fr") == [["arche"]]
    assert positions(spark, "l'arche", "fulltext") == positions(spark, "l'arche", "fr")


def test_stop_words_go_before_stemming(spark):
    assert positions(spark, "the The lists of", "en") == [["list"]]
    assert positions(spark, "les Étaient écoles", "fr") == [["ecol", "écol"]]


def test_original_and_first_part_share_a_position(spark):
    assert positions(spark, "PowerShot500 x", "en") == [["power", "powershot500"], ["shot"], ["500"], ["x"]]


def test_terms_in_their_row_are_those_of_the_table(spark):
    texts = ["L'École Wi-Fi PowerShot500 &amp; <b>œuvres</b>", "l'arche d'alliance", "", None, "x " * 1000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for language in ("en", "fr"):
        exploded = {}
        for row in analyze(df, ["id"], "text", language).collect():
            exploded.setdefault(row.id, set()).add(row.term)
        in_row = df.select("id", analyzed_terms(F.col("text"), language).alias("terms")).collect()
        assert {row.id: set(row.terms) for row in in_row if row.terms} == exploded
        assert all(len(set(row.terms)) == len(row.terms) for row in in_row if row.terms)


def test_statistics_count_documents_and_occurrences(spark):
    df = spark.createDataFrame([(1, "chat chat chien"), (2, "chat"), (3, "rien")], "id int, text string")
    posted = postings(analyze(df, ["id"], "text", "fr"), ["id"])
    assert {(row.term, row.df, row.cf) for row in term_statistics(posted).collect()} == {
        ("chat", 2, 3), ("chien", 1, 1), ("rien", 1, 1)
    }


def test_path_hierarchy(spark):
    assert apply(spark, t.path_hierarchy, "/a/b/c", "/a", "/", "a/b") == [
        ["/a", "/a/b", "/a/b/c"], ["/a"], ["/"], ["a", "a/b"]
    ]


def test_keyword_and_sort_key(spark):
    value = "É" * 300
    assert one(spark, t.keyword, value) == "É" * 256
    assert one(spark, t.sort_key, value) == "e" * 256


def test_parse_date(spark):
    dates = apply(
        spark, lambda value: F.date_format(t.parse_date(value), "yyyy-MM-dd HH:mm"),
        "2016", "2016-07", "2016-07-11", "2016-07-11T10:00:00Z", "bad", None,
    )
    assert dates == ["2016-01-01 00:00", "2016-07-01 00:00", "2016-07-11 00:00", "2016-07-11 10:00", None, None]


@pytest.mark.parametrize("opening", ["<script>", "<script ", "<!-- ", "<a ", "<style>", "</b x"])
def test_unclosed_markup_takes_linear_time(spark, opening):
    def seconds(n):
        begin = time.perf_counter()
        assert one(spark, t.strip_html, "x" + opening * n).strip() == "x"
        return time.perf_counter() - begin

    seconds(10)
    assert seconds(200_000) < 10


def test_french_stems_are_those_of_the_pattern(spark):
    """Endings in all combinations, behind single and doubled letters and other signs."""
    pattern = r"(\p{L})\1é?e?r?s?$|é?e?r?s?$"
    endings = ["".join(part) for part in itertools.product(("", "é"), ("", "e"), ("", "r"), ("", "s"))]
    stems = ["parlot", "pomm", "chatt", "grannn", "ballss", "passer", "l'éco", "abcde11", "x__", "élé", "𝒜𝒜𝒜𝒜", "été", "a"]
    words = [stem + ending for stem in stems for ending in [*endings, "ss", "rr", "sr", "ee", "éé", "aux", "x"]]
    df = spark.createDataFrame([(word,) for word in words], "word string")
    word = F.col("word")
    matched = (
        F.when(F.length(word) < 6, word)
        .when(word.endswith("aux"), F.concat(F.left(word, F.length(word) - 3), F.lit("al")))
        .when(word.endswith("x"), F.left(word, F.length(word) - 1))
        .otherwise(F.regexp_replace(word, pattern, "$1"))
    )
    found = df.select("word", t.stem_french(word).alias("found"), matched.alias("matched"))
    assert found.where("found <> matched").collect() == []


def test_terms_of_all_fields_are_those_of_the_catch_all(spark):
    """A word of several fields counts for all of them, in any case and with its parts."""
    fields = [(m.TITLE, "Wi-Fi l'École"), (m.DESCRIPTION, None), (m.NOTE, "école Fi fi chats"), (m.BINARY_TEXT, "Wi-Fi école CHATS l'abri Wi")]
    columns = f"`{m.UUID}` string, `{m.PATH}` string, `{m.ACL}` array<string>, `{m.RECORD_VARIABLES}` map<string,string>, "
    columns += ", ".join(f"`{name}` string" for name, _ in fields)
    df = spark.createDataFrame([("doc-1", "/a/b", None, None, *[text for _, text in fields])], columns)
    row = derive_fields(df).first()
    whole = df.select(analyzed_terms(catch_all(df, [x for x in m.NOT_IN_CATCH_ALL if x not in dict(fields)]), "fulltext").alias("terms")).first()
    assert sorted(row[m.ALL_TERMS]) == sorted(whole.terms)
    assert row[m.DESCRIPTION_TERMS] is None and sorted(row[m.NOTE_TERMS]) == sorted(["ecole", "école", "fi", "chats"])
