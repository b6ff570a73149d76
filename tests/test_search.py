"""Predicates, ACL, paging, envelopes, facets, full text and scores on fixtures."""

import json
import math

import pytest
from pyspark.sql import functions as F

from foliosearch import model as m
from foliosearch.functions import predicates as p
from foliosearch.operators import envelope as e
from foliosearch.operators.analysis import analyze, analyzed_terms
from foliosearch.operators.facets import facets, histogram_facet, range_facet, terms_facet
from foliosearch.operators.fulltext import fulltext_keys, fulltext_match, fulltext_query, search_fulltext
from foliosearch.operators.hydrate import hydrate
from foliosearch.operators.page import page, page_info, sort_hits
from foliosearch.operators.relevance import field_postings, field_statistics, score_postings, score_text
from foliosearch.operators.security import acl_filter, acl_join, acl_semi_join
from foliosearch.plans.search import Search
from foliosearch.sources import files
from foliosearch.sources.content import all_repositories, content, fetch_source

TITLES = ["rock 'n' roll", "rock ''n'' roll", "it's five o'clock", "five", "'", "d'une OR d'un", "ten % of '90"]


def ids(df):
    return sorted(row[0] for row in df.select(m.UUID).collect())


@pytest.fixture(scope="module")
def titles(spark):
    return spark.createDataFrame([(str(at), title) for at, title in enumerate(TITLES)], f"`{m.UUID}` string, `{m.TITLE}` string")


@pytest.mark.parametrize(
    "predicate, expected",
    [
        (lambda: p.equals(m.TITLE, "rock 'n' roll"), ["0"]),
        (lambda: p.like(m.TITLE, "%'n'%"), ["0", "1"]),
        (lambda: p.like(m.TITLE, "rock ''%"), ["1"]),
        (lambda: p.ilike(m.TITLE, "IT'S % O'CLOCK"), ["2"]),
        (lambda: p.equals(m.TITLE, "'"), ["4"]),
        (lambda: p.is_in(m.TITLE, ["five", "'", "''"]), ["3", "4"]),
        (lambda: p.equals(m.TITLE, "d'une OR d'un"), ["5"]),
        (lambda: p.like(m.TITLE, "ten \\% of '__"), ["6"]),
        (lambda: p.not_equals(m.TITLE, "'"), ["0", "1", "2", "3", "5", "6"]),
        (lambda: p.not_in(m.TITLE, ["rock 'n' roll", "dc:title = 'five'"]), ["1", "2", "3", "4", "5", "6"]),
    ],
)
def test_apostrophes_are_literal(titles, predicate, expected):
    assert ids(titles.where(predicate())) == expected


def test_negation_keeps_documents_without_the_value(spark):
    df = spark.createDataFrame(
        [("v", "deleted", ["Hidden"]), ("o", "project", ["Other"]), ("n", None, None), ("e", "project", [])],
        f"`{m.UUID}` string, `{m.STATE}` string, `{m.MIXINS}` array<string>",
    )
    assert ids(df.where(p.state_is_not("deleted"))) == ["e", "n", "o"]
    assert ids(df.where(p.not_in(m.STATE, ["project"]))) == ["n", "v"]
    assert ids(df.where(p.lacks_value(m.MIXINS, "Hidden"))) == ["e", "n", "o"]
    assert ids(df.where(p.has_value(m.MIXINS, "Hidden"))) == ["v"]
    assert ids(df.where(p.has_any_value(m.MIXINS, ["Hidden", "Other"]))) == ["o", "v"]


def test_path_startswith_takes_whole_components(spark):
    df = spark.createDataFrame([("/a/b",), ("/a/b/c",), ("/a/bc",), ("/a",)], f"`{m.UUID}` string")
    df = df.withColumn(m.PATH, F.col(m.UUID))
    assert ids(df.where(p.starts_with_path("/a/b"))) == ["/a/b", "/a/b/c"]
    assert ids(df.where(p.starts_with_path("/a/b/"))) == ["/a/b", "/a/b/c"]
    assert len(ids(df.where(p.starts_with_path("/")))) == 4
    assert ids(df.where(p.starts_with_path("b/c"))) == []


def test_between_dates_includes_both_days(spark):
    df = spark.sql(
        f"SELECT id AS `{m.UUID}`, CAST(at AS TIMESTAMP) AS `{m.MODIFIED}`, CAST(at AS DATE) AS `{m.ISSUED}` FROM VALUES "
        "('a', '2019-05-30 23:59:59'), ('b', '2019-05-31'), ('c', '2019-06-02 23:59:59'), ('d', '2019-06-03'), "
        "('n', NULL) AS t(id, at)"
    )
    for name in (m.MODIFIED, m.ISSUED):
        assert ids(df.where(p.between_dates(name, "2019-05-31", "2019-06-02"))) == ["b", "c"]
        assert ids(df.where(p.not_between_dates(name, "2019-05-31", "2019-06-02"))) == ["a", "d", "n"]


@pytest.fixture(scope="module")
def secured(spark):
    return spark.createDataFrame(
        [("default", "a", ["x", "y"]), ("default", "b", ["z"]), ("default", "n", None), ("default", "e", [])],
        f"`{m.REPOSITORY}` string, `{m.UUID}` string, `{m.ACL}` array<string>",
    )


def test_acl(spark, secured):
    assert ids(acl_filter(secured, ["y"])) == ["a"]
    assert ids(acl_filter(secured, ["y", "z", *map(str, range(500))])) == ["a", "b"]
    assert ids(acl_filter(secured)) == []
    assert ids(acl_filter(secured, ["y"], admin=True)) == ["a", "b", "e", "n"]
    principals = spark.createDataFrame([("x",), ("y",), ("x",)], "principal string")
    assert ids(acl_semi_join(secured, principals)) == ["a"]
    assert ids(acl_join(secured, principals)) == ["a"]
    assert ids(acl_semi_join(secured, principals.where("false"))) == []


def test_sort_nulls_last_both_ways_and_ignores_unknown_keys(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 2), ("d", 1)], f"`{m.UUID}` string, `{m.POS}` int")

    def order(*keys):
        return "".join(row[0] for row in sort_hits(df, keys).select(m.UUID).collect())

    assert order((m.POS, True)) == "adcb"
    assert order((m.POS, False)) == "cadb"
    assert order(("dc:absent", True)) == "abcd"
    assert order((m.TITLE, False)) == "abcd"
    assert order((f"{m.RECORD_VARIABLES}.x", False)) == "abcd"
    scored = df.withColumn("score", F.col(m.POS) * 1.0)
    assert "".join(row[0] for row in sort_hits(scored).select(m.UUID).collect()) == "cadb"


def test_titles_and_variables_sort_by_lowercase(spark):
    df = spark.createDataFrame(
        [("a", "Zoé", {"v": "b"}), ("b", "école", {"v": "A"}), ("c", "Ecole", {"v": "É"}), ("d", "abri", {})],
        f"`{m.UUID}` string, `{m.TITLE}` string, `{m.RECORD_VARIABLES}` map<string,string>",
    )
    assert [row[0] for row in sort_hits(df, [("DC:TITLE", True)]).select(m.UUID).collect()] == ["d", "b", "c", "a"]
    by_variable = sort_hits(df, [(f"{m.RECORD_VARIABLES}.v", True)])
    assert [row[0] for row in by_variable.select(m.UUID).collect()] == ["b", "a", "c", "d"]


def test_pages(spark):
    df = spark.range(45).select(F.format_string("%03d", "id").alias(m.UUID))
    assert page(sort_hits(df), -1).count() == 45
    assert ids(page(sort_hits(df), 20, 2)) == ["040", "041", "042", "043", "044"]
    assert ids(page(sort_hits(df), 20, 3)) == []
    for size, index, expected in [(20, 0, (20, 45, 3)), (20, 2, (5, 45, 3)), (20, 9, (0, 45, 3)), (45, 0, (45, 45, 1))]:
        info = page_info(df, size, index).first()
        assert (info.resultsCount, info.totalSize, info.pageCount) == expected
    empty = page_info(df.where("false"), 10, 0).first()
    assert (empty.resultsCount, empty.totalSize, empty.pageCount) == (0, 0, 0)
    for size, index in [(0, 0), (-2, 0), (10, -1)]:
        with pytest.raises(ValueError):
            page(df, size, index)
    for size in (0, -1):
        with pytest.raises(ValueError):
            page_info(df, size, 0)


def test_schemas(spark):
    schemas = spark.createDataFrame(
        [("dublincore", "dc"), ("note", "note"), ("plain", None), ("blank", " ")], "name string, prefix string"
    )
    assert e.requested_prefixes("dublincore, plain ,blank,nothing", schemas) == ["blank", "dc", "plain"]
    assert e.requested_prefixes(None, schemas) == e.requested_prefixes("*", schemas) == []
    with pytest.warns(UserWarning):
        assert e.requested_prefixes("nothing", schemas) == []
    df = spark.createDataFrame([("1", "2", "3", "4")], "`ecm:uuid` string, `dc:title` string, `dcx:y` string, `idx:z` string")
    assert e.property_columns(df, []) == ["dc:title", "dcx:y"]
    assert e.property_columns(df, ["dc", "ecm"]) == ["dc:title"]


def test_envelope_json(spark, tmp_path):
    rows = content(spark, "/root/testdata/sf0.001").where(F.col(m.UUID).isin("doc-7", "doc-17"))
    lines = {line["uid"]: line for line in (json.loads(row.value) for row in e.envelope_json(rows, ["dc"]).collect())}
    hit = lines["doc-17"]
    assert list(hit) == [
        "entity-type", "repository", "uid", "path", "type", "state", "parentRef", "versionLabel", "isCheckedOut",
        "title", "lastModified", "facets", "changeToken", "properties",
    ]
    assert hit["entity-type"] == "document" and hit["isCheckedOut"] == ""
    assert hit["facets"] is None and "facets" in hit
    assert hit["lastModified"] == "2016-01-18T00:00:00.000Z"
    assert set(hit["properties"]) == {
        "dc:title", "dc:description", "dc:subjects", "dc:created", "dc:expired", "dc:modified", "dc:issued"
    }
    everything = json.loads(e.envelope_json(rows).first().value)["properties"]
    assert m.BINARY_TEXT not in everything and m.NOTE in everything
    files.write_envelope(rows, str(tmp_path / "hits"))
    assert sorted(row.uid for row in files.read_envelope(spark, str(tmp_path / "hits")).collect()) == ["doc-17", "doc-7"]


def test_page_json_keeps_page_order(spark):
    rows = content(spark, "/root/testdata/sf0.001")
    keys = [(m.POS, False)]
    whole = json.loads(e.page_json(rows, 7, 1, keys).first().value)
    assert whole["entity-type"] == "documents" and whole["isPaginable"] is True
    assert (whole["resultsCount"], whole["totalSize"], whole["pageCount"], whole["currentPageIndex"]) == (7, 200, 29, 1)
    hits = page(sort_hits(rows, keys), 7, 1)
    assert [entry["uid"] for entry in whole["entries"]] == [row[0] for row in hits.select(m.UUID).collect()]
    none = json.loads(Search(p.equals(m.UUID, "?"), admin=True, page_size=5).document(rows).first().value)
    assert none["entries"] == [] and none["totalSize"] == 0
    with pytest.raises(ValueError):
        e.page_json(rows, -1)


def test_export_in_batches(spark, tmp_path):
    df = content(spark, "/root/testdata/sf0.001").coalesce(1)
    files.export(df, str(tmp_path / "out"), batch=30)
    parts = [file for file in (tmp_path / "out").iterdir() if file.suffix == ".parquet"]
    assert len(parts) == 7
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200 and m.BINARY_TEXT not in back.columns


def test_sources(spark):
    one = spark.createDataFrame([("a", 1)], f"`{m.UUID}` string, x int")
    two = spark.createDataFrame([("b",)], f"`{m.UUID}` string")
    assert [tuple(row) for row in all_repositories([one, two]).orderBy(m.UUID).collect()] == [("a", 1), ("b", None)]
    assert fetch_source(one, include=["x"]).columns == ["x"]
    assert fetch_source(one, exclude=["x"]).columns == [m.UUID]


def test_hydrate_keeps_page_order(spark):
    rows = content(spark, "/root/testdata/sf0.001")
    keys = [(m.POS, False)]
    narrow = rows.select(*m.KEY, m.POS)
    hits = page(sort_hits(narrow, keys), 10)
    full = hydrate(narrow, rows, 10, 0, keys).collect()
    assert [row[m.UUID] for row in full] == [row[0] for row in hits.select(m.UUID).collect()]
    assert all(row[m.NOTE] for row in full)
    with pytest.raises(ValueError):
        hydrate(narrow, rows, -1)


def test_facets(spark):
    df = spark.createDataFrame(
        [("a", ["x", "y", "x"], 1.0), ("b", ["x"], 15.0), ("b", [], None), (None, None, -1.0)],
        "kind string, tags array<string>, size double",
    )
    wanted = [
        terms_facet("kind", "kind", 1), terms_facet("tag", "tags"), histogram_facet("size", "size", 10),
        range_facet("range", "size", [("small", None, 5.0), ("large", 5.0, None)]),
    ]
    assert {tuple(row) for row in facets(df, wanted).collect()} == {
        ("kind", "b", 2), ("tag", "x", 2), ("tag", "y", 1), ("size", "0", 1), ("size", "10", 1), ("size", "-10", 1),
        ("range", "small", 2), ("range", "large", 1),
    }
    with pytest.raises(ValueError):
        facets(df, [wanted[0], wanted[0]])


TEXTS = ["Espace d'apprentissage en scolarité", "Espace d'apprentissage noindex", "apprentissage", "Wi-Fi power", "", None]


def brute_force(spark, df, query, language="fulltext"):
    """Positions checked one document at a time."""
    held = {}
    for row in analyze(df, ["id"], "text", language).collect():
        held.setdefault(row.id, set()).add(row.term)

    def matches(terms, clause):
        return all(terms & set(position) for position in clause)

    return sorted(
        row.id
        for row in df.collect()
        if (query.required or query.excluded)
        and all(matches(held.get(row.id, set()), clause) for clause in query.required)
        and not any(matches(held.get(row.id, set()), clause) for clause in query.excluded)
    )


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Espace d'apprentissage en scolarité -noindex", [0]),
        ("espace APPRENTISSAGE", [0, 1]),
        ("d'apprentissage", [0, 1, 2]),
        ("scolarite", [0]),
        ("-apprentissage", [3, 4, 5]),
        ("-noindex -wi-fi", [0, 2, 4, 5]),
        ("absent espace", []),
        ("le la", []),
        ("", []),
    ],
)
def test_fulltext(spark, text, expected):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    query = fulltext_query(spark, text)
    terms = analyze(df, ["id"], "text", "fulltext")
    assert sorted(row.id for row in search_fulltext(df, terms, ["id"], query).collect()) == expected
    in_row = df.withColumn("terms", analyzed_terms(F.col("text"), "fulltext")).where(fulltext_match(query, "terms"))
    assert sorted(row.id for row in in_row.collect()) == expected
    assert brute_force(spark, df, query) == expected
    if query.required:
        assert sorted(row.id for row in fulltext_keys(terms, ["id"], query).collect()) == expected


def test_scores_against_brute_force(spark):
    texts = [("chat chat chien", "chat"), ("chien", "rien du tout"), ("rien", None), (None, None)]
    df = spark.createDataFrame([(at, *text) for at, text in enumerate(texts)], "id int, title string, body string")
    boosts = {"title": 2.0, "body": 1.0}
    query = ["chat", "chien", "absent"]
    fields = {
        (at, name): (text[column] or "").replace("du", "").split()
        for at, text in enumerate(texts)
        for column, name in enumerate(boosts)
    }
    expected = {}
    for (at, name), words in fields.items():
        for term in query:
            tf = words.count(term)
            if tf:
                df_ = sum(term in words_ for (_, other), words_ in fields.items() if other == name)
                idf = 1 + math.log(len(texts) / (df_ + 1))
                score = math.sqrt(tf) * idf**2 * boosts[name] / math.sqrt(len(words))
                expected[at] = expected.get(at, 0) + score
    scored = {row.id: row.score for row in score_text(df, ["id"], query, boosts).collect()}
    assert scored == {at: pytest.approx(score, abs=1e-6) for at, score in expected.items()}
    posted = field_postings(df, ["id"], list(boosts))
    again = score_postings(posted, field_statistics(posted), df.count(), ["id"], query, boosts)
    assert {row.id: row.score for row in again.collect()} == pytest.approx(scored)


def test_search_without_matches(spark):
    rows = content(spark, "/root/testdata/sf0.001")
    none = Search(p.equals(m.PRIMARY_TYPE, "Nothing"), admin=True, page_size=10)
    assert none.hits(rows).count() == 0
    assert none.total(rows).first()[0] == 0
    assert none.envelopes(rows).count() == 0
    assert Search(p.match_all()).hits(rows).count() == 0
