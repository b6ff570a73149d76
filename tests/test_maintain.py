"""Rebuilds of an index table, on hand-written trees."""

import pytest
from pyspark.sql import functions as F

from foliosearch import model as m
from foliosearch.functions import predicates as p
from foliosearch.operators import maintain
from foliosearch.plans.index_table import IndexTable
from foliosearch.sources.content import content

COLUMNS = f"`{m.REPOSITORY}` string, `{m.UUID}` string, `{m.ANCESTOR_IDS}` array<string>, `{m.TITLE}` string"


def documents(spark, *rows):
    return spark.createDataFrame(rows, COLUMNS)


def rows(df):
    return sorted((row[0], row[1], row[2]) for row in df.select(m.REPOSITORY, m.UUID, m.TITLE).collect())


@pytest.fixture
def index(spark, tmp_path):
    table = IndexTable(spark, str(tmp_path / "index"), derive=False)
    table.create(
        documents(
            spark,
            ("r1", "root", [], "old"),
            ("r1", "a", ["root"], "old"),
            ("r1", "gone", ["root"], "old"),
            ("r1", "other", None, "old"),
            ("r2", "root", [], "old"),
        )
    )
    return table


def test_all_rebuilds_one_repository_only(spark, index):
    source = documents(spark, ("r1", "a", [], "new"), ("r2", "b", [], "new"))
    index.reindex("ALL", source, "r1", principal="alice")
    assert rows(index.read()) == [("r1", "a", "new"), ("r2", "root", "old")]
    assert [row.principal for row in index.audit().collect()] == ["alice"]


def test_changes_before_a_full_rebuild_do_not_come_back(spark, index):
    source = documents(spark, ("r1", "a", ["root"], "new"), ("r2", "root", [], "new"))
    index.reindex("QUERY", source, "r1", predicate=p.match_all())
    index.reindex("QUERY", source, "r2", predicate=p.match_all())
    index.reindex("ALL", documents(spark, ("r1", "z", [], "newest")), "r1")
    assert rows(index.read()) == [("r1", "z", "newest"), ("r2", "root", "new")]
    index.reindex("QUERY", documents(spark, ("r1", "a", [], "later")), "r1", predicate=p.match_all())
    expected = [("r1", "a", "later"), ("r1", "z", "newest"), ("r2", "root", "new")]
    assert rows(index.read()) == expected
    index.compact()
    assert rows(index.read()) == expected


def test_subtree_of_a_live_root(spark, index):
    source = documents(spark, ("r1", "root", [], "new"), ("r1", "fresh", ["root"], "new"), ("r2", "x", ["root"], "new"))
    index.reindex("ROOT", source, "r1", root_id="root")
    expected = [("r1", "fresh", "new"), ("r1", "other", "old"), ("r1", "root", "new"), ("r2", "root", "old")]
    assert rows(index.read()) == expected


def test_subtree_of_a_vanished_root_is_pruned(spark, index):
    source = documents(spark, ("r1", "a", ["root"], "new"))
    index.reindex("ROOT", source, "r1", root_id="root")
    assert rows(index.read()) == [("r1", "other", "old"), ("r2", "root", "old")]


def test_both_forms_of_a_subtree_rebuild_agree(spark, index):
    for source in (
        documents(spark, ("r1", "root", [], "new"), ("r1", "b", ["root"], "new")),
        documents(spark, ("r1", "b", ["root"], "new")),
    ):
        current = index.read()
        whole = maintain.reindex_subtree(current, source, "r1", "root")
        changed = maintain.apply_changes(current, maintain.subtree_changes(current, source, "r1", "root"))
        assert rows(whole) == rows(changed)


def test_blank_requests(spark, index, caplog):
    source = documents(spark, ("r1", "a", [], "new"))
    before = rows(index.read())
    for root in (None, "", "  "):
        index.reindex("ROOT", source, "r1", root_id=root)
        assert rows(maintain.reindex_subtree(index.read(), source, "r1", root)) == before
    index.reindex("QUERY", source, "r1")
    assert rows(maintain.reindex_query(index.read(), source, "r1", None)) == before
    assert rows(index.read()) == before
    assert index.audit().count() == 0
    assert len(caplog.records) == 8


def test_unknown_type_is_refused(spark, index):
    with pytest.raises(ValueError):
        index.reindex("SOME", documents(spark, ("r1", "a", [], "new")), "r1")


def test_index_columns_are_derived_and_never_returned(spark, tmp_path):
    from foliosearch.sources.content import fetch_source

    rows_ = content(spark, "/root/testdata/sf0.001").where(F.col(m.POS) == 3)
    table = IndexTable(spark, str(tmp_path / "derived"))
    table.create(rows_)
    found = table.read()
    assert {m.TITLE_LOWERCASE, m.ALL_TERMS, m.PATH_CHILDREN} <= set(found.columns)
    returned = set(fetch_source(found).columns)
    assert returned == {field.name for field in m.CONTENT_SCHEMA} - {m.BINARY_TEXT}


def test_repository_names_stay_text(spark, tmp_path):
    table = IndexTable(spark, str(tmp_path / "numbers"), derive=False)
    table.create(documents(spark, ("007", "a", [], "x"), ("2016", "b", [], "y")))
    table.reindex("QUERY", documents(spark, ("007", "a", [], "z")), "007", predicate=p.match_all())
    assert rows(table.read()) == [("007", "a", "z"), ("2016", "b", "y")]


def test_an_unchanged_repository_is_not_written(spark, index):
    same = index.read().persist()
    for kind, more in (("ALL", {}), ("ROOT", {"root_id": "root"}), ("QUERY", {"predicate": p.match_all()})):
        index.reindex(kind, same, "r1", only_changed=True, **more)
    assert index.version() == 1 and index.audit().count() == 3
    assert len(rows(index.read())) == 5


@pytest.mark.parametrize("kind", ["ALL", "ROOT", "QUERY"])
def test_rebuilds_of_what_differs_read_like_whole_ones(spark, tmp_path, index, kind):
    more = {"ALL": {}, "ROOT": {"root_id": "root"}, "QUERY": {"predicate": p.match_all()}}[kind]
    source = documents(
        spark, ("r1", "root", [], "old"), ("r1", "a", ["root"], "new"), ("r1", "fresh", ["root"], None), ("r1", "other", [], "old"),
        ("r1", "twice", ["root"], "x"), ("r1", "twice", ["root"], "x"), ("r2", "root", [], "new"), (None, "a", ["root"], "new"),
    )
    whole = IndexTable(spark, str(tmp_path / "whole"), derive=False)
    whole.create(index.read())
    whole.reindex(kind, source, "r1", **more)
    index.reindex(kind, source, "r1", only_changed=True, **more)
    assert rows(index.read().na.fill("-")) == rows(whole.read().na.fill("-"))
    written = {row[1] for row in index.written(2).collect()}
    assert "root" not in written and {"a", "fresh", "twice"} <= written
    assert ("gone" in written) == (kind != "QUERY")
    assert ("other" in written) == (kind != "ROOT")  # its list of ancestors was null, and is empty now


def test_a_digest_tells_values_apart(spark):
    told = spark.sql(
        """SELECT * FROM VALUES (1, CAST(null AS string), timestamp'2020-01-01 00:00:00.000001'), (2, '', timestamp'2020-01-01 00:00:00.000001'),
        (3, 'null', timestamp'2020-01-01 00:00:00.000001'), (4, '', timestamp'2020-01-01 00:00:00.000002') AS t(n, s, at)"""
    )
    digests = told.drop("n").select(maintain.content_digest(told.drop("n")).alias("d"))
    assert digests.distinct().count() == 4
    assert told.select(maintain.content_digest(told.drop("n"), "other").alias("d")).intersect(digests).count() == 0


def test_a_rebuild_of_what_differs_analyses_that_alone(spark, tmp_path):
    whole = content(spark, "/root/testdata/sf0.001")
    index = IndexTable(spark, str(tmp_path / "derived"))
    index.create(whole)
    index.reindex("ALL", whole, "default", only_changed=True)
    assert index.version() == 1
    renamed = F.when(F.col(m.UUID) == "doc-7", "another title").otherwise(F.col(m.TITLE))
    index.reindex("ALL", whole.withColumn(m.TITLE, renamed), "default", only_changed=True)
    assert {row[1] for row in index.written(2).collect()} == {"doc-7"}
    assert index.read().where(F.col(m.UUID) == "doc-7").select(m.TITLE_LOWERCASE).collect()[0][0] == "another title"
