"""The newest command counts in whatever batch it comes; refused commands are kept."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from foliosearch import model as m
from foliosearch.operators import maintain
from foliosearch.plans.index_table import IndexTable
from foliosearch.streaming.changes import maintain_index, read_commands

COLUMNS = f"`{m.REPOSITORY}` string, `{m.UUID}` string, `{m.ANCESTOR_IDS}` array<string>, `{m.TITLE}` string"


def documents(spark, *rows):
    return spark.createDataFrame([("default", *row) for row in rows], COLUMNS)


def titles(df):
    return {row[0]: row[1] for row in df.select(m.UUID, m.TITLE).collect()}


def batch(spark, *commands):
    """Commands (number, type, document[, recursive])."""
    rows = [(c[0], c[1], c[2], "default", len(c) > 3, True) for c in commands]
    return spark.createDataFrame(rows, maintain.COMMAND_SCHEMA)


@pytest.fixture
def source(spark):
    return documents(spark, ("root", [], "new"), ("a", ["root"], "new"), ("b", ["root"], "new"), ("late", ["root"], "new"))


@pytest.fixture
def index(spark, tmp_path):
    table = IndexTable(spark, str(tmp_path / "index"), derive=False)
    table.create(documents(spark, ("root", [], "old"), ("a", ["root"], "old"), ("b", ["root"], "old")))
    return table


def test_an_older_command_changes_nothing(spark, index, source):
    index.apply_commands(batch(spark, (10, "INSERT", "late"), (10, "DELETE", "a")), source, "1")
    index.apply_commands(batch(spark, (5, "DELETE", "late"), (5, "INSERT", "a"), (5, "DELETE", "b")), source, "2")
    assert titles(index.read()) == {"root": "old", "late": "new"}
    index.apply_commands(batch(spark, (11, "INSERT", "a")), source, "3")
    assert titles(index.read()) == {"root": "old", "late": "new", "a": "new"}


COMMANDS = [
    (1, "INSERT", "a"),
    (2, "DELETE", "root", True),
    (3, "INSERT", "late"),
    (4, "DELETE", "late"),
    (4, "INSERT", "late"),
    (5, "INSERT", "b"),
]


def test_any_order_of_batches_gives_the_same_index(spark, tmp_path, source):
    """One command a batch, in many orders, against all in one."""
    want = {"late": "new", "b": "new"}
    orders = list(itertools.permutations(COMMANDS))
    for number, order in enumerate([COMMANDS[::-1], orders[401]]):
        index = IndexTable(spark, str(tmp_path / f"index{number}"), derive=False)
        index.create(documents(spark, ("root", [], "old"), ("a", ["root"], "old"), ("b", ["root"], "old")))
        for k, one in enumerate(order):
            index.apply_commands(batch(spark, one), source, f"batch {k}")
            if k == number % 6:
                index.compact()  # the numbers outlast it
        assert titles(index.read()) == want, order


def test_what_a_recursive_deletion_would_have_reached_stays_away(spark, index, source):
    """The document came into the index's source later than the deletion of its root."""
    index.apply_commands(batch(spark, (10, "DELETE", "root", True)), source, "1")
    index.apply_commands(batch(spark, (5, "INSERT", "late"), (6, "INSERT", "root", True)), source, "2")
    assert titles(index.read()) == {}
    index.apply_commands(batch(spark, (12, "INSERT", "late")), source, "3")
    assert titles(index.read()) == {"late": "new"}


def test_numbers_outlast_rebuilds_and_folding(spark, index, source):
    index.apply_commands(batch(spark, (10, "INSERT", "late"), (10, "DELETE", "b")), source, "1")
    index.reindex("ALL", source.where(F.col(m.UUID) != "b"), "default")
    index.compact()
    assert len(index.commits()) == 1
    index.apply_commands(batch(spark, (9, "DELETE", "late"), (9, "INSERT", "b")), source, "2")
    assert titles(index.read()) == {"root": "new", "a": "new", "late": "new"}
    # A batch from before the folding comes again, under its label.
    index.apply_commands(batch(spark, (10, "INSERT", "late"), (10, "DELETE", "b")), documents(spark), "1")
    assert titles(index.read()) == {"root": "new", "a": "new", "late": "new"}


def test_refused_commands_are_kept_by_batch(spark, tmp_path, index, source):
    feed = tmp_path / "feed"
    feed.mkdir()
    good = {"seq": 1, "type": "INSERT", "docId": "late", "repo": "default", "recurse": False, "sync": True}
    lines = [json.dumps(good | change) for change in ({}, {"type": "MOVE"}, {"type": None}, {"docId": None}, {"repo": None}, {"seq": None})]
    (feed / "1.json").write_text("\n".join([*lines, "{no json", '{"seq": "x", "type": "DELETE"}']))
    maintain_index(read_commands(spark, str(feed)), source, index, "feed", checkpoint=str(tmp_path / "checkpoint"))
    assert "late" in titles(index.read())
    refused = sorted((r.reason, r.type or "", r.unreadable or "") for r in index.rejects().collect())
    assert refused == [
        ("no document", "INSERT", ""),
        ("no number", "INSERT", ""),
        ("no repository", "INSERT", ""),
        ("unknown type", "", ""),
        ("unknown type", "MOVE", ""),
        ("unreadable", "", "{no json"),
        ("unreadable", "DELETE", '{"seq": "x", "type": "DELETE"}'),
    ]
    assert {r.batch.rsplit(" ", 2)[-2:][0] for r in index.rejects().collect()} == {"batch"}
    index.apply_commands(batch(spark, (3, "SWAP", "a")), source, "other")
    index.apply_commands(batch(spark, (4, "SWAP", "a")), source, "other")
    assert sorted(r.seq for r in index.rejects().where("batch = 'other'").collect()) == [3]


def test_an_index_without_refused_commands(index):
    assert index.rejects().collect() == []


def test_versions_and_their_difference(spark, index, source):
    index.apply_commands(batch(spark, (1, "INSERT", "a"), (2, "DELETE", "b"), (3, "INSERT", "late")), source, "1")
    index.reindex("QUERY", documents(spark, ("root", [], "old")), "default", predicate=F.lit(True))
    assert titles(index.read(1)) == {"root": "old", "a": "old", "b": "old"}
    found = index.difference(1, 3, [m.TITLE]).collect()
    assert sorted(tuple(r)[1:] for r in found) == [("a", "new", 1), ("a", "old", -1), ("b", "old", -1), ("late", "new", 1)]
    assert index.difference(3, 3, [m.TITLE]).collect() == []


def test_documents_without_a_repository_stay(spark, tmp_path):
    rows = [("r1", "a", ["root"], "old"), (None, "a", ["root"], "none"), (None, "x", None, "none"), ("r2", "b", [], "old")]
    table = IndexTable(spark, str(tmp_path / "index"), derive=False)
    old = spark.createDataFrame(rows, COLUMNS)
    table.create(old)
    new = spark.createDataFrame([("r1", "root", [], "new"), (None, "z", ["root"], "new")], COLUMNS)
    for kind, more in (("QUERY", {"predicate": F.lit(True)}), ("ROOT", {"root_id": "root"}), ("ALL", {}), ("QUERY", {"predicate": F.lit(True)})):
        table.reindex(kind, new, "r1", **more)
        found = table.read().where(F.col(m.REPOSITORY).isNull())
        assert sorted(r[0] for r in found.select(m.UUID).collect()) == ["a", "x"], kind
    assert sorted(tuple(r) for r in maintain.reindex_all(old, new, "r1").select(m.UUID, m.TITLE).collect()) == [
        ("a", "none"), ("b", "old"), ("root", "new"), ("x", "none"),
    ]
    assert maintain.reindex_subtree(old, new, "r1", "root").where(F.col(m.REPOSITORY).isNull()).count() == 2
