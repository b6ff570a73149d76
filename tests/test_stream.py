"""The change feed: newest command wins, batches apply once."""

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


def command(seq, kind, doc_id, recurse=False):
    return {"seq": seq, "type": kind, "docId": doc_id, "repo": "default", "recurse": recurse, "sync": True}


def drop(folder, name, *commands):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(line) for line in commands))


@pytest.fixture
def index(spark, tmp_path):
    table = IndexTable(spark, str(tmp_path / "index"), derive=False)
    table.create(documents(spark, ("root", [], "old root"), ("a", ["root"], "old a"), ("b", ["root"], "old b")))
    return table


@pytest.fixture
def source(spark):
    return documents(spark, ("root", [], "root"), ("a", ["root"], "a"), ("b", ["root"], "b"), ("c", ["root"], "c"))


def test_newest_command_wins_over_batches(spark, tmp_path, index, source):
    feed, checkpoint = tmp_path / "feed", str(tmp_path / "checkpoint")
    drop(feed, "1.json", command(1, "INSERT", "a"), command(2, "DELETE", "a"), command(3, "INSERT", "c"))
    maintain_index(read_commands(spark, str(feed)), source, index, "feed", checkpoint=checkpoint)
    assert titles(index.read()) == {"root": "old root", "b": "old b", "c": "c"}
    # The same stream goes on: a later batch overrules the earlier one.
    drop(feed, "2.json", command(4, "INSERT", "a"), command(5, "DELETE", "missing"))
    maintain_index(read_commands(spark, str(feed)), source, index, "feed", checkpoint=checkpoint)
    assert titles(index.read()) == {"root": "old root", "a": "a", "b": "old b", "c": "c"}
    index.compact()
    assert titles(index.read()) == {"root": "old root", "a": "a", "b": "old b", "c": "c"}


def test_a_new_stream_is_not_taken_for_a_replay(spark, tmp_path, index, source):
    feed = tmp_path / "feed"
    drop(feed, "1.json", command(1, "INSERT", "a"))
    maintain_index(read_commands(spark, str(feed)), source, index, "feed", checkpoint=str(tmp_path / "one"))
    other = tmp_path / "other"
    drop(other, "1.json", command(1, "INSERT", "b"))
    maintain_index(read_commands(spark, str(other)), source, index, "feed", checkpoint=str(tmp_path / "two"))
    assert titles(index.read()) == {"root": "old root", "a": "a", "b": "b"}


def test_replayed_batch_applies_once(spark, index, source):
    commands = spark.createDataFrame([command(1, "DELETE", "a")], maintain.COMMAND_SCHEMA)
    index.apply_commands(commands, source, "batch 0")
    index.apply_commands(commands, source, "batch 0")
    assert [line.kind for line in index.commits()] == ["data", "changes"]
    assert "a" not in titles(index.read())


def test_half_written_changes_are_invisible_and_redone(spark, index, source):
    """A writer died after its files and before its commit line."""
    orphan = documents(spark, ("x", [], "x")).withColumn(maintain.CHANGE, F.lit("INSERT"))
    orphan = orphan.withColumn(maintain.SEQUENCE, F.lit(2).cast("long"))
    orphan.write.parquet(f"{index.path}/changes/n=2")
    assert "x" not in titles(index.read())
    commands = spark.createDataFrame([command(1, "INSERT", "c")], maintain.COMMAND_SCHEMA)
    index.apply_commands(commands, source, "batch 0")
    assert titles(index.read()) == {"root": "old root", "a": "old a", "b": "old b", "c": "c"}


def test_recursive_commands(spark, index, source):
    deletion = spark.createDataFrame(
        [command(1, "DELETE", "root", True), command(2, "INSERT", "a")], maintain.COMMAND_SCHEMA
    )
    index.apply_commands(deletion, source, "delete")
    assert titles(index.read()) == {"a": "a"}
    insertion = spark.createDataFrame([command(3, "INSERT", "root", True)], maintain.COMMAND_SCHEMA)
    index.apply_commands(insertion, source, "insert")
    assert titles(index.read()) == {"root": "root", "a": "a", "b": "b", "c": "c"}


def test_background_feed(spark, tmp_path, index, source):
    feed = tmp_path / "feed"
    drop(feed, "1.json", command(1, "DELETE", "b"))
    query = maintain_index(
        read_commands(spark, str(feed)), source, index, "feed", sync=False, interval="1 second",
        checkpoint=str(tmp_path / "checkpoint"),
    )
    try:
        query.processAllAvailable()
        drop(feed, "2.json", command(2, "DELETE", "a"))
        query.processAllAvailable()
    finally:
        query.stop()
    assert titles(index.read()) == {"root": "old root"}
