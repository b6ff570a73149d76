"""Subtrees as ranges of paths: what is found, and what is read."""

import random
import re

import pytest
from pyspark.sql import functions as F

from foliosearch import model as m
from foliosearch.operators import maintain, subtrees
from foliosearch.plans.index_table import IndexTable

SCHEMA = f"`{m.REPOSITORY}` string, `{m.UUID}` string, `{m.PATH}` string, `{m.ANCESTOR_IDS}` array<string>, `{m.TITLE}` string"
COMMANDS = "seq bigint, type string, docId string, repo string, recurse boolean, sync boolean"


def rows(df):
    return sorted(map(repr, df.select(m.REPOSITORY, m.UUID, m.TITLE).collect()))


def odd_tree(seed, size=300, title="t"):
    """Documents whose paths mostly follow their ancestors; some moved, some without a path or ancestors."""
    pick = random.Random(seed)
    names = ["a", "a b", "a-", "é", "日", "z", "\x7f", ""]
    found = []
    for k in range(size):
        ancestors = [f"id{pick.randrange(12)}" for _ in range(pick.randrange(4))]
        path = "/" + "/".join([*(names[int(one[2:]) % 8] for one in ancestors), f"d{k}"])
        if k % 13 == 0:
            path = "/elsewhere/" + str(k)
        found.append((
            [None, "default", "archive", "default"][k % 4],
            f"id{k}" if k < 12 else f"doc{k}",
            None if seed % 2 and k % 29 == 0 else path,
            None if k % 17 == 0 else [*ancestors, None] if k % 19 == 0 else ancestors,
            f"{title}{k}",
        ))
    return found


@pytest.fixture(scope="module", params=[2, 3])
def written(request, spark, tmp_path_factory):
    """An index with a rebuilt repository and a rebuilt subtree; with seed 3, documents without a path."""
    index = IndexTable(spark, str(tmp_path_factory.mktemp("index")), derive=False)
    index.create(spark.createDataFrame(odd_tree(request.param), SCHEMA))
    newer = spark.createDataFrame(odd_tree(request.param + 2, 200, "new"), SCHEMA)
    index.reindex("ALL", newer, "archive")
    index.reindex("ROOT", newer, "default", root_id="id3")
    return index


def test_ranges_find_what_ancestors_say(written):
    held = written.read().cache()
    for root in ("id0", "id3", "id7", "doc50", "nothing"):
        plain = held.where(maintain.in_subtree(root))
        assert rows(written.read().where(written.below(root))) == rows(plain)
        assert rows(written.read().where(written.below(root, "default")).where(F.col(m.REPOSITORY) == "default")) == rows(
            plain.where(F.col(m.REPOSITORY) == "default")
        )
    held.unpersist()


def test_recursive_commands_equal_the_plain_ones(spark, written, tmp_path):
    source = spark.createDataFrame(odd_tree(9, 250, "src"), SCHEMA)
    commands = spark.createDataFrame(
        [
            (1, "DELETE", "id4", "default", True, True),
            (2, "INSERT", "id5", "default", True, True),
            (3, "DELETE", "id6", "archive", True, True),
            (4, "DELETE", "doc40", "default", False, True),
            (5, "DELETE", "absent", "default", True, True),
        ],
        COMMANDS,
    )
    held = written.read()
    plain = maintain.command_changes(maintain.newest_commands(commands, source, held), source)
    expected = rows(maintain.apply_changes(held, plain))
    index = IndexTable(spark, str(tmp_path / "index"), derive=False)
    index.create(held)
    index.apply_commands(commands, source, "one")
    assert rows(index.read()) == expected
    index.compact()
    assert rows(index.read()) == expected
    assert rows(index.read().where(index.below("id5"))) == rows(index.read().where(maintain.in_subtree("id5")))


def test_more_intervals_and_ranges_than_go_into_a_scan(written, monkeypatch):
    plain = rows(written.read().where(maintain.in_subtree("id3")))
    monkeypatch.setattr(subtrees, "MOST_INTERVALS", 1)
    assert rows(written.read().where(written.below("id3"))) == plain


def test_merged_ranges():
    assert subtrees.merged([]) == []
    assert subtrees.merged([("c", "d"), ("a", "b"), ("b", "c")]) == [("a", "d")]
    assert subtrees.merged([("a", "z"), ("b", "c")]) == [("a", "z")]
    many = [(f"{k:03}", f"{k:03}x") for k in range(250)]
    few = subtrees.merged(many, 100)
    assert len(few) <= 100 and few[0][0] == "000" and few[-1][1] == "249x"
    assert all(any(low <= a and b <= high for low, high in few) for a, b in many)


def test_an_index_without_ranges_is_read_by_ancestors(spark, tmp_path):
    """A version that another writer left without them, and a table without paths."""
    index = IndexTable(spark, str(tmp_path / "bare"), derive=False)
    df = spark.createDataFrame(odd_tree(4, 60), SCHEMA)
    index.create(df.drop(m.PATH))
    assert index.subtrees() is None
    assert rows(index.read().where(index.below("id1"))) == rows(df.where(maintain.in_subtree("id1")))
    empty = IndexTable(spark, str(tmp_path / "empty"), derive=False)
    empty.create(df.where(F.lit(False)))
    assert empty.subtrees().count() == 0 and empty.read().where(empty.below("id1")).count() == 0


def test_the_range_reaches_the_scan_and_skips_row_groups(spark, tmp_path):
    """One folder out of 500: of the files that the index has, one or two have rows to give."""
    folder = F.format_string("f%03d", F.col("id") % 500)
    df = spark.range(0, 20_000, 1, 8).select(
        F.lit("default").alias(m.REPOSITORY), F.format_string("u%05d", "id").alias(m.UUID),
        F.concat(F.lit("/top/"), folder, F.lit("/"), F.col("id").cast("string")).alias(m.PATH),
        F.array(F.lit("top"), folder).alias(m.ANCESTOR_IDS), F.lit("t").alias(m.TITLE),
    ).repartitionByRange(8, m.PATH)
    index = IndexTable(spark, str(tmp_path / "index"), derive=False)
    index.create(df)
    assert index.subtrees().count() == 501
    found = index.read().where(index.below("f123"))
    assert found.count() == 40
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    (pushed,) = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan)
    pushed = pushed.replace("`", "")
    assert "GreaterThanOrEqual(ecm:path,/top/f123/" in pushed and "LessThanOrEqual(ecm:path,/top/f123/" in pushed
    # Without the row's own test: what the scan's row groups let through.
    read = index.read().where(F.input_file_name() != "").select(F.input_file_name().alias("file"), m.PATH)
    files = read.where((F.col(m.PATH) >= "/top/f123/") & (F.col(m.PATH) <= "/top/f123/~")).select("file").distinct().count()
    assert files <= 2


def test_intervals_are_counted_inside_the_tasks(spark):
    df = spark.createDataFrame(odd_tree(2), SCHEMA)
    plan = subtrees.subtree_intervals(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_min" in plan
