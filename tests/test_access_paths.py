"""ACL classes, pages by cursor or by id, and trigrams: the same rows, from less."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from foliosearch import model as m
from foliosearch.functions import predicates as p
from foliosearch.operators.hydrate import hydrate, named_documents
from foliosearch.operators.page import after_cursor, cursor_after, next_page, page, sort_hits
from foliosearch.operators.security import acl_class, acl_class_filter, acl_dictionary, acl_filter, acl_semi_join
from foliosearch.plans.index_table import IndexTable
from foliosearch.plans.infix_index import InfixIndex, literal_stretches
from foliosearch.sources.content import content

FOLDER = "/root/testdata/sf0.001"


def ids(df):
    return sorted(row[0] for row in df.select(m.UUID).collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- ACL classes ------------------------------------------------------------

ACLS = [["x", "y"], ["y", "x", "x"], ["z"], None, [], ["x\x00", "y"], ["x", "\x00y"], ["members"], ["members", "x"], [None, "z"], ["1\x00x"]]


@pytest.fixture(scope="module")
def secured(spark):
    rows = [("default", f"d{k}", acl) for k, acl in enumerate(ACLS * 3)]
    return spark.createDataFrame(rows, f"`{m.REPOSITORY}` string, `{m.UUID}` string, `{m.ACL}` array<string>")


def test_a_class_is_a_set_of_principals(secured):
    found = secured.select(m.ACL, acl_class(F.col(m.ACL)).alias("class")).collect()
    by_class = {}
    for acl, name in found:
        assert (name is None) == (acl is None)
        by_class.setdefault(name, set()).add(None if acl is None else frozenset(x for x in acl if x is not None))
    assert all(len(sets) == 1 for sets in by_class.values())
    assert len(by_class) == len({s for sets in by_class.values() for s in sets})


@pytest.mark.parametrize("names", [["x"], ["z", "q"], ["members", "y"], [], ["nobody"]])
def test_classes_give_the_rows_of_the_acls(spark, secured, names):
    dictionary = acl_dictionary(secured)
    assert dictionary.count() == 8
    table = spark.createDataFrame([(n,) for n in names * 2], "principal string")
    want = ids(acl_filter(secured, names))
    assert ids(acl_class_filter(secured, dictionary, names)) == want
    assert ids(acl_class_filter(secured, dictionary, table)) == want == ids(acl_semi_join(secured, table))


def test_no_pair_of_document_and_principal_is_made(spark, tmp_path):
    """A principal in half of all rows is one entry of the dictionary."""
    index = IndexTable(spark, str(tmp_path / "index"))
    rows = content(spark, FOLDER)
    everyone = F.when(F.xxhash64(m.UUID) % 2 == 0, F.array(F.lit("members"))).otherwise(F.col(m.ACL))
    index.create(rows.withColumn(m.ACL, everyone))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        principals = spark.createDataFrame([("members",), ("user-3",)], "principal string")
        found = acl_class_filter(index.read(), index.acl_classes(), principals)
        text = plan(found.select(m.UUID))
        want = ids(acl_semi_join(index.read(), principals))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert ids(found) == want and len(want) > 80
    # Only the dictionary is exploded, and the index reads the class, not the ACL.
    read = re.findall(r"Location: InMemoryFileIndex.*?/(data|classes)/.*?ReadSchema: struct<(.*?)>(?:\n|$)", text, re.S)
    assert text.count("Generate explode") == 1 and {kind for kind, _ in read} == {"data", "classes"}
    assert all("ecm:acl:" not in columns and "idx:acl_class" in columns for kind, columns in read if kind == "data")
    assert index.acl_classes().count() < 60


# -- pages by cursor --------------------------------------------------------


@pytest.fixture(scope="module")
def tied(spark):
    rows = [
        ("r", f"d{k:03}", s, n, v)
        for k, (s, n, v) in enumerate(itertools.product([None, "a", "b"], [None, 1, 2, 3], [None, 0.5, 1.5, 0.5]))
    ]
    rows += [("q", "d000", "a", 1, None)]  # one id in two repositories
    schema = f"`{m.REPOSITORY}` string, `{m.UUID}` string, `{m.STATE}` string, `{m.POS}` int, score double"
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.mark.parametrize(
    "keys",
    [[], [(m.STATE, True)], [(m.STATE, False), (m.POS, True)], [(m.POS, False), ("dc:absent", True), (m.STATE, False)]],
)
@pytest.mark.parametrize("size", [1, 7, 16, 200])
def test_pages_by_cursor_equal_pages_by_offset(tied, keys, size):
    cursor, number = None, 0
    for number in range(60 if size > 1 else 4):
        by_cursor, by_offset = next_page(tied, cursor, size, keys), page(sort_hits(tied, keys), size, number)
        rows = [tuple(r) for r in by_cursor.collect()]
        assert rows == [tuple(r) for r in by_offset.collect()]
        cursor = cursor_after(by_cursor, keys)
        if cursor is None:
            break
    assert size == 1 or number == -(-49 // size)


def test_a_cursor_reaches_the_scan(spark, tmp_path):
    content(spark, FOLDER).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    text = plan(next_page(rows, [40, "doc-1", "default"], 10, [(m.POS, False)]))
    assert "LessThanOrEqual(ecm:pos,40)" in text.replace("`", "") and "TakeOrderedAndProject(limit=10" in text
    with pytest.raises(ValueError):
        after_cursor(rows, [1], [(m.POS, False)])
    with pytest.raises(ValueError):
        next_page(rows, None, 0)


# -- pages by id ------------------------------------------------------------


def rows_read(df):
    """Rows that the scans of a query gave, after it ran."""
    df.collect()
    plan_ = df._jdf.queryExecution().executedPlan()
    plan_ = plan_.finalPhysicalPlan() if plan_.nodeName() == "AdaptiveSparkPlan" else plan_
    leaves = plan_.collectLeaves()
    total = 0
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        leaf = leaf.plan() if "QueryStage" in leaf.nodeName() else leaf
        if "Scan parquet" in leaf.nodeName():
            total += leaf.metrics().apply("numOutputRows").value()
    return total


def test_a_page_by_id_skips_row_groups(spark, tmp_path):
    """Ids in no order of the files: only the Bloom filters can tell."""
    documents = spark.range(40_000).select(
        F.lit("default").alias(m.REPOSITORY), F.md5(F.col("id").cast("string")).alias(m.UUID), F.md5(F.concat(F.col("id"), F.lit("p"))).alias(m.PATH)
    )
    index = IndexTable(spark, str(tmp_path / "index"), derive=False)
    spark.conf.set("parquet.block.size", str(64 << 10))
    try:
        index.create(documents.repartition(4))
    finally:
        spark.conf.unset("parquet.block.size")
    keys = documents.limit(3).select(*m.KEY)
    found = named_documents(index.read(), spark.createDataFrame(keys.collect(), keys.schema))
    assert rows_read(found) < 20_000 and found.count() == 3
    hits = index.read().select(*m.KEY)
    assert [tuple(r) for r in hydrate(hits, index.read(), 4, 1, by_id=True).select(*m.KEY, "position").collect()] == [
        tuple(r) for r in hydrate(hits, index.read(), 4, 1).select(*m.KEY, "position").collect()
    ]


def test_many_ids_are_met_by_the_join(spark, monkeypatch):
    import foliosearch.operators.hydrate as module

    rows = content(spark, FOLDER)
    monkeypatch.setattr(module, "MOST_IDS", 5)
    keys = rows.select(*m.KEY).limit(20)
    assert named_documents(rows, keys).count() == 20


# -- trigrams ---------------------------------------------------------------

TITLES = ["abc", "xabcx", "ABCD", "a_b%c", "ab", "", None, "abXcd abc", "ΟΔΟΣΑ", "οδος", "İstanbul", "straße", "a\\bc", "aaaaaa", "日本語文"]


@pytest.mark.parametrize(
    "pattern",
    ["%abc%", "abc", "%ABC%", "%ab_cd%", "%a\\_b%", "%\\%c%", "%ab%", "%", "", "%aaaa%", "%ΟΔΟΣ%", "%ΣΑ%", "%stan%", "%raß%", "%本語文%", "abc%abc", "%\\\\bc%"],
)
@pytest.mark.parametrize("any_case", [False, True])
def test_trigrams_lose_no_row(spark, tmp_path, pattern, any_case):
    schema = f"`{m.REPOSITORY}` string, `{m.UUID}` string, `{m.TITLE}` string"
    df = spark.createDataFrame([("r", f"d{k:02}", title) for k, title in enumerate(TITLES)], schema)
    index = InfixIndex(spark, str(tmp_path / "infix"))
    index.build(df)
    plain = p.ilike(m.TITLE, pattern) if any_case else p.like(m.TITLE, pattern)
    assert ids(index.search(df, pattern, any_case=any_case)) == ids(df.where(plain))


def test_stretches_of_a_pattern():
    assert literal_stretches("%ab_c\\%d%%\\\\e") == ["ab", "c%d", "\\e"]


def test_only_the_pattern_s_trigrams_are_read(spark, tmp_path):
    rows = content(spark, FOLDER)
    index = InfixIndex(spark, str(tmp_path / "infix"))
    index.build(rows)
    text = plan(index.candidates("%then%"))
    assert "In(trigram, [hen,the])" in text
    assert index.candidates("%th%") is None
