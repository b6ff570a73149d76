"""Postings that follow an index table equal those of a fresh build."""

import pytest
from pyspark.sql import functions as F

from foliosearch import model as m
from foliosearch.operators import maintain
from foliosearch.operators.fulltext import fulltext_query
from foliosearch.plans.index_table import IndexTable
from foliosearch.plans.term_index import TermIndex

COLUMNS = ", ".join(f"`{c}` {t}" for c, t in (
    (m.REPOSITORY, "string"), (m.UUID, "string"), (m.ANCESTOR_IDS, "array<string>"),
    (m.TITLE, "string"), (m.DESCRIPTION, "string"), (m.NOTE, "string"),
))


def documents(spark, *rows):
    """Documents (id, title, note)."""
    return spark.createDataFrame([("default", id_, ["root"], title, None, note) for id_, title, note in rows], COLUMNS)


OLD = [("a", "red fox", "fox fox hound"), ("b", "blue bird", "fox"), ("c", "hound", None), ("d", None, "quiet fox bird")]
NEW = [("a", "red fox", "fox fox hound"), ("b", "blue fox", "bird bird"), ("e", "fox hound", "hound fox"), ("d", None, None)]


def held(terms):
    from foliosearch.operators.relevance import net_postings

    rows = net_postings(terms.postings()).select(m.UUID, "field", "term", "tf", "length").collect()
    frequencies = terms.statistics().groupBy("field", "term").agg(F.sum("df").alias("df")).where("df <> 0").collect()
    return sorted(tuple(r) for r in rows), sorted(tuple(r) for r in frequencies), terms.total()


def ranked(spark, terms, text):
    return sorted((r[m.UUID], r.score) for r in terms.ranked(fulltext_query(spark, text)).collect())


@pytest.fixture
def index(spark, tmp_path):
    table = IndexTable(spark, str(tmp_path / "index"), derive=False)
    table.create(documents(spark, *OLD))
    return table


def fresh(spark, index, tmp_path, name):
    terms = TermIndex(spark, str(tmp_path / name))
    terms.build(index.read())
    return terms


def test_following_equals_a_fresh_build(spark, tmp_path, index):
    terms = TermIndex(spark, str(tmp_path / "terms"))
    terms.follow(index)
    source = documents(spark, *NEW)
    commands = [(1, "DELETE", "c"), (2, "INSERT", "b"), (3, "INSERT", "a"), (4, "INSERT", "e")]
    told = spark.createDataFrame([(*c, "default", False, True) for c in commands], maintain.COMMAND_SCHEMA)
    index.apply_commands(told, source, "1")
    terms.follow(index)
    assert held(terms) == held(fresh(spark, index, tmp_path, "one"))
    # A document that came with the same text has no posting of its own in the difference.
    assert "a" not in {r[m.UUID] for r in terms.postings().where("sign < 0").collect()}
    index.reindex("QUERY", source, "default", predicate=F.lit(True))
    index.reindex("ALL", documents(spark, *NEW[:3], ("z", "fox", "zebra")), "default")
    terms.follow(index)
    again = fresh(spark, index, tmp_path, "two")
    assert held(terms) == held(again)
    for text in ("fox", "fox -hound", "bird fox", "zebra", "-fox", "nothing"):
        assert ranked(spark, terms, text) == ranked(spark, again, text)
    assert ranked(spark, terms, "fox") and not ranked(spark, terms, "quiet")
    before, lines = held(terms), len(terms.commits())
    terms.follow(index)  # nothing new
    assert len(terms.commits()) == lines
    terms.fold()
    assert held(terms) == before and len(terms.commits()) == 1
    assert terms.postings().where("sign < 0").count() == 0


def test_a_folded_table_is_analysed_anew(spark, tmp_path, index):
    terms = TermIndex(spark, str(tmp_path / "terms"))
    terms.follow(index)
    index.reindex("QUERY", documents(spark, *NEW), "default", predicate=F.lit(True))
    index.compact()
    terms.follow(index)
    assert held(terms) == held(fresh(spark, index, tmp_path, "one"))
    assert len(terms.commits()) == 1 and terms.commits()[0].followed == index.version()
    index.compact()
    terms.follow(index)
    assert held(terms) == held(fresh(spark, index, tmp_path, "two"))


def test_a_whole_write_replaces_what_was_there_at_once(spark, tmp_path, index):
    """Its line counts before the older ones are gone."""
    terms = fresh(spark, index, tmp_path, "terms")
    want = held(terms)
    terms._forget_replaced = lambda: None  # the writer dies here
    terms.fold()
    assert held(terms) == want
    terms.build(documents(spark, *NEW))
    assert held(terms)[2] == len(NEW)


def test_no_term_index(spark, tmp_path):
    with pytest.raises(ValueError):
        TermIndex(spark, str(tmp_path / "none")).total()


def test_a_field_that_stays_the_same_is_not_analysed_again(spark, tmp_path, index):
    """A new title brings postings of the title, not of the note."""
    terms = TermIndex(spark, str(tmp_path / "terms"))
    terms.follow(index)
    source = documents(spark, ("a", "green fox", "fox fox hound"), ("b", "blue bird", "bird"), ("d", "calm", "quiet fox bird"))
    index.reindex("QUERY", source, "default", predicate=F.lit(True))
    terms.follow(index)
    came = spark.read.parquet(f"{terms.path}/postings/n=2")
    assert {(r[m.UUID], r.field) for r in came.collect()} == {("a", m.TITLE), ("b", m.NOTE), ("d", m.TITLE)}
    assert held(terms) == held(fresh(spark, index, tmp_path, "one"))


def test_a_difference_of_keys_that_come_twice(spark):
    """Texts that only change places among rows of one key add nothing; else all of a field's rows count."""
    from foliosearch.operators.relevance import difference_postings

    rows = [
        ("k", "red", "fox", -1), ("k", "blue", "owl", -1), ("k", "green", "owl", 1), ("k", "blue", "fox", 1),
        ("l", None, "fox", -2), ("l", "red", "fox", 2), (None, "red", None, -1), (None, "red", "fox", 1),
    ]
    df = spark.createDataFrame(rows, f"id string, `{m.TITLE}` string, `{m.NOTE}` string, sign int")
    posted = difference_postings(df, ["id"], [m.TITLE, m.NOTE])
    assert posted._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    found = {(r.id, r.field, r.term, r.sign, r.tf, r.length) for r in posted.collect()}
    assert found == {
        ("k", m.TITLE, "red", -1, 1, 2), ("k", m.TITLE, "blue", -1, 1, 2),
        ("k", m.TITLE, "green", 1, 1, 2), ("k", m.TITLE, "blue", 1, 1, 2),
        ("l", m.TITLE, "red", 2, 1, 1), (None, m.NOTE, "fox", 1, 1, 1),
    }


def test_postings_of_a_term_are_in_the_order_of_document_ids(spark, tmp_path):
    """Most documents share a repository, so ids are compared before it."""
    rows = [("default", "a"), ("archive", "b"), ("default", "c"), ("archive", "d")]
    df = spark.createDataFrame([(r, id_, ["root"], "fox", None, None) for r, id_ in rows], COLUMNS)
    terms = TermIndex(spark, str(tmp_path / "terms"))
    terms.build(df)
    parts = terms.postings().rdd.glom().map(lambda part: [r[m.UUID] for r in part]).collect()
    assert all(part == sorted(part) for part in parts) and sorted(sum(parts, [])) == list("abcd")
    assert max(len(part) for part in parts) > 1


def test_a_write_sorts_postings_by_term_in_files_of_whole_documents(spark, tmp_path, index):
    """Postings stay where their texts were dealt: no document is spread over files, and few documents fill one."""
    texts = [f"w{n % 7} w{n % 11} w{n % 13} x{n}" for n in range(600)]
    terms = TermIndex(spark, str(tmp_path / "terms"))
    terms.build(documents(spark, *[(f"d{n}", text, text) for n, text in enumerate(texts)]))
    files = {}
    for row in terms.postings().withColumn("file", F.input_file_name()).collect():
        files.setdefault(row.file, []).append((row.term, row.field, row[m.UUID]))
    assert 1 < len(files) <= 5 and all(rows == sorted(rows) for rows in files.values())
    held_by = [{id_ for _, _, id_ in rows} for rows in files.values()]
    assert sum(map(len, held_by)) == len(set.union(*held_by)) == 600
    frequencies = terms.statistics().where("term = 'w0'").collect()
    assert [(r.field, r.df) for r in sorted(frequencies)] == [(f, sum("w0" in t.split() for t in texts)) for f in (m.TITLE, m.NOTE)]
    terms = fresh(spark, index, tmp_path, "few")
    assert len({row.file for row in terms.postings().select(F.input_file_name().alias("file")).collect()}) == 1


def test_a_write_reads_its_postings_from_no_other_place(spark, tmp_path, index, monkeypatch):
    """They were staged, sampled and shuffled for ranges of terms before."""
    from foliosearch.plans import term_index

    labels = []
    monkeypatch.setattr(term_index, "scratch_path", lambda spark, label: labels.append(label) or str(tmp_path / f"scratch-{len(labels)}"))
    terms = fresh(spark, index, tmp_path, "terms")
    terms.fold()
    assert "postings" not in labels and terms.total() == len(OLD)


def test_a_query_needs_no_dictionary_of_all_terms(spark, tmp_path, index):
    """Pages of sorted terms are told by their bounds."""
    import pyarrow.parquet as pq

    path = next((tmp_path / "terms" / "postings").rglob("*.parquet")) if fresh(spark, index, tmp_path, "terms") else None
    group = pq.ParquetFile(path).metadata.row_group(0)
    columns = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
    assert not columns["term"].has_dictionary_page and columns["field"].has_dictionary_page and columns["term"].has_column_index
