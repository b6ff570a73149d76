"""Physical plans: what reaches the scan, what is shuffled, what is broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from checks.catalog import QUERIES
from foliosearch import model as m
from foliosearch.functions import predicates as p
from foliosearch.operators import analysis
from foliosearch.operators.analysis import analyze, analyzed_terms, document_postings, postings, term_statistics
from foliosearch.operators.envelope import project_schemas
from foliosearch.operators.facets import date_histogram_facet, facets, terms_facet
from foliosearch.operators.fields import derive_fields
from foliosearch.operators.fulltext import fulltext_match, fulltext_query
from foliosearch.operators.maintain import command_changes
from foliosearch.operators.page import page, page_info, sort_hits
from foliosearch.operators.relevance import field_postings, score_text
from foliosearch.operators.security import acl_filter
from foliosearch.plans import term_index
from foliosearch.plans.index_table import IndexTable
from foliosearch.plans.search import Search
from foliosearch.plans.term_index import TermIndex
from foliosearch.sources.content import content, in_repository, table

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan as adaptive execution left it."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def pushed(df):
    return re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan(df))


def read_columns(df):
    return re.findall(r"ReadSchema: struct<(.*?)>(?:\n|$)", plan(df))


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    table_ = IndexTable(spark, str(tmp_path_factory.mktemp("index")))
    table_.create(content(spark, FOLDER))
    yield table_
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize(
    "predicate, filters",
    [
        (lambda: p.starts_with_path("/src1"), ["Or(EqualTo(ecm:path,/src1),StringStartsWith(ecm:path,/src1/))"]),
        (lambda: p.state_is_not("deleted"), ["Not(EqualNullSafe(ecm:currentLifeCycleState,deleted))"]),
        (lambda: p.not_in(m.STATE, ["a", "b"]), ["Or(IsNull(ecm:currentLifeCycleState),Not(In(ecm:currentLifeCycleState"]),
        (lambda: p.is_in(m.PRIMARY_TYPE, ["Note", "File"]), ["In(ecm:primaryType, [File,Note])"]),
        (lambda: p.between_dates(m.ISSUED, "2019-05-31", "2019-06-02"), ["GreaterThanOrEqual(dc:issued", "LessThan(dc:issued"]),
        (lambda: p.between_dates(m.MODIFIED, "2019-05-31", "2019-06-02"), ["GreaterThanOrEqual(dc:modified", "LessThan(dc:modified"]),
        (lambda: p.flag(m.IS_PROXY, 0), ["Not(EqualTo(ecm:isProxy,true))"]),
    ],
)
def test_predicates_reach_the_scan(index, predicate, filters):
    found = " ".join(pushed(index.read().where(predicate()).select(m.UUID))).replace("`", "")
    for wanted in filters:
        assert wanted in found


def test_repository_is_a_partition_filter(index):
    text = plan(in_repository(index.read(), "archive").select(m.UUID))
    assert re.search(r"PartitionFilters: \[isnotnull\(ecm:repository#\d+\), \(ecm:repository#\d+ = archive\)\]", text)


def test_projection_reads_its_columns_only(index):
    (columns,) = read_columns(project_schemas(index.read(), ["dc"]).select(m.TITLE))
    assert columns == "dc:title:string"
    (counted,) = read_columns(page_info(index.read().where(p.flag(m.IS_PROXY, 0)), 10, 0))
    assert counted == "ecm:isProxy:boolean"


def test_label_join_vanishes_where_no_state_is_read(spark):
    assert "labels" not in plan(content(spark, FOLDER).select(m.TITLE))
    assert "labels" in plan(content(spark, FOLDER).select(m.STATE))


def test_search_on_an_index_shuffles_nothing(spark, index):
    """Predicates, full text and ACL in the scan stage, then a distributed top-k."""
    query = fulltext_query(spark, "the on")
    found = index.read().where(fulltext_match(query, m.ALL_TERMS) & p.state_is_not("deleted"))
    hits = page(sort_hits(acl_filter(found, ["members"]), [(m.TITLE, True)]), 10, 2).select(m.UUID)
    text = plan(hits)
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert "idx:title_lowercase" in read_columns(hits)[0] and "note:note" not in read_columns(hits)[0]


def test_analysis_neither_shuffles_nor_leaves_the_jvm(spark):
    documents = table(spark, FOLDER, "documents")
    for df in (
        analyze(documents, ["doc_id"], "text", "fulltext"),
        documents.select(analyzed_terms(F.col("text"), "en")),
    ):
        text = plan(df)
        assert "Exchange" not in text and "Python" not in text
        assert "PushedFilters: []" in text and "lang" not in read_columns(df)[0]


def test_statistics_combine_before_each_shuffle(spark):
    df = term_statistics(postings(analyze(table(spark, FOLDER, "documents"), ["doc_id"], "text", "en"), ["doc_id"]))
    text = plan(df)
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("partial_count(1)") == 2


def test_postings_shuffle_texts_only(spark):
    documents = table(spark, FOLDER, "documents")
    for df in (
        document_postings(documents, ["doc_id"], "text", "en"),
        field_postings(content(spark, FOLDER), m.KEY),
    ):
        text = plan(df)
        assert text.count("Exchange") == 1 and "REPARTITION_BY_NUM" in text


def test_scores_analyse_the_corpus_once(spark):
    text = final_plan(score_text(content(spark, FOLDER), [m.UUID], ["the", "on"]))
    assert "ReusedExchange" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_facets_are_one_pass(spark):
    orders = table(spark, FOLDER, "orders")
    wanted = [terms_facet("status", "o_orderstatus", 3), date_histogram_facet("month", "o_orderdate", "month")]
    text = plan(facets(orders, wanted))
    assert text.count("FileScan") == 1
    assert text.count("WindowGroupLimit") == 2, "values are cut inside the tasks first"
    assert "partial_count(1)" in text


def test_small_changes_do_not_shuffle_the_index(spark, tmp_path):
    index = IndexTable(spark, str(tmp_path / "index"), derive=False)
    index.create(content(spark, FOLDER))
    commands = spark.createDataFrame([(1, "DELETE", "doc-3", "default", False, True)],
                                     "seq bigint, type string, docId string, repo string, recurse boolean, sync boolean")
    index.apply_commands(commands, content(spark, FOLDER), "one", recursive=False)
    text = plan(index.read())
    scan = text.index("/data/n=1")
    anti = text.index("BroadcastHashJoin")
    assert "LeftAnti" in text and anti < scan
    assert "Exchange" not in text[anti:scan].replace("BroadcastExchange", "")


def test_term_index_reads_the_terms_of_the_query_only(spark, tmp_path):
    index = TermIndex(spark, str(tmp_path / "terms"))
    index.build(content(spark, FOLDER))
    scores = index.scores(fulltext_query(spark, "then attion"))
    filters = pushed(scores)
    assert len(filters) == 2 and all("In(term, [attion,then])" in text for text in filters)
    matched = plan(index.ranked(fulltext_query(spark, "then attion -thre")))
    assert matched.count("/postings/") == 1, "the match and the score of a document are decided together"
    assert matched.count("Exchange hashpartitioning") == 1 + matched.count("/statistics/")
    assert "BroadcastHashJoin" in plan(scores) and "NestedLoop" not in plan(scores)


def test_index_files_are_sorted_by_path(spark, index):
    """No extra shuffle for it, and one sort only."""
    files = index.read().select(F.input_file_name().alias("file"), m.PATH, F.monotonically_increasing_id().alias("at"))
    for file in {row.file for row in files.collect()}:
        paths = [row[m.PATH] for row in files.where(F.col("file") == file).orderBy("at").collect()]
        assert paths == sorted(paths)


def test_a_feed_derives_only_what_it_names(spark, tmp_path):
    """The analysis stands above the join that picks the documents."""
    index = IndexTable(spark, str(tmp_path / "index"))
    newest = spark.createDataFrame([("default", "doc-1", "INSERT")], "repository string, uuid string, type string")
    newest = newest.toDF(*m.KEY, "type")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        tree = plan(command_changes(newest, content(spark, FOLDER), index._indexed)).split("\n")
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    deep = {kind: [len(x) - len(x.lstrip(" :+-*()0123456789")) for x in tree if kind in x] for kind in ("LeftSemi", "regexp_replace")}
    assert deep["LeftSemi"] and deep["regexp_replace"] and max(deep["regexp_replace"]) < min(deep["LeftSemi"])


def test_reads_after_rebuilds_prune_columns_and_push_filters(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    index = IndexTable(spark, str(tmp_path / "index"), derive=False)
    rows = content(spark, FOLDER)
    index.create(rows)
    for kind in ("Note", "File"):
        index.reindex("QUERY", rows, "default", predicate=p.equals(m.PRIMARY_TYPE, kind))
    found = index.read().where(F.col(m.TITLE) == "x").select(m.UUID)
    changed = [x for x in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>(?:\n|$)", plan(found)) if "change_seq" in x[1]]
    assert changed and all("note:note" not in columns for _, columns in changed)
    assert any("EqualTo(`dc:title`,x)" in filters for filters, _ in changed)
    assert "max_by" not in plan(found)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def exchanged(text):
    """The columns of what each shuffle moves, by name."""
    return [set(re.findall(r"([\w:]+)#\d+", line)) for line in re.findall(r"Exchange (?:hash|range)partitioning.*\n(.*)", text)]


def test_a_ranked_search_moves_keys_scores_and_sort_columns(spark, index, tmp_path):
    """With the ranked side too large to broadcast."""
    terms = TermIndex(spark, str(tmp_path / "terms"))
    terms.build(index.read())
    search = Search(
        predicate=p.state_is_not("deleted"),
        fulltext=fulltext_query(spark, "then attion"),
        terms=terms,
        principals=["members"],
        sort=[(m.TITLE, True)],
        page_size=5,
    )
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        narrow = search.matches(index.read()).select(*m.KEY, "score", m.TITLE_LOWERCASE)
        moved = set().union(*exchanged(plan(narrow)))
        cut = plan(page(sort_hits(narrow, search.sort), search.page_size))  # run at once; its ids are literals below
        text = plan(search.hits(index.read()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "TakeOrderedAndProject" in cut
    assert "TakeOrderedAndProject" not in text and re.search(rf"{m.UUID}#\d+ IN \(", text)
    stored = set(index.read().columns) - {*m.KEY, m.TITLE_LOWERCASE}
    assert moved and not moved & stored, moved & stored


def test_analysis_tasks_follow_the_size_of_the_input(spark, monkeypatch):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet")
    monkeypatch.setattr(analysis, "TEXT_BYTES", 1 << 10)
    many = analysis.by_document(rows, ["doc_id"]).rdd.getNumPartitions()
    monkeypatch.setattr(analysis, "TEXT_BYTES", 1 << 40)
    few = analysis.by_document(rows, ["doc_id"]).rdd.getNumPartitions()
    assert many > 50 and few == 2 * spark.sparkContext.defaultParallelism


def test_term_frequencies_of_a_corpus_are_counted_in_tasks_that_follow_its_size(spark, monkeypatch):
    monkeypatch.setattr(analysis, "TEXT_BYTES", 1 << 10)
    assert QUERIES["t15_term_frequencies"](spark, FOLDER).rdd.getNumPartitions() > 50


def test_a_whole_build_shuffles_texts_only(spark, monkeypatch, tmp_path):
    """Catalyst moves constants among grouping keys; a constant sign there had all postings shuffled twice."""
    found = []

    def noted(*args):
        found.append(field_postings(*args))
        return found[-1]

    monkeypatch.setattr(term_index, "field_postings", noted)
    TermIndex(spark, str(tmp_path / "terms")).build(content(spark, FOLDER))
    assert [plan(posted).count("Exchange") for posted in found] == [1]


def test_index_terms_take_each_word_of_a_document_once(spark):
    """Words are told apart first; then each is analysed once, also where several fields have it."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        lines = [x for x in plan(derive_fields(content(spark, FOLDER))).split("\n") if "Project [" in x]
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    analysed = [x for x in lines if "array_except" in x]
    assert len(analysed) == 1 and "regexp_extract_all" not in analysed[0]


def test_stems_are_compared_and_not_matched(spark):
    assert "é?e?r?s?" not in plan(analyze(table(spark, FOLDER, "documents"), ["doc_id"], "text", "fulltext"))
