"""Relevance."""

from pyspark.sql import functions as F

from checks.base import content_sql, query
from checks.maintenance import COMMANDS_SQL, commands
from checks.textsql import term_views
from foliosearch import model as m
from foliosearch.functions import predicates as p
from foliosearch.operators.fulltext import fulltext_query
from foliosearch.operators.page import page, sort_hits
from foliosearch.operators.relevance import score_text
from foliosearch.operators.security import acl_filter
from foliosearch.plans.index_table import IndexTable
from foliosearch.plans.search import Search, ranked_hits
from foliosearch.plans.term_index import TermIndex
from foliosearch.session import scratch_path
from foliosearch.sources.content import content
from foliosearch.sources.files import write_raw

QUERY_TEXT = "ering thtion attion"
TERMS_SQL = "'ering', 'thtion', 'attion'"

NOTE_SCORES = [
    *term_views("content", "uuid", "note", "fr"),
    ("lengths", "SELECT uuid, count(*) AS len FROM terms GROUP BY uuid"),
    ("tfs", f"SELECT uuid, term, count(*) AS tf FROM terms WHERE term IN ({TERMS_SQL}) GROUP BY uuid, term"),
    ("dfs", "SELECT term, count(*) AS df FROM tfs GROUP BY term"),
    ("corpus", "SELECT count(*) AS total FROM content"),
    (
        "scores",
        """
        SELECT uuid, round(sum(sqrt(tf) * power(1 + ln(total / (df + 1)), 2) / sqrt(len)), 6) AS score
        FROM tfs JOIN dfs USING (term) JOIN lengths USING (uuid), corpus GROUP BY uuid
        """,
    ),
]


@query(content_sql("SELECT uuid, score FROM scores", *NOTE_SCORES))
def r1_score(spark, folder):
    terms = fulltext_query(spark, QUERY_TEXT).required_terms
    scored = score_text(content(spark, folder, spread=True), [m.UUID], terms, {m.NOTE: 1.0})
    return scored.withColumnRenamed(m.UUID, "uuid")


def field_terms(rows="content"):
    return [
        (
            "fields",
            f"""
            SELECT uuid, 'dc:title' AS field, 2.0 AS boost, title AS text FROM {rows}
            UNION ALL SELECT uuid, 'dc:description', 1.5, description FROM {rows}
            UNION ALL SELECT uuid, 'note:note', 1.0, note FROM {rows}
            """,
        ),
        *term_views("fields", "uuid, field, boost", "text", "fr"),
    ]


FIELD_TERMS = field_terms()


def boosted_scores(terms_sql, rows="content"):
    return [
        *field_terms(rows),
        ("lengths", "SELECT uuid, field, count(*) AS len FROM terms GROUP BY uuid, field"),
        (
            "tfs",
            f"SELECT uuid, field, boost, term, count(*) AS tf FROM terms WHERE term IN ({terms_sql}) "
            "GROUP BY uuid, field, boost, term",
        ),
        ("dfs", "SELECT field, term, count(*) AS df FROM tfs GROUP BY field, term"),
        ("corpus", f"SELECT count(*) AS total FROM {rows}"),
        (
            "scores",
            """
            SELECT uuid, round(sum(sqrt(tf) * power(1 + ln(total / (df + 1)), 2) * CAST(boost AS DOUBLE) / sqrt(len)), 6)
              AS score
            FROM tfs JOIN dfs USING (field, term) JOIN lengths USING (uuid, field), corpus GROUP BY uuid
            """,
        ),
    ]


BOOSTED_SCORES = boosted_scores(TERMS_SQL)


@query(content_sql("SELECT uuid, score FROM scores", *BOOSTED_SCORES))
def r2_field_boosts(spark, folder):
    terms = fulltext_query(spark, QUERY_TEXT).required_terms
    return score_text(content(spark, folder, spread=True), [m.UUID], terms).withColumnRenamed(m.UUID, "uuid")


@query(content_sql("SELECT uuid, score FROM scores", *BOOSTED_SCORES))
def r2_scores_from_term_index(spark, folder):
    """The same scores from postings on disk."""
    index = TermIndex(spark, scratch_path(spark, "terms"))
    index.build(content(spark, folder))
    scored = index.scores(fulltext_query(spark, QUERY_TEXT))
    return scored.select(F.col(m.UUID).alias("uuid"), "score")


@query(
    content_sql(
        """
        SELECT DISTINCT uuid FROM terms a JOIN terms b USING (uuid) WHERE a.term = 'ering' AND b.term = 'attion'
        AND uuid NOT IN (SELECT uuid FROM terms WHERE term = 'thti')
        """,
        *FIELD_TERMS,
    )
)
def f18_fulltext_from_term_index(spark, folder):
    """Matches in any of the fields, from postings on disk."""
    index = TermIndex(spark, scratch_path(spark, "terms"))
    index.build(content(spark, folder))
    return index.keys(fulltext_query(spark, "ering attion -thti")).select(F.col(m.UUID).alias("uuid"))


@query(
    content_sql(
        """
        SELECT uuid, score FROM scores JOIN content USING (uuid)
        WHERE list_has_any(acl, ['members', 'user-3']) ORDER BY score DESC, uuid LIMIT 20
        """,
        *BOOSTED_SCORES,
    )
)
def r3_acl_leaves_scores(spark, folder):
    """Scores of the whole corpus; the ACL only filters, then the best 20."""
    terms = fulltext_query(spark, QUERY_TEXT).required_terms
    scored = score_text(content(spark, folder, spread=True), m.KEY, terms)
    readable = acl_filter(content(spark, folder), ["members", "user-3"]).select(*m.KEY)
    best = page(sort_hits(scored.join(readable, m.KEY, "left_semi")), 20)
    return best.select(F.col(m.UUID).alias("uuid"), "score")


# Two words, and one that no hit may have; the scores are those of the two.
MATCH_TEXT = "thre ble -wh"
MATCHES = [
    *boosted_scores("'thre', 'ble'"),
    (
        "matching",
        """
        SELECT DISTINCT uuid FROM terms a JOIN terms b USING (uuid) WHERE a.term = 'thre' AND b.term = 'ble'
        AND uuid NOT IN (SELECT uuid FROM terms WHERE term = 'wh')
        """,
    ),
    (
        "ranked",
        """
        SELECT uuid, score, title, note FROM scores JOIN content USING (uuid) JOIN matching USING (uuid)
        WHERE list_has_any(acl, ['members', 'user-3']) AND primary_type <> 'Folder'
        """,
    ),
]


@query(
    content_sql(
        """
        SELECT row_number() OVER (ORDER BY score DESC, uuid) AS position, uuid, score, title, md5(note) AS note_md5
        FROM (SELECT * FROM ranked ORDER BY score DESC, uuid LIMIT 3 OFFSET 3)
        """,
        *MATCHES,
    )
)
def ranked_search_raw_hits(spark, folder):
    """Second page of a full-text search by score, for one caller, through the
    raw sink: term index, matches, scores, predicate, ACL, top-k, full documents."""
    rows = content(spark, folder)
    terms = TermIndex(spark, scratch_path(spark, "terms"))
    terms.build(rows)
    wanted = fulltext_query(spark, MATCH_TEXT)
    kind = p.not_equals(m.PRIMARY_TYPE, "Folder")
    hits = ranked_hits(rows, terms, wanted, ["members", "user-3"], predicate=kind, page_size=3, page_index=1)
    path = scratch_path(spark, "raw")
    write_raw(hits, path)
    back = spark.read.schema(hits.schema).json(path)
    return back.select(
        F.col("position").cast("long").alias("position"),
        F.col(m.UUID).alias("uuid"),
        "score",
        F.col(m.TITLE).alias("title"),
        F.md5(m.NOTE).alias("note_md5"),
    )


@query(content_sql("SELECT uuid, score, title, (SELECT count(*) FROM ranked) AS total FROM ranked", *MATCHES))
def o4_search_by_score(spark, folder):
    """The same search as a whole: all its hits, and how many it says there are."""
    rows = content(spark, folder)
    terms = TermIndex(spark, scratch_path(spark, "terms"))
    terms.build(rows)
    search = Search(
        predicate=p.not_equals(m.PRIMARY_TYPE, "Folder"),
        fulltext=fulltext_query(spark, MATCH_TEXT),
        terms=terms,
        principals=["members", "user-3"],
    )
    total = search.total(rows).scalar()
    return search.hits(rows).select(
        F.col(m.UUID).alias("uuid"), "score", F.col(m.TITLE).alias("title"), total.alias("total")
    )


@query(content_sql("SELECT uuid, score, title, md5(note) AS note_md5 FROM ranked ORDER BY score DESC, uuid LIMIT 4 OFFSET 2", *MATCHES))
def o4_page_of_ranked_search(spark, folder):
    """A page of the search: keys and scores move, documents are fetched for the page."""
    rows = content(spark, folder)
    terms = TermIndex(spark, scratch_path(spark, "terms"))
    terms.build(rows)
    search = Search(
        predicate=p.not_equals(m.PRIMARY_TYPE, "Folder"),
        fulltext=fulltext_query(spark, MATCH_TEXT),
        terms=terms,
        principals=["members", "user-3"],
        page_size=2,
        page_index=1,
    )
    later = Search(**{**search.__dict__, "page_index": 2})
    hits = search.hits(rows).unionByName(later.hits(rows))
    return hits.select(F.col(m.UUID).alias("uuid"), "score", F.col(m.TITLE).alias("title"), F.md5(m.NOTE).alias("note_md5"))



# An index that commands in two batches, the newer ones first, and a rebuild have changed.
FOLLOWED = [
    ("commands", COMMANDS_SQL),
    ("newest", "SELECT repository, uuid, arg_max(type, seq) AS type FROM commands GROUP BY ALL"),
    (
        "applied",
        """
        SELECT * REPLACE ('old ' || title AS title) FROM content
        WHERE doc_id % 7 <> 3 AND (repository, uuid) NOT IN (SELECT (repository, uuid) FROM newest)
        UNION ALL
        SELECT content.* FROM content JOIN newest USING (repository, uuid) WHERE doc_id % 11 <> 5 AND type = 'INSERT'
        """,
    ),
    ("rebuilt", "SELECT * FROM content WHERE repository = 'archive' AND primary_type = 'Note' AND doc_id % 11 <> 5"),
    ("corpus_now", "SELECT * FROM applied WHERE uuid NOT IN (SELECT uuid FROM rebuilt) UNION ALL SELECT * FROM rebuilt"),
    *boosted_scores("'thre', 'ble'", "corpus_now"),
    (
        "matching",
        """
        SELECT DISTINCT uuid FROM terms a JOIN terms b USING (uuid) WHERE a.term = 'thre' AND b.term = 'ble'
        AND uuid NOT IN (SELECT uuid FROM terms WHERE term = 'wh')
        """,
    ),
]


def _followed(spark, folder):
    """The table, and a term index that was built before its last changes and followed them."""
    whole, number = content(spark, folder), F.try_to_number(F.substring(m.UUID, 5, 20), F.lit("9999999999999999999"))
    index = IndexTable(spark, scratch_path(spark, "index"), derive=False)
    index.create(whole.where(number % 7 != 3).withColumn(m.TITLE, F.concat(F.lit("old "), F.col(m.TITLE))))
    terms = TermIndex(spark, scratch_path(spark, "terms"))
    terms.follow(index)
    source, told = whole.where(number % 11 != 5), commands(spark.read.parquet(f"{folder}/events.parquet"))
    for batch, part in (("late", F.col("seq") % 4 == 0), ("early", F.col("seq") % 4 != 0)):
        index.apply_commands(told.where(part), source, batch, recursive=False)
    index.reindex("QUERY", source, "archive", predicate=p.equals(m.PRIMARY_TYPE, "Note"))
    terms.follow(index)
    return index, terms


@query(content_sql("SELECT uuid, score FROM scores JOIN matching USING (uuid)", *FOLLOWED))
def r1_term_index_follows_the_index(spark, folder):
    """Ranked search over postings that followed a feed and a rebuild: as after a fresh build."""
    _, terms = _followed(spark, folder)
    return terms.ranked(fulltext_query(spark, MATCH_TEXT)).select(F.col(m.UUID).alias("uuid"), "score")


@query(content_sql("SELECT field, term, count(DISTINCT uuid) AS df FROM terms GROUP BY field, term", *FOLLOWED))
def t15_statistics_follow_the_index(spark, folder):
    """Document frequencies of all terms of that index, from the differences."""
    _, terms = _followed(spark, folder)
    summed = terms.statistics().groupBy("field", "term").agg(F.sum("df").alias("df"))
    return summed.where("df <> 0")
