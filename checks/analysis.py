"""Text analysis (T1–T16, F18): every text of the tables, whole."""

from pyspark.sql import functions as F

from checks.base import content_sql, query
from checks.projections import CATCH_ALL_SQL
from checks.textsql import (
    drop_article,
    fold,
    parts,
    sort_key,
    spaced_parts,
    stem_english,
    stem_french,
    strip_html,
    term_views,
    token_views,
    with_sql,
)
from foliosearch import model as m
from foliosearch.functions import predicates as p
from foliosearch.functions import text as t
from foliosearch.operators.analysis import (
    analyze,
    analyzed_terms,
    document_postings,
    term_statistics,
    tokens,
)
from foliosearch.operators.fulltext import (
    fulltext_keys,
    fulltext_match,
    fulltext_query,
    search_fulltext,
)
from foliosearch.plans.index_table import IndexTable
from foliosearch.session import scratch_path
from foliosearch.sources.content import content, table


def distinct_words(spark, folder):
    """Each word of the documents once."""
    return tokens(table(spark, folder, "documents", "doc_id"), [], "text").select("word").distinct()


WORDS_VIEWS = [
    *token_views("documents", "doc_id", "text"),
    ("words", "SELECT DISTINCT word FROM tokens"),
]


@query(f"SELECT page_id, md5({strip_html('html')}) AS text_md5, length({strip_html('html')}) AS n FROM pages")
def t1_strip_html(spark, folder):
    stripped = table(spark, folder, "pages", "page_id").select("page_id", t.strip_html(F.col("html")).alias("text"))
    return stripped.select("page_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n"))


@query(
    with_sql(
        token_views("documents", "doc_id", "text"),
        "SELECT word, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum, CAST(sum(doc_id) AS BIGINT) AS id_sum FROM tokens GROUP BY word",
    )
)
def t2_words(spark, folder):
    found = tokens(table(spark, folder, "documents", "doc_id"), ["doc_id"], "text")
    return found.groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.sum("pos").alias("pos_sum"), F.sum("doc_id").alias("id_sum")
    )


@query(
    with_sql(
        [
            *token_views("pages", "page_id", "html"),
            ("spaced", f"SELECT DISTINCT word, {spaced_parts('word')} AS s FROM tokens"),
        ],
        f"SELECT word, array_to_string({parts('word', 's')}, '|') AS parts FROM spaced",
    )
)
def t3_word_parts(spark, folder):
    words = tokens(table(spark, folder, "pages", "page_id"), [], "html").select("word").distinct()
    return words.select("word", F.array_join(t.with_word_parts(F.col("word")), "|").alias("parts"))


@query(with_sql(WORDS_VIEWS, "SELECT word, lower(word) AS lowercase FROM words"))
def t4_lowercase(spark, folder):
    return distinct_words(spark, folder).select("word", t.lowercase(F.col("word")).alias("lowercase"))


def _stop_sql(words):
    return ", ".join("'" + word + "'" for word in words)


@query(
    with_sql(
        WORDS_VIEWS,
        f"""
        SELECT 'en' AS lang, word FROM words WHERE word NOT IN ({_stop_sql(t.ENGLISH_STOP_WORDS)})
        UNION ALL SELECT 'fr', word FROM words WHERE word NOT IN ({_stop_sql(t.FRENCH_STOP_WORDS)})
        """,
    )
)
def t5_stop_words(spark, folder):
    words = distinct_words(spark, folder)
    kept = [
        words.where(~t.is_stop_word(F.col("word"), stop)).select(F.lit(lang).alias("lang"), "word")
        for lang, stop in (("en", t.ENGLISH_STOP_WORDS), ("fr", t.FRENCH_STOP_WORDS))
    ]
    return kept[0].unionByName(kept[1])


# Endings that the stemmers tell apart, put on every distinct word.
ENDINGS = ["", "s", "es", "ies", "us", "ss", "aux", "ers", "ée", "ex", "nn"]


def _with_endings(spark, folder):
    lower = F.lower("word").alias("word")
    words = distinct_words(spark, folder).select(lower).distinct()
    endings = F.explode(F.array(*[F.lit(ending) for ending in ENDINGS]))
    return words.select("word", endings.alias("ending")).select(F.concat("word", "ending").alias("word"))


STEM_VIEWS = [
    *WORDS_VIEWS,
    ("lowered", "SELECT DISTINCT lower(word) AS word FROM words"),
    (
        "ended",
        "SELECT word || ending AS word FROM lowered, (SELECT unnest(["
        + ", ".join(f"'{ending}'" for ending in ENDINGS)
        + "]) AS ending)",
    ),
]


@query(with_sql(STEM_VIEWS, f"SELECT word, {stem_english('word')} AS stem FROM ended"))
def t6_stem_english(spark, folder):
    return _with_endings(spark, folder).select("word", t.stem_english(F.col("word")).alias("stem"))


@query(with_sql(STEM_VIEWS, f"SELECT word, {stem_french('word')} AS stem FROM ended"))
def t7_stem_french(spark, folder):
    return _with_endings(spark, folder).select("word", t.stem_french(F.col("word")).alias("stem"))


@query(
    with_sql(
        WORDS_VIEWS,
        f"""
        SELECT word, CASE WHEN {fold('word')} <> word THEN {fold('word')} || '|' || word ELSE word END AS kept
        FROM words
        """,
    )
)
def t8_fold_accents(spark, folder):
    return distinct_words(spark, folder).select(
        "word", F.array_join(t.with_folded(F.col("word")), "|").alias("kept")
    )


@query(
    with_sql(
        [
            *WORDS_VIEWS,
            (
                "prefixed",
                "SELECT article || word AS word FROM words, (SELECT unnest(["
                "'', 'l''', 'qu’', 'd''', 'aujourd''']) AS article)",
            ),
        ],
        f"SELECT word, {drop_article('word')} AS kept FROM prefixed",
    )
)
def t9_drop_article(spark, folder):
    articles = F.explode(F.array(*[F.lit(article) for article in ("", "l'", "qu’", "d'", "aujourd'")]))
    prefixed = distinct_words(spark, folder).select("word", articles.alias("article"))
    return prefixed.select(F.concat("article", "word").alias("word")).select(
        "word", t.drop_article(F.col("word")).alias("kept")
    )


def _term_summary(terms):
    return terms.groupBy("term").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("id").alias("id_sum"),
        F.sum("pos").alias("pos_sum"),
        F.sum("part").cast("long").alias("part_sum"),
    )


TERM_SUMMARY_SQL = """SELECT term, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum,
  CAST(sum(pos) AS BIGINT) AS pos_sum, CAST(sum(part) AS BIGINT) AS part_sum
  FROM terms GROUP BY term"""


@query(
    with_sql(
        [
            ("source", "SELECT page_id AS id, html AS text FROM pages"),
            *term_views("source", "id", "text", "en"),
        ],
        TERM_SUMMARY_SQL,
    )
)
def t10_analyzer_en(spark, folder):
    pages = table(spark, folder, "pages", "page_id").withColumnRenamed("page_id", "id")
    return _term_summary(analyze(pages, ["id"], "html", "en"))


@query(
    with_sql(
        [
            ("source", "SELECT doc_id AS id, text FROM documents"),
            *term_views("source", "id", "text", "fr"),
        ],
        TERM_SUMMARY_SQL,
    )
)
def t11_analyzer_fr(spark, folder):
    documents = table(spark, folder, "documents", "doc_id").withColumnRenamed("doc_id", "id")
    return _term_summary(analyze(documents, ["id"], "text", "fulltext"))


@query(
    with_sql(
        [
            ("source", "SELECT conv_id * 1000 + turn AS id, text FROM conversations"),
            *term_views("source", "id", "text", "fr"),
        ],
        "SELECT id, count(DISTINCT term) AS terms, "
        "md5(string_agg(DISTINCT term, ' ' ORDER BY term)) AS terms_md5 FROM terms GROUP BY id",
    )
)
def t11_terms_in_their_row(spark, folder):
    talks = table(spark, folder, "conversations", "conv_id").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), analyzed_terms(F.col("text"), "fr").alias("terms")
    )
    return talks.where(F.size("terms") > 0).select(
        "id",
        F.size("terms").cast("long").alias("terms"),
        F.md5(F.array_join(F.array_sort("terms"), " ")).alias("terms_md5"),
    )


@query(
    content_sql(
        """
        SELECT prefix, count(*) AS n FROM (SELECT unnest(list_concat(ancestor_ids, [path])) AS prefix FROM content)
        GROUP BY prefix
        """
    )
)
def t12_path_hierarchy(spark, folder):
    prefixes = content(spark, folder).select(F.explode(t.path_hierarchy(F.col(m.PATH))).alias("prefix"))
    return prefixes.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT doc_id, {sort_key('text')} AS sort_key FROM documents")
def t13_sort_key(spark, folder):
    return table(spark, folder, "documents").select("doc_id", t.sort_key(F.col("text")).alias("sort_key"))


@query("SELECT doc_id, substring(text, 1, 256) AS keyword FROM documents")
def t14_keyword(spark, folder):
    return table(spark, folder, "documents").select("doc_id", t.keyword(F.col("text")).alias("keyword"))


DOCUMENT_TERMS = term_views("documents", "doc_id", "text", "fr")


@query(
    with_sql(DOCUMENT_TERMS, "SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM terms GROUP BY term")
)
def t15_term_statistics(spark, folder):
    return term_statistics(document_postings(table(spark, folder, "documents"), ["doc_id"], "text", "fulltext"))


@query(
    with_sql(
        [*DOCUMENT_TERMS, ("tfs", "SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term")],
        "SELECT doc_id, count(*) AS terms, CAST(sum(tf) AS BIGINT) AS length, CAST(sum(tf * tf) AS BIGINT) AS squares, max(tf) AS highest "
        "FROM tfs GROUP BY doc_id",
    )
)
def t15_term_frequencies(spark, folder):
    return (
        document_postings(table(spark, folder, "documents"), ["doc_id"], "text", "fulltext")
        .groupBy("doc_id")
        .agg(
            F.count(F.lit(1)).alias("terms"),
            F.sum("tf").alias("length"),
            F.sum(F.col("tf") * F.col("tf")).alias("squares"),
            F.max("tf").alias("highest"),
        )
    )


QUERY_TEXT = "then Ering attion -thti"

MATCHING_SQL = """
  SELECT doc_id FROM terms WHERE term IN ('then', 'ering', 'attion', 'thti') GROUP BY doc_id
  HAVING count(DISTINCT CASE WHEN term <> 'thti' THEN term END) = 3 AND bool_and(term <> 'thti')
"""


@query(with_sql(DOCUMENT_TERMS, MATCHING_SQL))
def t16_fulltext_query(spark, folder):
    terms = analyze(table(spark, folder, "documents", "doc_id"), ["doc_id"], "text", "fulltext")
    return fulltext_keys(terms, ["doc_id"], fulltext_query(spark, QUERY_TEXT))


@query(
    with_sql(
        DOCUMENT_TERMS,
        """
        SELECT d.doc_id, d.source FROM documents d
        WHERE d.doc_id NOT IN (SELECT doc_id FROM terms WHERE term IN ('ther', 'ering'))
        """,
    )
)
def t16_exclusions_only(spark, folder):
    documents = table(spark, folder, "documents", "doc_id")
    terms = analyze(documents, ["doc_id"], "text", "fulltext")
    wanted = fulltext_query(spark, "-ther -Ering")
    return search_fulltext(documents, terms, ["doc_id"], wanted).select("doc_id", "source")


FULLTEXT_CONDITION = f"""
  doc_id IN ({MATCHING_SQL}) AND NOT is_proxy
  AND NOT coalesce(list_contains(mixins, 'HiddenInNavigation'), false)
  AND (state <> 'deleted' OR state IS NULL)
"""


@query(content_sql(f"SELECT uuid, title FROM content WHERE {FULLTEXT_CONDITION}", *DOCUMENT_TERMS))
def f18_fulltext_with_predicates(spark, folder):
    """Full text beside other predicates, over the terms an index holds per row."""
    rows = content(spark, folder, spread=True)
    index = IndexTable(spark, scratch_path(spark, "index"), derive=False)
    index.create(rows.withColumn(m.NOTE_TERMS, analyzed_terms(F.col(m.NOTE), "fulltext")))
    found = index.read().where(
        p.all_of(
            fulltext_match(fulltext_query(spark, QUERY_TEXT), m.NOTE_TERMS),
            p.flag(m.IS_PROXY, 0),
            p.lacks_value(m.MIXINS, "HiddenInNavigation"),
            p.state_is_not("deleted"),
        )
    )
    return found.select(F.col(m.UUID).alias("uuid"), F.col(m.TITLE).alias("title"))


@query(
    content_sql(
        """
        SELECT uuid, title FROM content WHERE uuid IN (
          SELECT uuid FROM terms WHERE term IN ('then', '2016', 'file') GROUP BY uuid
          HAVING count(DISTINCT CASE WHEN term <> 'file' THEN term END) = 2 AND bool_and(term <> 'file'))
        AND NOT is_proxy AND (state <> 'deleted' OR state IS NULL)
        """,
        *term_views("content", "uuid", CATCH_ALL_SQL, "fr"),
    )
)
def f18_catch_all_of_an_index(spark, folder):
    """A word of the text, a year of a date and an excluded type, in the terms of all fields that an index derives."""
    index = IndexTable(spark, scratch_path(spark, "index"))
    index.create(content(spark, folder, spread=True))
    wanted = fulltext_query(spark, "then 2016 -File")
    found = index.read().where(
        p.all_of(fulltext_match(wanted, m.ALL_TERMS), p.flag(m.IS_PROXY, 0), p.state_is_not("deleted"))
    )
    return found.select(F.col(m.UUID).alias("uuid"), F.col(m.TITLE).alias("title"))
