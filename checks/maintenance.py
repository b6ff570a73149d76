"""Index maintenance, in batch (M1–M5) and from a stream.

The index is stale on purpose: it misses some documents, holds some that are
gone from the source, and all its titles are old.
"""

from pyspark.sql import functions as F

from checks.base import content_sql, query
from checks.textsql import sort_key, term_views
from foliosearch import model as m
from foliosearch.functions import predicates as p
from foliosearch.operators import maintain
from foliosearch.plans.index_table import IndexTable
from foliosearch.session import scratch_path
from foliosearch.sources.content import content
from foliosearch.streaming.changes import maintain_index

COLUMNS = [m.REPOSITORY, m.UUID, m.PATH, m.PRIMARY_TYPE, m.ANCESTOR_IDS, m.TITLE, m.STATE]


def _number():
    return F.try_to_number(F.substring(m.UUID, 5, 20), F.lit("9999999999999999999"))


def tree(spark, folder):
    """Documents, and a folder document per repository for each parent path."""
    documents = content(spark, folder).select(*COLUMNS)
    folders = (
        content(spark, folder)
        .select(m.REPOSITORY, m.PARENT_ID, F.slice(m.ANCESTOR_IDS, 1, 1).alias(m.ANCESTOR_IDS))
        .distinct()
        .select(
            m.REPOSITORY,
            F.col(m.PARENT_ID).alias(m.UUID),
            F.col(m.PARENT_ID).alias(m.PATH),
            F.lit("Workspace").alias(m.PRIMARY_TYPE),
            m.ANCESTOR_IDS,
            F.col(m.PARENT_ID).alias(m.TITLE),
            F.lit("project").alias(m.STATE),
        )
    )
    return documents.unionByName(folders)


def source(spark, folder):
    kept = F.coalesce(_number() % 11 != 5, F.lit(True))
    return tree(spark, folder).where(kept)


def stale(spark, folder):
    kept = F.coalesce(_number() % 7 != 3, F.lit(True))
    return tree(spark, folder).where(kept).withColumn(m.TITLE, F.concat(F.lit("old "), F.col(m.TITLE)))


TREE_SQL = """
SELECT repository, uuid, path, primary_type, ancestor_ids, title, state, doc_id FROM content
UNION ALL
SELECT DISTINCT repository, parent_id, parent_id, 'Workspace', [ancestor_ids[1]], parent_id, 'project',
  CAST(NULL AS BIGINT) FROM content
"""

TREES = [
    ("tree", TREE_SQL),
    ("source", "SELECT * FROM tree WHERE doc_id IS NULL OR doc_id % 11 <> 5"),
    (
        "stale",
        "SELECT repository, uuid, path, primary_type, ancestor_ids, 'old ' || title AS title, state, doc_id "
        "FROM tree WHERE doc_id IS NULL OR doc_id % 7 <> 3",
    ),
]

SHOWN_SQL = "repository, uuid, path, title"


def shown(df):
    return df.select(
        F.col(m.REPOSITORY).alias("repository"),
        F.col(m.UUID).alias("uuid"),
        F.col(m.PATH).alias("path"),
        F.col(m.TITLE).alias("title"),
    )


def _table(spark, folder):
    index = IndexTable(spark, scratch_path(spark, "index"), derive=False)
    index.create(stale(spark, folder))
    return index


REINDEX_ALL_SQL = f"""
SELECT {SHOWN_SQL} FROM stale WHERE repository <> 'default'
UNION ALL SELECT {SHOWN_SQL} FROM source WHERE repository = 'default'
"""


@query(content_sql(REINDEX_ALL_SQL, *TREES))
def m1_reindex_all(spark, folder):
    return shown(maintain.reindex_all(stale(spark, folder), source(spark, folder), "default"))


@query(content_sql(REINDEX_ALL_SQL, *TREES))
def m1_reindex_all_in_table(spark, folder):
    index = _table(spark, folder)
    index.reindex("ALL", source(spark, folder), "default")
    return shown(index.read())


def _subtree_sql(root, columns=SHOWN_SQL):
    inside = f"repository = 'default' AND (uuid = '{root}' OR list_contains(ancestor_ids, '{root}'))"
    return f"""
    SELECT {columns} FROM stale WHERE NOT ({inside})
    UNION ALL SELECT {columns} FROM source WHERE {inside}
      AND EXISTS (SELECT 1 FROM source WHERE repository = 'default' AND uuid = '{root}')
    """


@query(content_sql(_subtree_sql("/src0/en"), *TREES))
def m2_reindex_subtree(spark, folder):
    return shown(maintain.reindex_subtree(stale(spark, folder), source(spark, folder), "default", "/src0/en"))


@query(content_sql(_subtree_sql("/src2"), *TREES))
def m2_vanished_root_prunes(spark, folder):
    """Nothing has the id ``/src2``, so what lies below it goes."""
    return shown(maintain.reindex_subtree(stale(spark, folder), source(spark, folder), "default", "/src2"))


@query(content_sql(_subtree_sql("/src0/en"), *TREES))
def m2_reindex_subtree_in_table(spark, folder):
    index = _table(spark, folder)
    index.reindex("ROOT", source(spark, folder), "default", root_id="/src0/en")
    return shown(index.read())


REINDEX_QUERY_SQL = f"""
SELECT {SHOWN_SQL} FROM stale WHERE (repository, uuid) NOT IN (
  SELECT (repository, uuid) FROM source WHERE repository = 'default' AND primary_type = 'File')
UNION ALL SELECT {SHOWN_SQL} FROM source WHERE repository = 'default' AND primary_type = 'File'
"""


@query(content_sql(REINDEX_QUERY_SQL, *TREES))
def m3_reindex_query(spark, folder):
    rows = source(spark, folder)
    return shown(
        maintain.reindex_query(stale(spark, folder), rows, "default", p.equals(m.PRIMARY_TYPE, "File"))
    )


@query(content_sql(REINDEX_QUERY_SQL, *TREES))
def m3_reindex_query_compacted(spark, folder):
    """The same in a table, whose changes are then folded into a new version."""
    index = _table(spark, folder)
    index.reindex("QUERY", source(spark, folder), "default", predicate=p.equals(m.PRIMARY_TYPE, "File"))
    index.compact()
    return shown(index.read())


@query(content_sql(f"SELECT {SHOWN_SQL} FROM stale", *TREES))
def m4_blank_requests_change_nothing(spark, folder):
    index = _table(spark, folder)
    index.reindex("ROOT", source(spark, folder), "default", root_id=" ")
    index.reindex("QUERY", source(spark, folder), "default")
    return shown(index.read())


@query(
    content_sql(
        """
        SELECT 'foliosearch.audit' AS category, 'foliosearch.reindex' AS event, 'system' AS principal,
          comment, count(*) AS indexed
        FROM source, (SELECT unnest(['rebuild of repository ''default''', 'rebuild below document ''/src0/en'''])
          AS comment)
        WHERE repository = 'default' GROUP BY comment
        """,
        *TREES,
    )
)
def m5_audit(spark, folder):
    """One row per rebuild, here with the size of the repository after both."""
    index = _table(spark, folder)
    index.reindex("ALL", source(spark, folder), "default")
    index.reindex("ROOT", source(spark, folder), "default", root_id="/src0/en")
    size = index.read().where(F.col(m.REPOSITORY) == "default").agg(F.count(F.lit(1))).scalar()
    return index.audit().select("category", "event", "principal", "comment", size.alias("indexed"))


# Commands made of the events: purchases index a document, errors delete one, the
# others are commands of unknown types, which change nothing; nine events in a row are about the same document, and some documents never were.
COMMANDS_SQL = """
SELECT 2 * event_id AS seq, CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'INSERT' END AS type,
  'doc-' || (event_id // 9) AS uuid,
  CASE WHEN (event_id // 9) % 10 = 0 THEN 'archive' ELSE 'default' END AS repository
FROM events WHERE event_type IN ('error', 'purchase')
"""


def commands(events):
    number = F.floor(F.col("event_id") / 9).cast("long")
    kind = F.when(F.col("event_type") == "error", maintain.DELETE).when(F.col("event_type") == "purchase", maintain.INSERT)
    return events.select(
        (F.col("event_id") * 2).alias("seq"),
        F.coalesce(kind, "event_type").alias("type"),
        F.concat(F.lit("doc-"), number.cast("string")).alias("docId"),
        F.when(number % 10 == 0, "archive").otherwise("default").alias("repo"),
        F.lit(False).alias("recurse"),
        F.lit(True).alias("sync"),
    )


def _event_stream(spark, folder):
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)


APPLIED_SQL = f"""
SELECT {SHOWN_SQL} FROM stale WHERE (repository, uuid) NOT IN (SELECT (repository, uuid) FROM newest)
UNION ALL
SELECT {SHOWN_SQL} FROM source JOIN newest USING (repository, uuid) WHERE type = 'INSERT'
"""

STREAM_VIEWS = [
    *TREES,
    ("commands", COMMANDS_SQL),
    ("newest", "SELECT repository, uuid, arg_max(type, seq) AS type FROM commands GROUP BY ALL"),
]


@query(content_sql(APPLIED_SQL, *STREAM_VIEWS))
def x1_change_feed(spark, folder):
    """A stream of commands worked off, then replayed from scratch."""
    index = _table(spark, folder)
    for attempt in ("first", "replay"):
        maintain_index(
            commands(_event_stream(spark, folder)),
            source(spark, folder),
            index,
            "changes",
            recursive=False,
            checkpoint=scratch_path(spark, f"stream-{attempt}"),
        )
    return shown(index.read())


@query(content_sql(APPLIED_SQL, *STREAM_VIEWS))
def x2_background_feed(spark, folder):
    """The same applied in the background."""
    index = _table(spark, folder)
    running = maintain_index(
        commands(_event_stream(spark, folder)),
        source(spark, folder),
        index,
        "changes",
        sync=False,
        interval="1 second",
        recursive=False,
        checkpoint=scratch_path(spark, "stream"),
    )
    running.processAllAvailable()
    running.stop()
    return shown(index.read())


RECURSIVE_VIEWS = [
    *TREES,
    (
        "roots",
        """SELECT repository, uuid AS root, CASE WHEN uuid LIKE '%/en' THEN 'DELETE' ELSE 'INSERT' END AS type,
          CAST(9001 AS BIGINT) AS seq FROM source WHERE primary_type = 'Workspace'""",
    ),
    (
        "commands",
        f"""{COMMANDS_SQL}
        UNION ALL SELECT seq, type, root, repository FROM roots
        UNION ALL SELECT seq, type, stale.uuid, stale.repository FROM stale JOIN roots
          ON roots.repository = stale.repository AND list_contains(ancestor_ids, root) WHERE type = 'DELETE'
        UNION ALL SELECT seq, type, source.uuid, source.repository FROM source JOIN roots
          ON roots.repository = source.repository AND list_contains(ancestor_ids, root) WHERE type = 'INSERT'
        """,
    ),
    ("newest", "SELECT repository, uuid, arg_max(type, seq) AS type FROM commands GROUP BY ALL"),
]


@query(content_sql(APPLIED_SQL, *RECURSIVE_VIEWS))
def x1_recursive_commands(spark, folder):
    """Whole folders deleted or indexed among commands for single documents."""
    single = commands(spark.read.parquet(f"{folder}/events.parquet"))
    documents = source(spark, folder)
    folders = documents.where(F.col(m.PRIMARY_TYPE) == "Workspace").select(
        F.lit(9001).cast("long").alias("seq"),
        F.when(F.endswith(m.UUID, F.lit("/en")), maintain.DELETE).otherwise(maintain.INSERT).alias("type"),
        F.col(m.UUID).alias("docId"),
        F.col(m.REPOSITORY).alias("repo"),
        F.lit(True).alias("recurse"),
        F.lit(True).alias("sync"),
    )
    index = _table(spark, folder)
    index.apply_commands(single.unionByName(folders), documents, "folders and documents")
    return shown(index.read())


DERIVED_VIEWS = [
    ("commands", COMMANDS_SQL),
    ("newest", "SELECT repository, uuid, arg_max(type, seq) AS type FROM commands GROUP BY ALL"),
    (
        "applied",
        """
        SELECT uuid, 'old ' || title AS title FROM content
        WHERE doc_id % 7 <> 3 AND (repository, uuid) NOT IN (SELECT (repository, uuid) FROM newest)
        UNION ALL
        SELECT uuid, title FROM content JOIN newest USING (repository, uuid) WHERE doc_id % 11 <> 5 AND type = 'INSERT'
        """,
    ),
    *term_views("applied", "uuid", "title", "fr"),
    ("digests", "SELECT uuid, md5(string_agg(DISTINCT term, ' ' ORDER BY term)) AS title_terms FROM terms GROUP BY uuid"),
]


@query(
    content_sql(
        f"""
        SELECT a.uuid, {sort_key("a.title")} AS title_lowercase, title_terms
        FROM applied a LEFT JOIN digests USING (uuid)
        """,
        *DERIVED_VIEWS,
    )
)
def x1_commands_on_derived_index(spark, folder):
    """Commands on an index of whole documents with its index columns."""
    whole, number = content(spark, folder), _number()
    index = IndexTable(spark, scratch_path(spark, "index"))
    index.create(whole.where(number % 7 != 3).withColumn(m.TITLE, F.concat(F.lit("old "), F.col(m.TITLE))))
    single = commands(spark.read.parquet(f"{folder}/events.parquet"))
    index.apply_commands(single, whole.where(number % 11 != 5), "events")
    terms = F.array_sort(m.TITLE_TERMS)
    return index.read().select(
        F.col(m.UUID).alias("uuid"),
        F.col(m.TITLE_LOWERCASE).alias("title_lowercase"),
        F.when(F.size(terms) > 0, F.md5(F.array_join(terms, " "))).alias("title_terms"),
    )


@query(content_sql(f"SELECT {SHOWN_SQL} FROM stale WHERE repository <> 'default'", *TREES))
def m1_vanished_repository(spark, folder):
    """A repository rebuilt from a source that has nothing of it any more; the others stay."""
    index = _table(spark, folder)
    index.reindex("ALL", source(spark, folder).where(F.col(m.REPOSITORY) != "default"), "default")
    return shown(index.read())


@query(content_sql(APPLIED_SQL, *STREAM_VIEWS))
def x1_batches_in_reverse(spark, folder):
    """The commands in three batches, the newest first, each with older and newer ones of a document."""
    told = commands(spark.read.parquet(f"{folder}/events.parquet"))
    index = _table(spark, folder)
    for part in (2, 0, 1):
        batch = told.where(F.pmod(F.floor(F.col("seq") / 2), F.lit(3)) == part)
        index.apply_commands(batch, source(spark, folder), f"part {part}", recursive=False)
        if part == 0:
            index.compact()
    return shown(index.read())


@query(
    """
    SELECT 2 * event_id AS seq, event_type AS type, 'doc-' || (event_id // 9) AS uuid, 'unknown type' AS reason, 'events' AS batch
    FROM events WHERE event_type NOT IN ('error', 'purchase')
    """
)
def x1_rejected_commands(spark, folder):
    index = _table(spark, folder)
    for _ in range(2):
        index.apply_commands(commands(spark.read.parquet(f"{folder}/events.parquet")), source(spark, folder), "events", recursive=False)
    return index.rejects().select("seq", "type", F.col("docId").alias("uuid"), "reason", "batch")


# Some documents without a repository; no rebuild of one may touch them.
NULLS_SQL = """
SELECT CASE WHEN doc_id % 13 = 0 THEN NULL ELSE repository END AS repository, uuid, path, primary_type, ancestor_ids, title, doc_id
FROM content WHERE doc_id % 3 = 0
"""
NULLS_VIEWS = [
    ("whole", NULLS_SQL),
    ("fresh", "SELECT * FROM whole WHERE doc_id % 11 <> 5"),
    ("older", "SELECT * REPLACE ('old ' || title AS title) FROM whole WHERE doc_id % 7 <> 3"),
]
NULLS_SHOWN = f"repository, uuid, {sort_key('title')} AS title_lowercase"


def _nulls_sql(replaced, gone=None):
    return content_sql(
        f"""
        SELECT {NULLS_SHOWN} FROM older WHERE ({gone or replaced}) IS NOT TRUE
          AND (uuid NOT IN (SELECT uuid FROM fresh WHERE {replaced}))
        UNION ALL SELECT {NULLS_SHOWN} FROM fresh WHERE {replaced}
        """,
        *NULLS_VIEWS,
    )


def _with_nulls(spark, folder, kind, **more):
    number = _number()
    rows = content(spark, folder).where(number % 3 == 0)
    rows = rows.withColumn(m.REPOSITORY, F.when(number % 13 != 0, F.col(m.REPOSITORY)))
    index = IndexTable(spark, scratch_path(spark, "index"))
    index.create(rows.where(number % 7 != 3).withColumn(m.TITLE, F.concat(F.lit("old "), F.col(m.TITLE))))
    index.reindex(kind, rows.where(number % 11 != 5), "default", **more)
    return index.read().select(
        F.col(m.REPOSITORY).alias("repository"), F.col(m.UUID).alias("uuid"), F.col(m.TITLE_LOWERCASE).alias("title_lowercase")
    )


@query(_nulls_sql("repository = 'default'"))
def m1_documents_without_a_repository(spark, folder):
    return _with_nulls(spark, folder, "ALL")


@query(_nulls_sql("false", "repository = 'default' AND list_contains(ancestor_ids, '/src0')"))
def m2_documents_without_a_repository(spark, folder):
    """No document is the root, so its subtree goes, but for those of no repository."""
    return _with_nulls(spark, folder, "ROOT", root_id="/src0")


@query(_nulls_sql("repository = 'default' AND primary_type = 'File'", "false"))
def m3_documents_without_a_repository(spark, folder):
    return _with_nulls(spark, folder, "QUERY", predicate=p.equals(m.PRIMARY_TYPE, "File"))


# An index of whole documents of which some are out of date, some missing and some gone from the source.
DIFFERING_VIEWS = [
    ("fresh", "SELECT * FROM content WHERE doc_id % 11 <> 5"),
    ("older", "SELECT * REPLACE (CASE WHEN doc_id % 5 = 2 THEN 'old ' || title ELSE title END AS title) FROM content WHERE doc_id % 7 <> 3"),
]


def _written_sql(scope, delete=True):
    gone = f"UNION ALL SELECT 'DELETE', repository, uuid FROM older WHERE {scope} AND doc_id % 11 = 5"
    return content_sql(
        f"""
        SELECT 'INSERT' AS change, repository, uuid FROM fresh WHERE {scope} AND (doc_id % 7 = 3 OR (doc_id % 5 = 2 AND title IS NOT NULL))
        {gone if delete else ""}
        """,
        *DIFFERING_VIEWS,
    )


def _written(spark, folder, kind, **more):
    whole, number = content(spark, folder), _number()
    old = F.when(number % 5 == 2, F.concat(F.lit("old "), F.col(m.TITLE))).otherwise(F.col(m.TITLE))
    index = IndexTable(spark, scratch_path(spark, "index"))
    index.create(whole.where(number % 7 != 3).withColumn(m.TITLE, old))
    for _ in range(2):  # the second rebuild finds nothing to do
        index.reindex(kind, whole.where(number % 11 != 5), "default", only_changed=True, **more)
    assert index.version() == 2
    # Of a document with a deletion and an insertion in one write, the insertion counts.
    rows = index.written(2).groupBy(*m.KEY).agg(F.max("change_type").alias("change"))
    return rows.select("change", F.col(m.REPOSITORY).alias("repository"), F.col(m.UUID).alias("uuid"))


@query(_written_sql("repository = 'default'"))
def m1_rebuild_writes_what_differs(spark, folder):
    return _written(spark, folder, "ALL")


@query(_written_sql("repository = 'default' AND primary_type = 'File'", delete=False))
def m3_rebuild_writes_what_differs(spark, folder):
    return _written(spark, folder, "QUERY", predicate=p.equals(m.PRIMARY_TYPE, "File"))


@query(
    content_sql(
        f"""
        SELECT {SHOWN_SQL} FROM ({_subtree_sql("/src1/fr", f"{SHOWN_SQL}, ancestor_ids")})
        WHERE uuid = '/src1' OR list_contains(ancestor_ids, '/src1')
        """,
        *TREES,
    )
)
def f9_below_by_path_ranges(spark, folder):
    """An ancestor's subtree in all repositories, by its ranges, after a rebuild of a part of it."""
    index = _table(spark, folder)
    index.reindex("ROOT", source(spark, folder), "default", root_id="/src1/fr")
    return shown(index.read().where(index.below("/src1")))
