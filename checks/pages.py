"""Sorting, paging, counting, joins and the whole search."""

from pyspark.sql import functions as F

from checks.base import content_sql, query
from checks.projections import SCHEMAS_SQL, schemas
from checks.scans import ENVELOPE_SQL, flat_envelope
from checks.textsql import sort_key
from foliosearch import model as m
from foliosearch.functions import predicates as p
from foliosearch.functions.text import sort_key as sort_key_column
from foliosearch.operators.envelope import envelope, resolve_schema_names
from foliosearch.operators.hydrate import hydrate
from foliosearch.operators.page import ALL_ROWS, cursor_after, page, page_info, sort_hits, total_matches
from foliosearch.plans.index_table import IndexTable
from foliosearch.plans.search import Search
from foliosearch.session import scratch_path
from foliosearch.sources.content import content


def _ids(df, *more):
    return df.select(F.col(m.UUID).alias("uuid"), *more)


@query(
    content_sql(
        """
        SELECT uuid, state, pos FROM content
        ORDER BY state DESC NULLS LAST, pos NULLS LAST, uuid LIMIT 60 OFFSET 30
        """
    )
)
def o1_multi_key_sort(spark, folder):
    hits = sort_hits(content(spark, folder), [(m.STATE, False), (m.POS, True)])
    return _ids(hits.offset(30).limit(60), F.col(m.STATE).alias("state"), F.col(m.POS).alias("pos"))


@query(content_sql("SELECT uuid, pos FROM content ORDER BY pos, uuid LIMIT 40"))
def o2_unknown_sort_key(spark, folder):
    hits = sort_hits(content(spark, folder), [("dc:absent", False), (m.POS, True)])
    return _ids(page(hits, 40), F.col(m.POS).alias("pos"))


@query(content_sql(f"SELECT uuid, title FROM content ORDER BY {sort_key('title')}, uuid LIMIT 50 OFFSET 50"))
def o3_title_sorts_lowercase(spark, folder):
    hits = sort_hits(content(spark, folder), [("DC:Title", True)])
    return _ids(page(hits, 50, 1), F.col(m.TITLE).alias("title"))


@query(content_sql("SELECT uuid, rcd_source FROM content ORDER BY lower(rcd_source) DESC, uuid LIMIT 50"))
def o3_record_variable_sorts_lowercase(spark, folder):
    hits = sort_hits(content(spark, folder), [(f"{m.RECORD_VARIABLES}.source", False)])
    return _ids(page(hits, 50), F.col(m.RECORD_VARIABLES)["source"].alias("rcd_source"))


@query(content_sql("SELECT uuid FROM content ORDER BY uuid LIMIT 50"))
def o4_no_sort_requested(spark, folder):
    return _ids(page(sort_hits(content(spark, folder)), 50))


@query(content_sql("SELECT uuid, pos FROM content ORDER BY pos DESC, uuid LIMIT 7 OFFSET 21"))
def o5_page(spark, folder):
    hits = sort_hits(content(spark, folder), [(m.POS, False)])
    return _ids(page(hits, 7, 3), F.col(m.POS).alias("pos"))


@query(content_sql("SELECT uuid, pos FROM content"))
def o6_all_rows(spark, folder):
    return _ids(page(sort_hits(content(spark, folder), [(m.POS, False)]), ALL_ROWS), F.col(m.POS).alias("pos"))


@query(content_sql("SELECT count(*) AS total, count(title) AS hits FROM content WHERE primary_type = 'Nothing'"))
def o7_empty_result(spark, folder):
    none = Search(p.equals(m.PRIMARY_TYPE, "Nothing"), admin=True, page_size=10)
    rows = content(spark, folder)
    hits = none.hits(rows).agg(F.count(m.TITLE).alias("hits"))
    total = none.total(rows).scalar()
    return hits.select(total.alias("total"), "hits")


@query(content_sql('SELECT count(*) AS "totalSize" FROM content WHERE state = \'approved\''))
def a1_total_matches(spark, folder):
    return total_matches(content(spark, folder).where(p.state_is("approved")))


@query(
    content_sql(
        """
        SELECT true AS "isPaginable", greatest(0, least(20, count(*) - 20)) AS "resultsCount",
          count(*) AS "totalSize", CAST(20 AS BIGINT) AS "pageSize",
          CAST(ceil(count(*) / 20) AS BIGINT) AS "pageCount", CAST(1 AS BIGINT) AS "currentPageIndex"
        FROM content WHERE state = 'deleted'
        """
    )
)
def a2_page_info(spark, folder):
    return page_info(content(spark, folder).where(p.state_is("deleted")), 20, 1)


@query(
    f"""
    SELECT coalesce(nullif(trim(prefix), ''), name) AS prefix, count(*) AS parts
    FROM ({SCHEMAS_SQL}) JOIN part ON p_brand = name GROUP BY 1
    """
)
def j1_schema_lookup(spark, folder):
    """Every part's schema name resolved to its prefix."""
    parts = spark.read.parquet(f"{folder}/part.parquet").select(F.col("p_brand").alias("name"))
    named = resolve_schema_names(parts, schemas(spark, folder))
    return named.groupBy("prefix").agg(F.count(F.lit(1)).alias("parts"))


@query(
    content_sql(
        f"SELECT {ENVELOPE_SQL} FROM content WHERE state = 'approved' ORDER BY {sort_key('title')}, uuid LIMIT 30"
    )
)
def j3_answer_from_index(spark, folder):
    """The index alone answers: sort key and envelope are in it."""
    rows = content(spark, folder)
    index = IndexTable(spark, scratch_path(spark, "index"), derive=False)
    index.create(rows.withColumn(m.TITLE_LOWERCASE, sort_key_column(F.col(m.TITLE))))
    search = Search(p.state_is("approved"), admin=True, sort=[(m.TITLE, True)], page_size=30)
    return flat_envelope(envelope(search.hits(index.read()), prefixes=None))


@query(
    content_sql(
        """
        SELECT row_number() OVER (ORDER BY pos DESC, uuid) AS position, uuid, md5(note) AS note_md5
        FROM (SELECT * FROM content WHERE NOT is_version ORDER BY pos DESC, uuid LIMIT 25 OFFSET 50)
        """
    )
)
def j4_hydrate_page(spark, folder):
    rows = content(spark, folder)
    keys = [(m.POS, False)]
    narrow = rows.where(p.flag(m.IS_VERSION, 0)).select(*m.KEY, m.POS)
    full = hydrate(narrow, rows, 25, 2, keys)
    return full.select(
        F.col("position").cast("long").alias("position"), F.col(m.UUID).alias("uuid"), F.md5(m.NOTE).alias("note_md5")
    )


FLAGSHIP_SQL = f"""
SELECT {ENVELOPE_SQL} FROM content
WHERE list_contains(mixins, 'Folderish') AND list_contains(ancestor_ids, '/src0')
  AND NOT is_version AND NOT is_proxy AND state = 'approved' AND list_has_any(acl, ['members', 'staff'])
ORDER BY {sort_key('title')}, uuid LIMIT 10
"""


@query(content_sql(FLAGSHIP_SQL))
def flagship_search(spark, folder):
    """Folders below an ancestor, live, in one state, that a member may read:
    the first page by title, as envelopes."""
    search = Search(
        predicate=p.all_of(
            p.has_value(m.MIXINS, "Folderish"),
            p.below_ancestor("/src0"),
            p.flag(m.IS_VERSION, 0),
            p.flag(m.IS_PROXY, 0),
            p.state_is("approved"),
        ),
        principals=["members", "staff"],
        sort=[(m.TITLE, True)],
        page_size=10,
    )
    return flat_envelope(envelope(search.hits(content(spark, folder)), prefixes=None))


@query(
    content_sql(
        """
        SELECT row_number() OVER (ORDER BY pos DESC, uuid) AS position, uuid, md5(note) AS note_md5
        FROM (SELECT * FROM content WHERE NOT is_version ORDER BY pos DESC, uuid LIMIT 25 OFFSET 50)
        """
    )
)
def j4_hydrate_page_by_id(spark, folder):
    """The same page, whose ids reach the scan of an index table."""
    index = IndexTable(spark, scratch_path(spark, "index"), derive=False)
    index.create(content(spark, folder))
    keys = [(m.POS, False)]
    narrow = index.read().where(p.flag(m.IS_VERSION, 0)).select(*m.KEY, m.POS)
    full = hydrate(narrow, index.read(), 25, 2, keys, by_id=True)
    return full.select(
        F.col("position").cast("long").alias("position"), F.col(m.UUID).alias("uuid"), F.md5(m.NOTE).alias("note_md5")
    )


@query(
    content_sql(
        """
        SELECT uuid, state, expired, 1 + (row_number() OVER (ORDER BY state DESC NULLS LAST, expired NULLS LAST, uuid) - 1) // 90 AS page
        FROM content WHERE primary_type <> 'Folder'
        ORDER BY state DESC NULLS LAST, expired NULLS LAST, uuid LIMIT 540
        """
    )
)
def o5_seek_pages(spark, folder):
    """Six pages, each found from the last hit of the one before; states and dates tie and are missing."""
    rows = content(spark, folder)
    search = Search(
        p.not_equals(m.PRIMARY_TYPE, "Folder"), admin=True, sort=[(m.STATE, False), (m.EXPIRED, True)], page_size=90
    )
    cursor, pages = None, []
    for number in range(1, 7):
        hits = search.hits_after(rows, cursor)
        pages.append(hits.withColumn("page", F.lit(number).cast("long")))
        cursor = cursor_after(hits, search.sort)
        if cursor is None:  # an empty page; no cursor would begin anew
            break
    found = pages[0]
    for more in pages[1:]:
        found = found.unionByName(more)
    return _ids(found, F.col(m.STATE).alias("state"), F.col(m.EXPIRED).alias("expired"), "page")
