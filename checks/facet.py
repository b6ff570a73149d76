"""Facets (A3, A3a–A3e)."""

from pyspark.sql import functions as F

from checks.base import content_sql, query
from checks.textsql import sort_key
from foliosearch import model as m
from foliosearch.functions import predicates as p
from foliosearch.operators.facets import (
    date_histogram_facet,
    date_range_facet,
    facets,
    histogram_facet,
    range_facet,
    terms_facet,
)
from foliosearch.plans.search import Search
from foliosearch.sources.content import content, table


def _top_sql(agg_id, source, key, top):
    return f"""
    SELECT '{agg_id}' AS agg_id, CAST({key} AS VARCHAR) AS bucket_key, count(*) AS doc_count FROM {source}
    WHERE {key} IS NOT NULL GROUP BY ALL ORDER BY doc_count DESC, bucket_key LIMIT {top}
    """


@query(
    " UNION ALL ".join(
        f"({_top_sql(agg_id, 'part', key, top)})"
        for agg_id, key, top in (("brand", "p_brand", 5), ("name", "p_name", 12), ("size", "p_size", 7))
    )
)
def a3a_terms_facets(spark, folder):
    parts = table(spark, folder, "part")
    wanted = [terms_facet("brand", "p_brand", 5), terms_facet("name", "p_name", 12), terms_facet("size", "p_size", 7)]
    return facets(parts, wanted)


@query(_top_sql("order", "lineitem", "l_orderkey", 25))
def a3a_terms_facet_of_many_values(spark, folder):
    return facets(table(spark, folder, "lineitem"), [terms_facet("order", "l_orderkey", 25)])


@query(_top_sql("order", "lineitem", "l_orderkey", 3000))
def a3a_terms_facet_with_long_top(spark, folder):
    return facets(table(spark, folder, "lineitem"), [terms_facet("order", "l_orderkey", 3000)])


@query(
    """
    SELECT 'price' AS agg_id, CASE WHEN l_extendedprice < 10000 THEN 'low' WHEN l_extendedprice < 50000 THEN 'middle'
      ELSE 'high' END AS bucket_key, count(*) AS doc_count FROM lineitem GROUP BY ALL
    """
)
def a3b_range_facet(spark, folder):
    ranges = [("low", None, 10000.0), ("middle", 10000.0, 50000.0), ("high", 50000.0, None)]
    return facets(table(spark, folder, "lineitem"), [range_facet("price", "l_extendedprice", ranges)])


@query(
    """
    SELECT 'shipped' AS agg_id, CASE WHEN l_shipdate < DATE '1996-01-01' THEN 'before'
      WHEN l_shipdate < DATE '1999-07-01' THEN 'between' ELSE 'after' END AS bucket_key, count(*) AS doc_count
    FROM lineitem GROUP BY ALL
    """
)
def a3c_date_range_facet(spark, folder):
    ranges = [("before", None, "1996-01-01"), ("between", "1996-01-01", "1999-07-01"), ("after", "1999-07-01", None)]
    return facets(table(spark, folder, "lineitem"), [date_range_facet("shipped", "l_shipdate", ranges)])


@query(
    """
    SELECT 'total' AS agg_id, CAST(CAST(floor(o_totalprice / 25000) AS BIGINT) * 25000 AS VARCHAR) AS bucket_key,
      count(*) AS doc_count FROM orders GROUP BY ALL
    """
)
def a3d_histogram_facet(spark, folder):
    return facets(table(spark, folder, "orders"), [histogram_facet("total", "o_totalprice", 25000)])


@query(
    """
    SELECT 'month' AS agg_id, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS bucket_key,
      count(*) AS doc_count FROM orders GROUP BY ALL
    """
)
def a3e_date_histogram_facet(spark, folder):
    return facets(table(spark, folder, "orders"), [date_histogram_facet("month", "o_orderdate", "month")])


MATCHED = "(SELECT * FROM content WHERE NOT is_proxy AND list_has_any(acl, ['members', 'staff']))"


@query(
    content_sql(
        f"""
        ({_top_sql("state", MATCHED, "state", 10)})
        UNION ALL
        ({_top_sql("subject", f"(SELECT unnest(subjects) AS s FROM {MATCHED})", "s", 6)})
        UNION ALL
        SELECT 'pos', CAST(pos // 20 * 20 AS VARCHAR), count(*) FROM {MATCHED} GROUP BY ALL
        UNION ALL
        SELECT 'year', strftime(date_trunc('year', modified), '%Y-%m-%d'), count(*) FROM {MATCHED} GROUP BY ALL
        """
    )
)
def a3_facets_with_search(spark, folder):
    """Several kinds at once over all matches, a multi-valued column among them."""
    search = Search(p.flag(m.IS_PROXY, 0), principals=["members", "staff"])
    wanted = [
        terms_facet("state", m.STATE, 10),
        terms_facet("subject", m.SUBJECTS, 6),
        histogram_facet("pos", m.POS, 20),
        date_histogram_facet("year", m.MODIFIED, "year"),
    ]
    return search.facets(content(spark, folder), wanted)


@query(
    """
    SELECT 'type' AS agg_id, event_type AS bucket_key, count(*) AS doc_count FROM events GROUP BY ALL
    UNION ALL
    SELECT 'day', strftime(ts, '%Y-%m-%d'), count(*) FROM events GROUP BY ALL
    """
)
def a3_facets_of_events(spark, folder):
    wanted = [terms_facet("type", "event_type", 10), date_histogram_facet("day", "ts", "day")]
    return facets(table(spark, folder, "events"), wanted)


def _as_rows(result):
    """Page, total and facets of one result as rows ``(part, name, number)``."""
    names = result.hits.select(F.lit("hit").alias("part"), F.col(m.UUID).alias("name"), F.lit(1).cast("long").alias("number"))
    info = result.info().select(F.explode(F.map_from_arrays(
        F.array(F.lit("totalSize"), F.lit("resultsCount"), F.lit("pageCount")),
        F.array("totalSize", "resultsCount", "pageCount"),
    )).alias("name", "number"))
    buckets = result.facets.select("agg_id", "bucket_key", "doc_count")
    return names.union(info.select(F.lit("info"), "name", "number")).union(buckets)


def _result_sql(order, size, index):
    """Rows of a result over ``MATCHED``: its page in this order, page info, four facets."""
    return content_sql(
        f"""
        SELECT 'hit' AS part, uuid AS name, 1 AS number
        FROM (SELECT uuid FROM {MATCHED} ORDER BY {order} LIMIT {size} OFFSET {size * index})
        UNION ALL SELECT 'info', 'totalSize', count(*) FROM {MATCHED}
        UNION ALL SELECT 'info', 'resultsCount', greatest(0, least({size}, count(*) - {size * index})) FROM {MATCHED}
        UNION ALL SELECT 'info', 'pageCount', CAST(ceil(count(*) / {size}) AS BIGINT) FROM {MATCHED}
        UNION ALL ({_top_sql("state", MATCHED, "state", 10)})
        UNION ALL ({_top_sql("subject", f"(SELECT unnest(subjects) AS s FROM {MATCHED})", "s", 6)})
        UNION ALL SELECT 'pos', CAST(pos // 20 * 20 AS VARCHAR), count(*) FROM {MATCHED} GROUP BY ALL
        UNION ALL SELECT 'year', strftime(date_trunc('year', modified), '%Y-%m-%d'), count(*) FROM {MATCHED} GROUP BY ALL
        """
    )


def _result(spark, folder, sort, size, index):
    search = Search(p.flag(m.IS_PROXY, 0), principals=["members", "staff"], sort=sort, page_size=size, page_index=index)
    wanted = [
        terms_facet("state", m.STATE, 10),
        terms_facet("subject", m.SUBJECTS, 6),
        histogram_facet("pos", m.POS, 20),
        date_histogram_facet("year", m.MODIFIED, "year"),
    ]
    return _as_rows(search.result(content(spark, folder), wanted))


@query(_result_sql(f"{sort_key('title')}, uuid", 20, 1))
def a3_page_total_and_facets_by_title(spark, folder):
    """All of one search: the second page by a text, its info, four facets."""
    return _result(spark, folder, [(m.TITLE, True)], 20, 1)


@query(_result_sql("expired DESC NULLS LAST, pos, uuid", 15, 0))
def a3_page_total_and_facets_by_date(spark, folder):
    """The same by a falling date with ties and nulls."""
    return _result(spark, folder, [(m.EXPIRED, False), (m.POS, True)], 15, 0)
