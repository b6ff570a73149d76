"""The registry, and the content view as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Same rows and columns as foliosearch.sources.content; members of object
# columns stand as columns of their own (rcd_source, rcd_lang, …).
CONTENT_SQL = """
SELECT
  CASE WHEN d.doc_id % 10 = 0 THEN 'archive' ELSE 'default' END AS repository,
  'doc-' || d.doc_id AS uuid,
  '/' || d.source || '/' || d.lang || '/' || d.doc_id AS path,
  CASE d.doc_id % 5 WHEN 0 THEN 'Note' WHEN 1 THEN 'Article' WHEN 2 THEN 'File'
       WHEN 3 THEN 'Picture' ELSE 'Folder' END AS primary_type,
  CASE WHEN l.toxic = 1 THEN 'deleted' WHEN l.quality = 1 THEN 'approved'
       WHEN l.doc_id IS NOT NULL THEN 'project' END AS state,
  '/' || d.source || '/' || d.lang AS parent_id,
  ['/' || d.source, '/' || d.source || '/' || d.lang] AS ancestor_ids,
  (d.doc_id % 4) || '.' || (d.doc_id % 10) AS version_label,
  CASE WHEN d.doc_id % 17 = 0 THEN NULL
       WHEN d.doc_id % 4 = 0 THEN split('Folderish,Commentable', ',')
       WHEN d.doc_id % 3 = 0 THEN split('HiddenInNavigation', ',')
       ELSE split('Downloadable,Versionable', ',') END AS mixins,
  'ct-' || d.doc_id AS change_token,
  CASE WHEN d.doc_id % 19 = 0 THEN NULL
       WHEN d.doc_id % 4 = 0 THEN split('Everyone,members', ',')
       WHEN d.doc_id % 4 = 1 THEN split('members', ',')
       WHEN d.doc_id % 4 = 2 THEN split('staff,administrators', ',')
       ELSE ['user-' || (d.doc_id % 50)] END AS acl,
  d.doc_id % 11 = 0 AS is_version,
  d.doc_id % 13 = 0 AS is_proxy,
  d.doc_id % 9 = 0 AS is_checked_in,
  CAST(d.doc_id % 100 AS INTEGER) AS pos,
  d.text AS binary_text,
  substring(d.text, 1, 60) AS title,
  substring(d.text, 61, 200) AS description,
  CASE WHEN d.doc_id % 6 <> 0 THEN [d.lang, 'topic' || (d.doc_id % 8)] END AS subjects,
  CAST(DATE '2016-01-01' + CAST(d.doc_id % 730 AS INTEGER) AS TIMESTAMP) AS modified,
  CASE WHEN d.doc_id % 3 = 0
       THEN CAST(DATE '2016-01-01' + CAST(d.doc_id % 730 AS INTEGER) + 365 AS TIMESTAMP) END AS expired,
  DATE '2016-01-01' + CAST(d.doc_id % 730 AS INTEGER) AS issued,
  d.text AS note,
  '/icons/' || CASE d.doc_id % 5 WHEN 0 THEN 'note' WHEN 1 THEN 'article' WHEN 2 THEN 'file'
       WHEN 3 THEN 'picture' ELSE 'folder' END || '.gif' AS icon,
  'web-' || d.doc_id AS web_id,
  upper(substring(d.source, 1, 1)) || substring(d.source, 2) AS rcd_source,
  upper(d.lang) AS rcd_lang,
  CASE WHEN d.doc_id % 5 = 3 THEN 'thumb-' || d.doc_id END AS thumb_name,
  CASE WHEN d.doc_id % 5 = 3 THEN 'view-' || d.doc_id END AS view_title,
  d.doc_id AS doc_id
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def content_sql(body: str, *more: tuple[str, str]) -> str:
    """``body`` over the content view, and over further named subqueries."""
    views = [("content", CONTENT_SQL), *more]
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in views) + "\n" + body


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = function
        if sql is not None:
            ORACLE[key] = sql
        return function

    return register
