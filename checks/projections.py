"""Projections and derived columns."""

from pyspark.sql import functions as F

from checks.base import content_sql, query
from checks.scans import ENVELOPE_SQL, flat_envelope
from checks.textsql import sort_key, term_views
from foliosearch import model as m
from foliosearch.functions.text import parse_date
from foliosearch.operators.envelope import (
    envelope,
    project_schema_map,
    project_schemas,
    requested_prefixes,
    resolve_schemas,
)
from foliosearch.operators.fields import apply_templates, catch_all, derive_fields, searchable_columns
from foliosearch.sources.content import content

# A schema table made of the parts: brands are names; every third brand has no
# prefix, every third a blank one.
SCHEMAS_SQL = """
SELECT p_brand AS name, CASE min(p_partkey) % 3 WHEN 0 THEN NULL WHEN 1 THEN ' '
  ELSE lower(replace(p_brand, '#', '')) END AS prefix
FROM part GROUP BY p_brand
"""


def schemas(spark, folder):
    number = F.min("p_partkey") % 3
    own = F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit("")))
    return (
        spark.read.parquet(f"{folder}/part.parquet")
        .groupBy(F.col("p_brand").alias("name"), own.alias("own"))
        .agg(number.alias("number"))
        .select(
            "name",
            F.when(F.col("number") == 1, " ").when(F.col("number") == 2, F.col("own")).alias("prefix"),
        )
    )


@query(content_sql("SELECT uuid, title, CAST(pos AS BIGINT) AS pos FROM content"))
def p1_projection(spark, folder):
    return content(spark, folder).select(
        F.col(m.UUID).alias("uuid"), F.col(m.TITLE).alias("title"), F.col(m.POS).cast("long").alias("pos")
    )


@query(
    f"""
    SELECT coalesce(nullif(trim(prefix), ''), name) AS prefix FROM ({SCHEMAS_SQL})
    WHERE name IN ('Brand#1', 'Brand#2', 'Brand#7', 'Brand#12', 'Brand#17')
    """
)
def p2_resolve_schemas(spark, folder):
    return resolve_schemas("Brand#1, Brand#2 ,Brand#7,unknown,,Brand#12,Brand#17 ", schemas(spark, folder))


@query(
    content_sql(
        "SELECT title, strftime(issued, '%Y-%m-%d') AS issued, md5(note) AS note_md5, coalesce(len(subjects), 0) AS n FROM content"
    )
)
def p3_project_schemas(spark, folder):
    kept = project_schemas(content(spark, folder), ["dc", "note"])
    return kept.select(
        F.col(m.TITLE).alias("title"),
        F.date_format(m.ISSUED, "yyyy-MM-dd").alias("issued"),
        F.md5(m.NOTE).alias("note_md5"),
        F.greatest(F.size(m.SUBJECTS), F.lit(0)).cast("long").alias("n"),
    )


@query(
    content_sql(
        "SELECT uuid, 'dc:title=' || title AS properties FROM content WHERE true"
    )
)
def p3_project_schema_map(spark, folder):
    rows = content(spark, folder)
    properties = F.create_map(
        *[part for name in (m.UUID, m.TITLE, m.WEB_ID) for part in (F.lit(name), F.col(name))]
    )
    kept = project_schema_map(properties, ["dc", "note", "ecm"])
    shown = F.transform(F.map_entries(kept), lambda entry: F.concat(entry.key, F.lit("="), entry.value))
    return rows.select(F.col(m.UUID).alias("uuid"), F.array_join(shown, ",").alias("properties"))


@query(
    """
    SELECT name, count(*) AS n FROM documents, (SELECT unnest(split(
      'common:icon,dc:created,dc:description,dc:expired,dc:issued,dc:modified,dc:subjects,dc:title,'
      || 'note:note,picture:views,rcd:globalVariablesValues,thumb:thumbnail,ttc:webid', ',')) AS name)
    GROUP BY name
    """
)
def p4_all_schemas_without_system_fields(spark, folder):
    """An absent request and ``*`` mean all schemas; ``ecm:`` is never one (P5)."""
    rows = content(spark, folder)
    table = schemas(spark, folder)
    asked = [requested_prefixes(request, table) for request in (None, "*")]
    kept = [set(project_schemas(rows, prefixes).columns) for prefixes in asked]
    names = F.array(*[F.lit(name) for name in sorted(kept[0] & kept[1])])
    return rows.select(F.explode(names).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def p5_no_system_field_is_a_property(spark, folder):
    """Asked for ``ecm`` and ``rcd``: only the record variables come."""
    kept = project_schemas(content(spark, folder), ["ecm", "rcd"])
    (name,) = kept.columns
    return kept.groupBy(F.lower(F.col(name)["lang"]).alias("lang")).agg(F.count(F.lit(1)).alias("n"))


@query(content_sql(f"SELECT {ENVELOPE_SQL} FROM content"))
def p6_envelope(spark, folder):
    return flat_envelope(envelope(content(spark, folder), prefixes=None))


def _distinct_terms(alias, text):
    views = term_views("content", "uuid", text, "fr", alias + "_")
    body = f"SELECT uuid, md5(string_agg(DISTINCT term, ' ' ORDER BY term)) AS {alias} FROM {alias}_terms GROUP BY uuid"
    return [*views, (alias, body)]


CATCH_ALL_SQL = """concat_ws(' ', repository, uuid, path, primary_type, state, parent_id,
  array_to_string(ancestor_ids, ' '), version_label, array_to_string(mixins, ' '), change_token,
  array_to_string(acl, ' '), CAST(is_version AS VARCHAR), CAST(is_proxy AS VARCHAR), CAST(is_checked_in AS VARCHAR),
  CAST(pos AS VARCHAR), binary_text, title, description, array_to_string(subjects, ' '),
  strftime(modified, '%Y-%m-%d %H:%M:%S'), strftime(expired, '%Y-%m-%d %H:%M:%S'), strftime(modified, '%Y-%m-%d %H:%M:%S'),
  strftime(issued, '%Y-%m-%d'), note, web_id, rcd_source, rcd_lang)"""


@query(
    content_sql(
        f"""
        SELECT c.uuid, {sort_key("c.title")} AS title_lowercase,
          lower(rcd_source) || ',' || lower(rcd_lang) AS variables,
          array_to_string(list_concat(ancestor_ids, [path]), ',') AS children,
          title_terms, description_terms, note_terms, all_terms
        FROM content c LEFT JOIN title_terms USING (uuid) LEFT JOIN description_terms USING (uuid)
          LEFT JOIN note_terms USING (uuid) LEFT JOIN all_terms USING (uuid)
        """,
        *_distinct_terms("title_terms", "title"),
        *_distinct_terms("description_terms", "description"),
        *_distinct_terms("note_terms", "note"),
        *_distinct_terms("all_terms", CATCH_ALL_SQL),
    )
)
def p7_derived_fields(spark, folder):
    derived = derive_fields(content(spark, folder, spread=True))

    def digest(name):
        return F.when(F.size(name) > 0, F.md5(F.array_join(F.sort_array(name), " ")))

    variables = F.col(m.VARIABLES_LOWERCASE)
    return derived.select(
        F.col(m.UUID).alias("uuid"),
        F.col(m.TITLE_LOWERCASE).alias("title_lowercase"),
        F.concat_ws(",", variables["source"], variables["lang"]).alias("variables"),
        F.array_join(m.PATH_CHILDREN, ",").alias("children"),
        digest(m.TITLE_TERMS).alias("title_terms"),
        digest(m.DESCRIPTION_TERMS).alias("description_terms"),
        digest(m.NOTE_TERMS).alias("note_terms"),
        digest(m.ALL_TERMS).alias("all_terms"),
    )


@query(content_sql(f"SELECT uuid, md5({CATCH_ALL_SQL}) AS all_md5 FROM content"))
def p8_catch_all(spark, folder):
    rows = content(spark, folder)
    return rows.select(F.col(m.UUID).alias("uuid"), F.md5(catch_all(rows)).alias("all_md5"))


@query(
    content_sql(
        "SELECT uuid, lower(rcd_source) AS source, lower(rcd_lang) AS lang, 0 AS hidden_columns FROM content"
    )
)
def p9_dynamic_templates(spark, folder):
    treated = apply_templates(content(spark, folder))
    hidden = [name for name in (m.THUMBNAIL, m.PICTURE_VIEWS) if name in treated.columns]
    variables = F.col(m.VARIABLES_LOWERCASE)
    return treated.select(
        F.col(m.UUID).alias("uuid"),
        variables["source"].alias("source"),
        variables["lang"].alias("lang"),
        F.lit(len(hidden)).alias("hidden_columns"),
    )


@query(
    """
    SELECT name, count(*) AS n FROM documents, (SELECT unnest(split(
      'ecm:repository,ecm:uuid,ecm:path,ecm:primaryType,ecm:currentLifeCycleState,ecm:parentId,'
      || 'ecm:ancestorIds,ecm:versionLabel,ecm:mixinType,ecm:changeToken,ecm:acl,ecm:isVersion,ecm:isProxy,'
      || 'ecm:isCheckedInVersion,ecm:pos,dc:title,dc:subjects,dc:created,dc:expired,dc:modified,dc:issued,'
      || 'ttc:webid,rcd:globalVariablesValues', ',')) AS name)
    GROUP BY name
    """
)
def p9_searchable_columns(spark, folder):
    rows = content(spark, folder)
    names = F.array(*[F.lit(name) for name in searchable_columns(rows)])
    return rows.select(F.explode(names).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query(
    content_sql(
        """
        SELECT uuid, strftime(try_cast(CASE length(s) WHEN 4 THEN s || '-01-01' WHEN 7 THEN s || '-01'
          ELSE s END AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS parsed
        FROM dates
        """,
        (
            "dates",
            """SELECT uuid, CASE doc_id % 5 WHEN 0 THEN strftime(issued, '%Y')
              WHEN 1 THEN strftime(issued, '%Y-%m') WHEN 2 THEN strftime(issued, '%Y-%m-%d')
              WHEN 3 THEN strftime(issued, '%Y-%m-%dT10:20:30Z') ELSE 'bad' || doc_id END AS s FROM content""",
        ),
    )
)
def p10_lenient_dates(spark, folder):
    kind = F.col(m.PRIMARY_TYPE)
    text = (
        F.when(kind == "Note", F.date_format(m.ISSUED, "yyyy"))
        .when(kind == "Article", F.date_format(m.ISSUED, "yyyy-MM"))
        .when(kind == "File", F.date_format(m.ISSUED, "yyyy-MM-dd"))
        .when(kind == "Picture", F.date_format(m.ISSUED, "yyyy-MM-dd'T10:20:30Z'"))
        .otherwise(F.concat(F.lit("bad"), F.substring(m.UUID, 5, 20)))
    )
    return content(spark, folder).select(
        F.col(m.UUID).alias("uuid"), F.date_format(parse_date(text), "yyyy-MM-dd HH:mm:ss").alias("parsed")
    )
