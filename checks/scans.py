"""Scans, sources and sinks (S1–S9), concatenation."""

from pyspark.sql import functions as F

from checks.base import content_sql, query
from foliosearch import model as m
from foliosearch.operators.envelope import page_json
from foliosearch.plans.index_table import IndexTable
from foliosearch.session import scratch_path
from foliosearch.sources import files
from foliosearch.sources.content import (
    all_repositories,
    concatenate,
    content,
    fetch_source,
    in_repository,
)


def flat(df):
    """The stored columns as scalars under plain names."""
    return df.select(
        F.col(m.REPOSITORY).alias("repository"),
        F.col(m.UUID).alias("uuid"),
        F.col(m.PATH).alias("path"),
        F.col(m.PRIMARY_TYPE).alias("primary_type"),
        F.col(m.STATE).alias("state"),
        F.col(m.PARENT_ID).alias("parent_id"),
        F.array_join(m.ANCESTOR_IDS, ",").alias("ancestor_ids"),
        F.col(m.VERSION_LABEL).alias("version_label"),
        F.array_join(m.MIXINS, ",").alias("mixins"),
        F.col(m.CHANGE_TOKEN).alias("change_token"),
        F.array_join(m.ACL, ",").alias("acl"),
        F.col(m.IS_VERSION).cast("int").alias("is_version"),
        F.col(m.IS_PROXY).cast("int").alias("is_proxy"),
        F.col(m.IS_CHECKED_IN).cast("int").alias("is_checked_in"),
        F.col(m.POS).alias("pos"),
        F.col(m.TITLE).alias("title"),
        F.md5(m.DESCRIPTION).alias("description_md5"),
        F.array_join(m.SUBJECTS, ",").alias("subjects"),
        F.date_format(m.MODIFIED, "yyyy-MM-dd").alias("modified"),
        F.date_format(m.EXPIRED, "yyyy-MM-dd").alias("expired"),
        F.date_format(m.ISSUED, "yyyy-MM-dd").alias("issued"),
        F.md5(m.NOTE).alias("note_md5"),
        F.col(m.ICON).alias("icon"),
        F.col(m.WEB_ID).alias("web_id"),
        F.col(m.RECORD_VARIABLES)["source"].alias("rcd_source"),
        F.col(m.RECORD_VARIABLES)["lang"].alias("rcd_lang"),
        F.col(m.THUMBNAIL)["name"].alias("thumb_name"),
        F.col(m.PICTURE_VIEWS)["title"].alias("view_title"),
    )


FLAT_SQL = """
repository, uuid, path, primary_type, state, parent_id,
array_to_string(ancestor_ids, ',') AS ancestor_ids, version_label,
array_to_string(mixins, ',') AS mixins, change_token, array_to_string(acl, ',') AS acl,
CAST(is_version AS INTEGER) AS is_version, CAST(is_proxy AS INTEGER) AS is_proxy,
CAST(is_checked_in AS INTEGER) AS is_checked_in, pos, title, md5(description) AS description_md5,
array_to_string(subjects, ',') AS subjects, strftime(modified, '%Y-%m-%d') AS modified,
strftime(expired, '%Y-%m-%d') AS expired, strftime(issued, '%Y-%m-%d') AS issued,
md5(note) AS note_md5, icon, web_id, rcd_source, rcd_lang, thumb_name, view_title
"""


@query(content_sql(f"SELECT {FLAT_SQL} FROM content"))
def s1_scan_documents(spark, folder):
    return flat(content(spark, folder))


@query(content_sql(f"SELECT {FLAT_SQL} FROM content WHERE repository = 'archive'"))
def s2_scan_repository(spark, folder):
    return flat(in_repository(content(spark, folder), "archive"))


@query(
    content_sql(
        "SELECT repository, uuid, title, CASE WHEN repository = 'default' THEN web_id END AS web_id FROM content"
    )
)
def s3_scan_all_repositories(spark, folder):
    rows = content(spark, folder)
    default = in_repository(rows, "default")
    archive = in_repository(rows, "archive").drop(m.WEB_ID)
    return all_repositories([default, archive]).select(
        F.col(m.REPOSITORY).alias("repository"),
        F.col(m.UUID).alias("uuid"),
        F.col(m.TITLE).alias("title"),
        F.col(m.WEB_ID).alias("web_id"),
    )


@query(
    """
    SELECT name, count(*) AS n FROM documents,
    (SELECT unnest(split('ecm:repository,ecm:uuid,ecm:path,ecm:primaryType,ecm:currentLifeCycleState,'
      || 'ecm:parentId,ecm:ancestorIds,ecm:versionLabel,ecm:mixinType,ecm:changeToken,ecm:acl,'
      || 'ecm:isVersion,ecm:isProxy,ecm:isCheckedInVersion,ecm:pos,dc:title,dc:description,dc:subjects,'
      || 'dc:created,dc:expired,dc:modified,dc:issued,note:note,common:icon,ttc:webid,'
      || 'rcd:globalVariablesValues,thumb:thumbnail,picture:views', ',')) AS name)
    GROUP BY name
    """
)
def s4_fetch_source(spark, folder):
    """Every field but the extracted binary text, counted per field."""
    fetched = fetch_source(content(spark, folder))
    names = F.array(*[F.lit(name) for name in fetched.columns])
    return fetched.select(F.explode(names).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query(content_sql(f"SELECT {FLAT_SQL} FROM content WHERE NOT is_proxy"))
def s5_full_export(spark, folder):
    path = scratch_path(spark, "export")
    files.export(content(spark, folder).where(~F.col(m.IS_PROXY)), path)
    return flat(spark.read.parquet(path))


ENVELOPE_SQL = """
'document' AS entity_type, repository, uuid AS uid, path, primary_type AS type, state,
parent_id AS parent_ref, version_label, '' AS is_checked_out, title,
strftime(modified, '%Y-%m-%dT%H:%M:%S.000Z') AS last_modified,
array_to_string(mixins, ',') AS facets, change_token
"""


def flat_envelope(df, *more):
    return df.select(
        F.col("entity-type").alias("entity_type"),
        "repository",
        "uid",
        "path",
        "type",
        "state",
        F.col("parentRef").alias("parent_ref"),
        F.col("versionLabel").alias("version_label"),
        F.col("isCheckedOut").alias("is_checked_out"),
        "title",
        F.col("lastModified").alias("last_modified"),
        F.array_join("facets", ",").alias("facets"),
        F.col("changeToken").alias("change_token"),
        *more,
    )


@query(
    content_sql(
        f"SELECT {ENVELOPE_SQL}, md5(description) AS description_md5, web_id, rcd_source, thumb_name FROM content"
    )
)
def s6_envelope_sink(spark, folder):
    path = scratch_path(spark, "envelopes")
    files.write_envelope(content(spark, folder), path)
    text = spark.read.text(path)
    hit = F.from_json("value", files.envelope_schema())
    rows = text.select(hit.alias("hit")).select("hit.*")
    properties = rows["properties"]
    return flat_envelope(
        rows,
        F.md5(properties["dc:description"]).alias("description_md5"),
        properties["ttc:webid"].alias("web_id"),
        F.get_json_object(properties["rcd:globalVariablesValues"], "$.source").alias("rcd_source"),
        F.get_json_object(properties["thumb:thumbnail"], "$.name").alias("thumb_name"),
    )


@query(content_sql(f"SELECT {FLAT_SQL} FROM content WHERE state = 'approved'"))
def s7_raw_sink(spark, folder):
    path = scratch_path(spark, "raw")
    files.write_raw(content(spark, folder).where(F.col(m.STATE) == "approved"), path)
    return flat(spark.read.schema(m.CONTENT_SCHEMA).json(path))


@query(
    content_sql(
        f"""
        (SELECT {ENVELOPE_SQL} FROM content)
        UNION ALL
        (SELECT {ENVELOPE_SQL} FROM content ORDER BY pos DESC, uuid LIMIT 25)
        """
    )
)
def s8_envelope_source(spark, folder):
    """Both layouts read back: all hits one per line, and one page per line."""
    rows = content(spark, folder)
    path = scratch_path(spark, "envelopes")
    files.write_envelope(rows, path)
    page_json(rows, 25, 0, [(m.POS, False)]).write.mode("append").text(path)
    return flat_envelope(files.read_envelope(spark, path))


@query(content_sql(f"SELECT {FLAT_SQL} FROM content WHERE primary_type <> 'Folder'"))
def s9_create_index(spark, folder):
    """Created twice: the second creation replaces the first."""
    rows = content(spark, folder)
    index = IndexTable(spark, scratch_path(spark, "index"), derive=False)
    index.create(rows)
    index.create(rows.where(F.col(m.PRIMARY_TYPE) != "Folder"))
    return flat(index.read())


@query(
    content_sql(
        """
        SELECT uuid, title FROM content WHERE pos < 50
        UNION ALL SELECT uuid, title FROM content WHERE pos >= 25
        """
    )
)
def u1_concatenate_batches(spark, folder):
    rows = content(spark, folder)
    batches = [rows.where(F.col(m.POS) < 50), rows.where(F.col(m.POS) >= 25)]
    return concatenate(batches).select(F.col(m.UUID).alias("uuid"), F.col(m.TITLE).alias("title"))
