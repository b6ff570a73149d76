"""Filters and predicates."""

from pyspark.sql import functions as F

from checks.base import content_sql, query
from foliosearch import model as m
from foliosearch.functions import predicates as p
from foliosearch.operators.security import acl_class_filter, acl_filter, acl_join, acl_semi_join
from foliosearch.plans.index_table import IndexTable
from foliosearch.plans.infix_index import InfixIndex
from foliosearch.session import scratch_path
from foliosearch.sources.content import content

SHOWN_SQL = "uuid, path, primary_type, state, strftime(issued, '%Y-%m-%d') AS issued"


def shown(df):
    return df.select(
        F.col(m.UUID).alias("uuid"),
        F.col(m.PATH).alias("path"),
        F.col(m.PRIMARY_TYPE).alias("primary_type"),
        F.col(m.STATE).alias("state"),
        F.date_format(m.ISSUED, "yyyy-MM-dd").alias("issued"),
    )


PREDICATES = {
    "f1_equals": (lambda: p.equals(m.PRIMARY_TYPE, "Note"), "primary_type = 'Note'"),
    "f2_not_equals_keeps_missing": (
        lambda: p.not_equals(m.STATE, "approved"),
        "state <> 'approved' OR state IS NULL",
    ),
    "f3_like": (lambda: p.like(m.TITLE, "%the%"), "title LIKE '%the%'"),
    "f4_ilike": (lambda: p.ilike(m.TITLE, "%The%"), "title ILIKE '%The%'"),
    "f5_in": (
        lambda: p.is_in(m.VERSION_LABEL, ["0.4", "2.6", "3.1", "9.9"]),
        "version_label IN ('0.4', '2.6', '3.1', '9.9')",
    ),
    "f6_not_in_keeps_missing": (
        lambda: p.not_in(m.STATE, ["deleted", "project"]),
        "state NOT IN ('deleted', 'project') OR state IS NULL",
    ),
    "f7_between_dates": (
        lambda: p.between_dates(m.ISSUED, "2017-03-28", "2017-04-09"),
        "issued BETWEEN DATE '2017-03-28' AND DATE '2017-04-09'",
    ),
    "f7_between_dates_of_timestamp": (
        lambda: p.between_dates(m.MODIFIED, "2016-03-01", "2016-04-15"),
        "CAST(modified AS DATE) BETWEEN DATE '2016-03-01' AND DATE '2016-04-15'",
    ),
    "f7_not_between_dates": (
        lambda: p.not_between_dates(m.EXPIRED, "2017-02-01", "2018-01-15"),
        "expired IS NULL OR CAST(expired AS DATE) NOT BETWEEN DATE '2017-02-01' AND DATE '2018-01-15'",
    ),
    "f8_path_startswith": (
        lambda: p.starts_with_path("/src1"),
        "path = '/src1' OR starts_with(path, '/src1/')",
    ),
    "f9_below_ancestor": (
        lambda: p.below_ancestor("/src1/en"),
        "list_contains(ancestor_ids, '/src1/en')",
    ),
    "f10_has_value": (lambda: p.has_value(m.MIXINS, "Folderish"), "list_contains(mixins, 'Folderish')"),
    "f11_lacks_value": (
        lambda: p.lacks_value(m.MIXINS, "HiddenInNavigation"),
        "NOT coalesce(list_contains(mixins, 'HiddenInNavigation'), false)",
    ),
    "f12_has_any_value": (
        lambda: p.has_any_value(m.SUBJECTS, ["topic1", "topic5", "fr"]),
        "list_has_any(subjects, ['topic1', 'topic5', 'fr'])",
    ),
    "f13_flags": (
        lambda: p.all_of(p.flag(m.IS_VERSION, 0), p.flag(m.IS_PROXY, 1)),
        "NOT is_version AND is_proxy",
    ),
    "f14_state_is_not": (lambda: p.state_is_not("deleted"), "state <> 'deleted' OR state IS NULL"),
    "f14_state_is": (lambda: p.state_is("deleted"), "state = 'deleted'"),
    "f15_nested_and": (
        lambda: p.all_of(
            p.all_of(p.flag(m.IS_CHECKED_IN, 1), p.all_of(p.state_is_not("project"), p.not_equals(m.POS, 18))),
            p.not_between_dates(m.EXPIRED, "2017-05-01", "2017-08-31"),
        ),
        "(is_checked_in AND ((state <> 'project' OR state IS NULL) AND pos <> 18)) "
        "AND (expired IS NULL OR CAST(expired AS DATE) NOT BETWEEN DATE '2017-05-01' AND DATE '2017-08-31')",
    ),
    "f16_match_all": (p.match_all, "true"),
    "f19_apostrophe_literal": (
        lambda: p.not_in(m.TITLE, ["rock 'n' roll", "it''s"]) & p.not_equals(m.DESCRIPTION, "o'clock"),
        """title NOT IN ('rock ''n'' roll', 'it''''s') AND (description <> 'o''clock' OR description IS NULL)""",
    ),
    "everything_together": (
        lambda: p.all_of(
            p.between_dates(m.MODIFIED, "2016-02-03", "2017-09-20"),
            p.has_any_value(m.SUBJECTS, ["topic2", "topic3", "topic6", "de"]),
            p.flag(m.IS_VERSION, 0),
            p.not_in(m.PRIMARY_TYPE, ["Picture", "Folder"]),
            p.ilike(m.DESCRIPTION, "%E%"),
            p.like(m.PATH, "/src1%/f_/%"),
            p.not_equals(m.VERSION_LABEL, "1.1"),
            p.lacks_value(m.MIXINS, "Commentable"),
        ),
        """CAST(modified AS DATE) BETWEEN DATE '2016-02-03' AND DATE '2017-09-20'
        AND list_has_any(subjects, ['topic2', 'topic3', 'topic6', 'de']) AND NOT is_version
        AND primary_type NOT IN ('Picture', 'Folder') AND description ILIKE '%E%'
        AND path LIKE '/src1%/f_/%' AND version_label <> '1.1'
        AND NOT coalesce(list_contains(mixins, 'Commentable'), false)""",
    ),
}


def _register(name, predicate, condition):
    @query(content_sql(f"SELECT {SHOWN_SQL} FROM content WHERE {condition}"), name=name)
    def filtered(spark, folder):
        return shown(content(spark, folder).where(predicate()))


for _name, (_predicate, _condition) in PREDICATES.items():
    _register(_name, _predicate, _condition)


@query(content_sql(f"SELECT {SHOWN_SQL} FROM content WHERE list_has_any(acl, ['members', 'user-3', 'user-7'])"))
def f17_acl_filter(spark, folder):
    return shown(acl_filter(content(spark, folder), ["members", "user-3", "user-7"]))


@query(content_sql(f"SELECT {SHOWN_SQL} FROM content"))
def f17_acl_administrator(spark, folder):
    return shown(acl_filter(content(spark, folder), admin=True))


PRINCIPALS_SQL = f"""SELECT {SHOWN_SQL} FROM content
  WHERE list_has_any(acl, (SELECT list('user-' || c_custkey % 40) || ['staff'] FROM customer))"""


def principals(spark, folder):
    """Users numbered by the customers, and their staff."""
    user = F.concat(F.lit("user-"), (F.col("c_custkey") % 40).cast("string"))
    names = F.explode(F.array(user, F.lit("staff")))
    return spark.read.parquet(f"{folder}/customer.parquet").select(names.alias("principal"))


@query(content_sql(PRINCIPALS_SQL))
def j2_acl_semi_join(spark, folder):
    return shown(acl_semi_join(content(spark, folder), principals(spark, folder)))


@query(content_sql(PRINCIPALS_SQL))
def j2_acl_join_of_many_principals(spark, folder):
    """The join that takes over beyond the literals."""
    return shown(acl_join(content(spark, folder), principals(spark, folder)))


def _classed(spark, folder):
    """An index with ACL classes, in which some documents were changed after the first write."""
    rows = content(spark, folder)
    index = IndexTable(spark, scratch_path(spark, "index"))
    index.create(rows.withColumn(m.ACL, F.when(F.col(m.PRIMARY_TYPE) != "File", F.col(m.ACL)).otherwise(F.array(F.lit("nobody")))))
    index.reindex("QUERY", rows, "default", predicate=p.equals(m.PRIMARY_TYPE, "File"))
    index.reindex("QUERY", rows, "archive", predicate=p.equals(m.PRIMARY_TYPE, "File"))
    return index


@query(content_sql(f"SELECT {SHOWN_SQL} FROM content WHERE list_has_any(acl, ['members', 'user-3', 'user-7'])"))
def f17_acl_classes(spark, folder):
    """The callers are tested against the distinct ACLs, and rows by their class."""
    index = _classed(spark, folder)
    return shown(acl_class_filter(index.read(), index.acl_classes(), ["members", "user-3", "user-7"]))


@query(content_sql(PRINCIPALS_SQL))
def j2_acl_classes_of_many_principals(spark, folder):
    index = _classed(spark, folder)
    return shown(acl_class_filter(index.read(), index.acl_classes(), principals(spark, folder)))


def _infix(spark, folder, pattern, any_case):
    rows = content(spark, folder)
    infix = InfixIndex(spark, scratch_path(spark, "infix"))
    infix.build(rows)
    return shown(infix.search(rows, pattern, any_case=any_case))


@query(content_sql(f"SELECT {SHOWN_SQL} FROM content WHERE title LIKE '%tion%the_%'"))
def f3_like_by_trigrams(spark, folder):
    """Two stretches and a single-character wildcard, by the trigrams of both."""
    return _infix(spark, folder, "%tion%the_%", any_case=False)


@query(content_sql(f"SELECT {SHOWN_SQL} FROM content WHERE title ILIKE '%ATTI%'"))
def f4_ilike_by_trigrams(spark, folder):
    return _infix(spark, folder, "%ATTI%", any_case=True)
