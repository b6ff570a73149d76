"""The content document: column names, types and how each column is indexed.

Column names keep the ``prefix:name`` form of the data model.  They hold a
colon, never a dot, so ``F.col("dc:title")`` needs no quoting; SQL text does
(back-ticks).
"""

from __future__ import annotations

from pyspark.sql import types as T

REPOSITORY = "ecm:repository"
UUID = "ecm:uuid"
PATH = "ecm:path"
PRIMARY_TYPE = "ecm:primaryType"
STATE = "ecm:currentLifeCycleState"
PARENT_ID = "ecm:parentId"
ANCESTOR_IDS = "ecm:ancestorIds"
VERSION_LABEL = "ecm:versionLabel"
MIXINS = "ecm:mixinType"
CHANGE_TOKEN = "ecm:changeToken"
ACL = "ecm:acl"
IS_VERSION = "ecm:isVersion"
IS_PROXY = "ecm:isProxy"
IS_CHECKED_IN = "ecm:isCheckedInVersion"
POS = "ecm:pos"
BINARY_TEXT = "ecm:binarytext"
TITLE = "dc:title"
DESCRIPTION = "dc:description"
SUBJECTS = "dc:subjects"
CREATED = "dc:created"
EXPIRED = "dc:expired"
MODIFIED = "dc:modified"
ISSUED = "dc:issued"
NOTE = "note:note"
ICON = "common:icon"
WEB_ID = "ttc:webid"
RECORD_VARIABLES = "rcd:globalVariablesValues"
THUMBNAIL = "thumb:thumbnail"
PICTURE_VIEWS = "picture:views"

KEY = [REPOSITORY, UUID]

# Columns derived for the index carry this prefix; they are never part of a hit.
DERIVED_PREFIX = "idx"
TITLE_LOWERCASE = "idx:title_lowercase"
TITLE_TERMS = "idx:title_terms"
DESCRIPTION_TERMS = "idx:description_terms"
NOTE_TERMS = "idx:note_terms"
ALL_TERMS = "idx:all_terms"
PATH_CHILDREN = "idx:path_children"
VARIABLES_LOWERCASE = "idx:variables_lowercase"
ACL_CLASS = "idx:acl_class"
DIGEST = "idx:digest"

_strings = T.ArrayType(T.StringType())
_object = T.MapType(T.StringType(), T.StringType())

CONTENT_SCHEMA = T.StructType(
    [
        T.StructField(REPOSITORY, T.StringType()),
        T.StructField(UUID, T.StringType()),
        T.StructField(PATH, T.StringType()),
        T.StructField(PRIMARY_TYPE, T.StringType()),
        T.StructField(STATE, T.StringType()),
        T.StructField(PARENT_ID, T.StringType()),
        T.StructField(ANCESTOR_IDS, _strings),
        T.StructField(VERSION_LABEL, T.StringType()),
        T.StructField(MIXINS, _strings),
        T.StructField(CHANGE_TOKEN, T.StringType()),
        T.StructField(ACL, _strings),
        T.StructField(IS_VERSION, T.BooleanType()),
        T.StructField(IS_PROXY, T.BooleanType()),
        T.StructField(IS_CHECKED_IN, T.BooleanType()),
        T.StructField(POS, T.IntegerType()),
        T.StructField(BINARY_TEXT, T.StringType()),
        T.StructField(TITLE, T.StringType()),
        T.StructField(DESCRIPTION, T.StringType()),
        T.StructField(SUBJECTS, _strings),
        T.StructField(CREATED, T.TimestampType()),
        T.StructField(EXPIRED, T.TimestampType()),
        T.StructField(MODIFIED, T.TimestampType()),
        T.StructField(ISSUED, T.DateType()),
        T.StructField(NOTE, T.StringType()),
        T.StructField(ICON, T.StringType()),
        T.StructField(WEB_ID, T.StringType()),
        T.StructField(RECORD_VARIABLES, _object),
        T.StructField(THUMBNAIL, _object),
        T.StructField(PICTURE_VIEWS, _object),
    ]
)

# ---------------------------------------------------------------------------
# Must equal the search mapping this engine is compatible with.
# ---------------------------------------------------------------------------

# Keyword columns and sort keys are cut to this many characters.
KEYWORD_LENGTH = 256

# Hits written per file by a full export.
EXPORT_BATCH = 10_000

# Columns never returned with a hit.
SOURCE_EXCLUDES = [BINARY_TEXT]

# Relevance boost of each analysed column.
FIELD_BOOSTS = {TITLE: 2.0, DESCRIPTION: 1.5, NOTE: 1.0}

# Stored, but not searchable as a value (they may still feed the catch-all).
NOT_SEARCHABLE = [DESCRIPTION, NOTE, BINARY_TEXT, ICON]

# Stored, and kept out of the catch-all text too.
NOT_IN_CATCH_ALL = [ICON, THUMBNAIL, PICTURE_VIEWS]

# Object columns, by name: what the index does with their members.
#   hide      = neither searchable nor in the catch-all text
#   lowercase = searchable, plus a lowercase form to sort and match by
OBJECT_RULES = {
    THUMBNAIL: "hide",
    PICTURE_VIEWS: "hide",
    RECORD_VARIABLES: "lowercase",
}

# Category and name of the audit row that each rebuild leaves.
AUDIT_CATEGORY = "foliosearch.audit"
AUDIT_EVENT = "foliosearch.reindex"
