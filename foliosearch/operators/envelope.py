"""Hits as clients read them: thirteen fixed fields and the asked properties."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliosearch import model as m
from foliosearch.operators.page import SortKey, page, page_info, sort_hits, sort_orders

ALL_SCHEMAS = "*"

# ---------------------------------------------------------------------------
# The wire format of a hit and of a result.
# ---------------------------------------------------------------------------

ENVELOPE_FIELDS = {
    "repository": m.REPOSITORY,
    "uid": m.UUID,
    "path": m.PATH,
    "type": m.PRIMARY_TYPE,
    "state": m.STATE,
    "parentRef": m.PARENT_ID,
    "versionLabel": m.VERSION_LABEL,
    "isCheckedOut": None,
    "title": m.TITLE,
    "lastModified": m.MODIFIED,
    "facets": m.MIXINS,
    "changeToken": m.CHANGE_TOKEN,
}
ENTITY_TYPE = "entity-type"
DOCUMENT_ENTITY = "document"
DOCUMENTS_ENTITY = "documents"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# ---------------------------------------------------------------------------

_JSON_OPTIONS = {"ignoreNullFields": "false", "timestampFormat": TIMESTAMP_FORMAT}


def resolve_schemas(names: str, schemas: DataFrame) -> DataFrame:
    """``(prefix)`` of each requested schema, from a ``(name, prefix)`` table.

    Names are separated by commas and trimmed; a schema without a prefix counts
    under its name; unknown names are dropped.
    """
    requested = schemas.sparkSession.createDataFrame([(names,)], "names string").select(
        F.explode(F.transform(F.split("names", ","), lambda name: F.trim(name))).alias("name")
    )
    return resolve_schema_names(F.broadcast(requested.distinct()), schemas)


def resolve_schema_names(names: DataFrame, schemas: DataFrame) -> DataFrame:
    """``(prefix)`` for each row of a table ``(name)`` that names a known schema."""
    prefix = F.coalesce(F.nullif(F.trim("prefix"), F.lit("")), F.col("name"))
    return schemas.join(names, "name").select(prefix.alias("prefix"))


def requested_prefixes(names: str | None, schemas: DataFrame) -> list[str]:
    """Prefixes to show, as a list; empty means all.

    An absent request and ``*`` ask for all.  So does, for compatibility, a
    request that names unknown schemas only; that one warns.  The list is never
    longer than the request.
    """
    if names is None or names.strip() in ("", ALL_SCHEMAS):
        return []
    prefixes = sorted({row.prefix for row in resolve_schemas(names, schemas).collect()})
    if not prefixes:
        warnings.warn(f"no known schema in {names!r}: all properties are returned", stacklevel=2)
    return prefixes


def property_columns(df: DataFrame, prefixes: Sequence[str] = ()) -> list[str]:
    """The columns that are properties: of the given prefixes, never ``ecm:``."""
    hidden = re.compile(rf"(ecm|{m.DERIVED_PREFIX}):.+")
    wanted = re.compile(rf"({'|'.join(map(re.escape, prefixes))}):.+" if prefixes else ".*:.+")
    return [name for name in df.columns if wanted.fullmatch(name) and not hidden.fullmatch(name)]


def project_schemas(df: DataFrame, prefixes: Sequence[str] = ()) -> DataFrame:
    """Properties only; columns left out here are never read by the scan."""
    return df.select(*property_columns(df, prefixes))


def project_schema_map(properties: Column, prefixes: Sequence[str] = ()) -> Column:
    """The same for properties held in one map column."""
    hidden = properties
    if prefixes:
        pattern = f"^({'|'.join(map(re.escape, prefixes))}):.+$"
        hidden = F.map_filter(hidden, lambda name, _: name.rlike(pattern))
    return F.map_filter(hidden, lambda name, _: ~name.rlike("^ecm:.+$"))


def _envelope_columns(df: DataFrame, prefixes: Sequence[str] | None) -> list[Column]:
    columns = [F.lit(DOCUMENT_ENTITY).alias(ENTITY_TYPE)]
    for field, name in ENVELOPE_FIELDS.items():
        if name is None:
            column = F.lit("")
        elif name not in df.columns:
            column = F.lit(None).cast(m.CONTENT_SCHEMA[name].dataType)
        else:
            column = F.col(name)
        if name == m.MODIFIED:
            column = F.date_format(column, TIMESTAMP_FORMAT)
        columns.append(column.alias(field))
    if prefixes is not None:
        names = [name for name in property_columns(df, prefixes) if name not in m.SOURCE_EXCLUDES]
        properties = F.struct(*names) if names else F.create_map().cast("map<string,string>")
        columns.append(properties.alias("properties"))
    return columns


def envelope(df: DataFrame, prefixes: Sequence[str] | None = ()) -> DataFrame:
    """The envelope of each hit; ``prefixes=None`` leaves the properties out.

    A missing value stays an explicit null, and ``isCheckedOut`` is always
    empty.
    """
    return df.select(*_envelope_columns(df, prefixes))


def envelope_json(df: DataFrame, prefixes: Sequence[str] | None = ()) -> DataFrame:
    """``(value)``: one JSON document per hit."""
    entry = F.struct(*_envelope_columns(df, prefixes))
    return df.select(F.to_json(entry, _JSON_OPTIONS).alias("value"))


def raw_json(df: DataFrame) -> DataFrame:
    """``(value)``: one JSON document per hit, its columns as they are."""
    return df.select(F.to_json(F.struct("*"), {"timestampFormat": TIMESTAMP_FORMAT}).alias("value"))


def page_json(
    matches: DataFrame,
    page_size: int,
    page_index: int = 0,
    keys: Sequence[SortKey] = (),
    prefixes: Sequence[str] = (),
) -> DataFrame:
    """``(value)``: one JSON document for a page of the matches, with page info
    and the entries in page order.

    The page size bounds what is gathered here.  A full result goes through
    ``sources.files.write_envelope``, one document per hit.
    """
    info = page_info(matches, page_size, page_index)
    hits = page(sort_hits(matches, keys), page_size, page_index)
    position = F.row_number().over(Window.orderBy(*sort_orders(hits, keys)))
    entry = F.to_json(F.struct(*_envelope_columns(hits, prefixes)), _JSON_OPTIONS)
    numbered = hits.select(position.alias("position"), entry.alias("entry"))
    in_order = F.array_sort(F.collect_list(F.struct("position", "entry")))
    entries = F.array_join(F.transform(in_order, lambda pair: pair["entry"]), ",")
    fields = F.regexp_replace(info.select(F.to_json(F.struct("*")).alias("fields")).scalar(), r"^\{|\}$", "")
    head = F.lit(f'{{"{ENTITY_TYPE}":"{DOCUMENTS_ENTITY}",')
    return numbered.agg(entries.alias("entries")).select(
        F.concat(head, fields, F.lit(',"entries":['), "entries", F.lit("]}")).alias("value")
    )
