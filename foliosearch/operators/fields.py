"""Columns an index keeps beside the stored ones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliosearch import model as m
from foliosearch.functions import text as t
from foliosearch.operators.analysis import distinct_words, terms_of_words
from foliosearch.operators.security import acl_class


def catch_all(df: DataFrame, excluded: list[str] = m.NOT_IN_CATCH_ALL) -> Column:
    """All text of a document in one string, for searches that name no column.

    Strings, arrays of strings, members of objects, numbers, flags, dates and times
    take part in schema order, unless their column is excluded; nulls leave no gap.
    """
    parts = []
    for field in df.schema:
        if field.name in excluded or field.name.startswith(m.DERIVED_PREFIX + ":"):
            continue
        column = F.col(field.name)
        if isinstance(field.dataType, (T.StringType, T.ArrayType)):
            parts.append(column)
        elif isinstance(field.dataType, T.MapType):
            parts.append(F.map_values(column))
        elif isinstance(field.dataType, T.TimestampType):
            parts.append(F.date_format(column, "yyyy-MM-dd HH:mm:ss"))
        elif isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DateType)):
            parts.append(column.cast("string"))
    return F.concat_ws(" ", *parts)


def apply_templates(df: DataFrame, rules: Mapping[str, str] = m.OBJECT_RULES) -> DataFrame:
    """Treat object columns by name: ``hide`` drops a column from what can be
    searched, ``lowercase`` adds the lowercase form of its members."""
    derived = {}
    for name, rule in rules.items():
        if name not in df.columns:
            continue
        if rule == "lowercase":
            derived[m.VARIABLES_LOWERCASE] = F.transform_values(name, lambda _, value: t.sort_key(value))
        elif rule != "hide":
            raise ValueError(f"unknown rule {rule!r} for {name}")
    hidden = [name for name, rule in rules.items() if rule == "hide"]
    return df.withColumns(derived).drop(*hidden)


def searchable_columns(df: DataFrame) -> list[str]:
    """Stored columns whose value may appear in a predicate."""
    hidden = {name for name, rule in m.OBJECT_RULES.items() if rule == "hide"}
    return [name for name in df.columns if name not in hidden and name not in m.NOT_SEARCHABLE]


def derive_fields(df: DataFrame, language: str = "fulltext") -> DataFrame:
    """The document with its index columns: sort keys, terms and path prefixes.

    Worked out once, when the index is built, so that queries only read them.
    """
    own_terms = {m.TITLE: m.TITLE_TERMS, m.DESCRIPTION: m.DESCRIPTION_TERMS, m.NOTE: m.NOTE_TERMS}
    empty = F.array().cast("array<string>")
    texts = {m.ALL_TERMS: catch_all(df, [*m.NOT_IN_CATCH_ALL, *own_terms])}
    texts.update({terms: F.col(name) for name, terms in own_terms.items()})
    words = {terms: f"{terms}:words" for terms in texts}
    # The catch-all holds the terms of all fields; words of those with terms of their
    # own are not analysed again for it, wherever else they stand.
    others = F.col(words[m.ALL_TERMS])
    for terms in own_terms.values():
        others = F.array_except(others, F.coalesce(F.col(words[terms]), empty))
    derived = {
        m.TITLE_LOWERCASE: t.sort_key(F.col(m.TITLE)),
        m.VARIABLES_LOWERCASE: F.transform_values(m.RECORD_VARIABLES, lambda _, value: t.sort_key(value)),
        m.PATH_CHILDREN: t.path_hierarchy(F.col(m.PATH)),
        m.ACL_CLASS: acl_class(F.col(m.ACL)),
        m.ALL_TERMS: terms_of_words(others, language),
    }
    for terms in own_terms.values():
        derived[terms] = terms_of_words(F.col(words[terms]), language)
    everything = F.concat(*[F.coalesce(F.col(name), empty) for name in (m.ALL_TERMS, *own_terms.values())])
    found = df.withColumns({words[terms]: distinct_words(text) for terms, text in texts.items()}).withColumns(derived)
    return found.withColumn(m.ALL_TERMS, F.array_distinct(everything)).drop(*words.values())
