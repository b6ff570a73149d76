"""Access control: keep the documents that a caller may read.

Many documents share an ACL.  Its class stands for it: a digest of its principals,
which every row can work out by itself, so that classes need no numbering and
stay the same over all versions of an index.  A dictionary of the classes answers
who may read what; rows are then chosen by class alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliosearch import model as m
from foliosearch.functions.predicates import has_any_value


def acl_filter(df: DataFrame, principals: Sequence[str] = (), *, admin: bool = False) -> DataFrame:
    """Rows whose ACL names one of the caller's principals.

    Bypassing the ACL has to be asked for: a caller without principals sees
    nothing.  The test runs inside the scan stage, whatever the number of
    principals, and needs no join.
    """
    if admin:
        return df
    if not principals:
        return df.where(F.lit(False))
    return df.where(has_any_value(m.ACL, principals))


def acl_semi_join(df: DataFrame, principals: DataFrame) -> DataFrame:
    """The same for principals held in a table ``(principal)``.

    ``(key, principal)`` pairs meet the table by equality, and only keys go back
    to the documents.  Catalyst broadcasts the table while its size allows;
    beyond, a principal that very many documents name is a skewed join, split at
    run time.
    """
    entries = df.select(*m.KEY, F.explode(F.array_distinct(m.ACL)).alias("principal"))
    readable = entries.join(principals.select("principal"), "principal", "left_semi").select(*m.KEY)
    return df.join(readable, m.KEY, "left_semi")


acl_join = acl_semi_join


# Separates principals in a class's text; it is in no principal's name.
SEPARATOR = "\u0000"


def acl_class(acl: Column) -> Column:
    """The class of an ACL, whatever the order of its principals; null where there is none.

    128 bits of a SHA-256: two lists that share a class can't be found.
    """
    names = F.array_sort(F.array_distinct(F.array_compact(acl)))
    sized = F.transform(names, lambda name: F.concat(F.length(name).cast("string"), F.lit(SEPARATOR), name))
    return F.substring(F.sha2(F.array_join(sized, SEPARATOR), 256), 1, 32)


def acl_dictionary(df: DataFrame) -> DataFrame:
    """``(class, acl)``: each distinct ACL once, with its class.

    Tasks keep one row for each class they meet, so a class that half of all rows
    have is no larger than another one.
    """
    of = F.col(m.ACL_CLASS) if m.ACL_CLASS in df.columns else acl_class(F.col(m.ACL))
    return df.where(F.col(m.ACL).isNotNull()).groupBy(of.alias("class")).agg(F.any_value(m.ACL).alias("acl"))


def readable_classes(dictionary: DataFrame, principals: Sequence[str] | DataFrame) -> DataFrame:
    """``(class)`` of the ACLs that name one of the principals: a list, or a table ``(principal)``."""
    if not isinstance(principals, DataFrame):
        wanted = F.array(*[F.lit(name) for name in sorted(set(principals))]).cast("array<string>")
        return dictionary.where(F.arrays_overlap("acl", wanted)).select("class")
    entries = dictionary.select("class", F.explode(F.array_distinct("acl")).alias("principal"))
    return entries.join(principals.select("principal"), "principal", "left_semi").select("class").distinct()


def acl_class_filter(df: DataFrame, dictionary: DataFrame, principals: Sequence[str] | DataFrame) -> DataFrame:
    """Rows that the principals may read, by the class in each row.

    Callers are tested against the classes.  Of the rows only the class meets
    anything: one join on it, broadcast while the readable classes are few.
    """
    of = F.col(m.ACL_CLASS) if m.ACL_CLASS in df.columns else acl_class(F.col(m.ACL))
    return df.join(readable_classes(dictionary, principals), of == F.col("class"), "left_semi")
