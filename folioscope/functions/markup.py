"""Expressions over XML and HTML text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TAG = r"^\{([^}]*)\}(.*)$"


def namespace(tag: Column) -> Column:
    """The namespace of a name written {namespace}local; empty without one."""
    return F.regexp_extract(tag, TAG, 1)


def local(tag: Column) -> Column:
    return F.when(tag.rlike(TAG), F.regexp_extract(tag, TAG, 2)).otherwise(tag)


def qualified(prefix: Column, name: Column, namespaces: Column) -> Column:
    """{namespace}name for a prefix of a map."""
    return F.concat(F.lit("{"), F.try_element_at(namespaces, prefix), F.lit("}"), name)


def opened(text: Column) -> Column:
    """The names of all start tags in order, prefixes dropped, in lower case."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"<(?:[A-Za-z][\w.-]*:)?([A-Za-z][\w.-]*)"), F.lit(1)), lambda t: F.lower(t))


def count_local(text: Column, name: str) -> Column:
    """Number of elements of a local name, whatever their prefix."""
    return F.size(F.filter(opened(text), lambda t: t == name)).cast("long")
