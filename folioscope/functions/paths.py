"""Expressions over relative paths with forward slashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def suffix(path: Column) -> Column:
    """With its dot, in lower case; empty for a name without one, or with only a leading dot."""
    return F.lower(F.regexp_extract(name(path), r"[^.](\.[^.]+)$", 1))


def depth(path: Column) -> Column:
    return F.size(F.split(path, "/"))


def order(path: Column) -> Column:
    """Sorts paths part by part."""
    return F.split(path, "/")


def one_of(path: Column, suffixes: tuple[str, ...]) -> Column:
    return suffix(path).isin(*suffixes)
