"""Component-wise path expressions. Paths are relative and separated by ``/``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def components(path: Column) -> Column:
    return F.split(path, "/", -1)


def ancestors(path: Column) -> Column:
    """The path itself and every directory above it."""
    parts = components(path)
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"),
    )


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def first_component(path: Column) -> Column:
    return F.substring_index(path, "/", 1)


def ends_with_path(path: Column, suffix: Column) -> Column:
    """Whether the last components of ``path`` are those of ``suffix``."""
    return (path == suffix) | F.endswith(path, F.concat(F.lit("/"), suffix))
