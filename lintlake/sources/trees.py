"""Source trees as tables."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from lintlake.functions.scale import stage

_ENTRY = "project string, root string, path string, is_directory boolean, is_regular boolean, mode int, error string"


def _utf8(path: str) -> tuple[str, str | None]:
    """A path as text, and what is wrong with it."""
    try:
        path.encode()
    except UnicodeEncodeError:
        return os.fsencode(path).decode("utf-8", "replace"), "the name is not UTF-8"
    return path, None


def _entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for project, root, path in zip(batch["project"], batch["root"], batch["path"]):
            rows = []
            try:
                with os.scandir(path) as found:
                    for entry in found:
                        name, error = _utf8(entry.path)
                        try:
                            is_directory, regular = entry.is_dir(follow_symlinks=False), entry.is_file()
                            mode = entry.stat().st_mode & 0o7777
                        except OSError:  # a dangling link
                            is_directory, regular, mode = False, False, 0
                        # Nothing can be read by a name that is only nearly right.
                        rows.append((project, root, name, is_directory and not error, regular and not error, mode, error))
            except OSError as fault:  # the entries seen so far stay
                rows.append((project, root, path, False, False, 0, fault.strerror or type(fault).__name__))
            yield pd.DataFrame(rows, columns=[column.split()[0] for column in _ENTRY.split(", ")])


def list_trees(roots: DataFrame) -> DataFrame:
    """Manifest ``(project, root, path, is_regular, mode, error)`` of directories on a shared mount.

    ``roots (project, root)``. One round per directory level: all directories of a level are listed in
    parallel, so a huge project spreads over the cluster like many small ones. Hidden files are kept.
    A directory that may not be read or is gone, and an entry whose name is no UTF-8, are rows with an ``error`` that are no
    regular files; listing goes on.
    """
    level = roots.select("project", "root", F.col("root").alias("path"))
    rounds = []
    while not level.isEmpty():
        listed = stage(level.repartition("project", "path").mapInPandas(_entries, _ENTRY), "tree-level")
        rounds.append(listed.filter(~F.col("is_directory")).drop("is_directory"))
        level = listed.filter("is_directory").select("project", "root", "path")
    if not rounds:
        return roots.select("project", "root", F.lit("").alias("path"), F.lit(False).alias("is_regular"), F.lit(0).alias("mode"), F.lit(None).cast("string").alias("error")).limit(0)
    return reduce(DataFrame.unionByName, rounds)


def read_trees(spark: SparkSession, base: str) -> DataFrame:
    """Files below ``base/<project>/`` with their text, from any file system Spark reads.

    Spark's file index leaves out names that begin with a dot or an underscore; use :func:`list_trees`
    where those count. A file that is no UTF-8 has no text and is not readable. Contents are read only if ``text`` or
    ``is_readable`` is selected.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    relative = F.regexp_extract("path", r"^[a-z0-9]+:/*" + _quoted(base.split(":", 1)[-1].strip("/")) + r"/([^/]+)/(.*)$", 2)
    project = F.regexp_extract("path", r"^[a-z0-9]+:/*" + _quoted(base.split(":", 1)[-1].strip("/")) + r"/([^/]+)/", 1)
    content = F.col("content").cast("string")
    valid = F.is_valid_utf8(content)
    return files.select(
        project.alias("project"),
        relative.alias("filename"),
        valid.alias("is_readable"),
        F.when(valid, content).alias("text"),
    ).filter("project <> ''")


def _quoted(text: str) -> str:
    return "".join("\\" + c if not (c.isalnum() or c in "/_") else c for c in text)
