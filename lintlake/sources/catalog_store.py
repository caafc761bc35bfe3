"""Stored catalogs.

A catalog is saved as a version of its own, in a folder that nothing else is written to. Only when all of it is there, a
pointer that names the version and its number of rows is added; readers follow the newest pointer. A save that fails leaves
the old version in force, and a catalog may be derived from the one that it replaces. Files that were not saved here are
read as they are.

While a catalog is replaced, disk holds the old version, the new one and the shuffle files of its making. Versions are JSON
lines in gzip, a twentieth of the plain text for patterns; readers can't split such files, so they are cut by rows. Shuffle
files go when the version is written and do not wait for the driver's garbage collection.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_POINTER = "at long, version string, n_rows long"
#: Rows of a file, which one task reads. Files are closed at this number and go on in a new one, so no row is left out.
ROWS_PER_FILE = 250_000
#: Records that don't parse, and files that the decompressor itself gives up on: cut short, or not what was written.
_BROKEN = re.compile(r"MALFORMED|java\.io\.\w+: [^\n]*\s+at org\.apache\.hadoop\.io\.compress\.", re.IGNORECASE)
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffle_files_end_with_their_write(spark: SparkSession) -> Iterator[None]:
    """Writes remove their shuffle files when they are done. Only writes heed the setting, and each has shuffles of its own."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def _point(spark: SparkSession, path: str, version: str | None, n_rows: int | None) -> None:
    pointer = spark.createDataFrame([(time.time_ns(), version, n_rows)], _POINTER).coalesce(1)
    pointer.write.mode("append").json(f"{path}/pointers")


def _pointed(spark: SparkSession, path: str) -> tuple[bool, str | None, int | None]:
    """Whether there are pointers, and version and number of rows of the newest."""
    try:
        newest = spark.read.schema(_POINTER).json(f"{path}/pointers").orderBy(F.desc("at"), F.desc("version")).first()
    except AnalysisException:
        return False, None, None
    return (True, newest["version"], newest["n_rows"]) if newest else (False, None, None)


def _filled(catalog: DataFrame) -> Column:
    """Whether ``dropna("all")`` keeps a row: nulls and NaN are no values."""
    floats = {f.name for f in catalog.schema if isinstance(f.dataType, T.FloatType | T.DoubleType)}
    columns = {c: F.col(f"`{c}`") for c in catalog.columns}
    held = [column.isNotNull() & ~F.isnan(column) if c in floats else column.isNotNull() for c, column in columns.items()]
    return reduce(Column.__or__, held, F.lit(False))


def save_catalog(catalog: DataFrame, path: str) -> None:
    """Replace the stored catalog once the new one is whole."""
    spark, version = catalog.sparkSession, uuid.uuid4().hex
    folder = f"{path}/versions/{version}"
    lines = catalog.write.option("ignoreNullFields", "false").option("maxRecordsPerFile", ROWS_PER_FILE)
    with _shuffle_files_end_with_their_write(spark):
        lines.option("compression", "gzip").json(folder)
    _point(spark, path, version, spark.read.text(folder).count())


def invalidate_catalog(spark: SparkSession, path: str) -> None:
    """Forget the stored catalog: it reads as absent."""
    _point(spark, path, None, None)


def drop_old_versions(spark: SparkSession, path: str, older_than_seconds: float) -> int:
    """Delete versions, also unfinished ones, that are older than that and not in force; how many there were."""
    _, current, _ = _pointed(spark, path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return 0
    before = (time.time() - older_than_seconds) * 1000
    old = [s for s in files.listStatus(folder) if s.getPath().getName() != current and s.getModificationTime() < before]
    for status in old:
        files.delete(status.getPath(), True)
    return len(old)


def read_catalog(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame | None:
    """The stored catalog, or ``None`` if it is missing, empty or does not decode.

    ``multi_line`` reads a JSON array per file instead of one object per line. A strict schema check has
    to look at every record once, so the catalog is decoded here and again where it is used; catalogs
    are small. A saved version that has lost rows does not decode.
    """
    saved, version, n_rows = _pointed(spark, path)
    if saved and version is None:
        return None
    folder = f"{path}/versions/{version}" if saved else path
    reader = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", str(multi_line).lower())
    try:
        catalog = reader.json(folder)
        filled, rows = catalog.agg(F.count(F.when(_filled(catalog), 1)), F.count("*")).first()
        present = filled > 0 and (not saved or rows == n_rows)
    except AnalysisException:
        return None
    except Exception as error:  # a malformed record or file surfaces as a job failure
        if not _BROKEN.search(str(error)):
            raise
        return None
    return catalog if present else None
