"""What a stored catalog takes of the disk, and that compressed versions are read and doubted as plain ones are."""

from __future__ import annotations

import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from lintlake.sources import catalog_store

SCHEMA = "uuid string, title string, level string, n long"


@pytest.fixture
def patterns(spark):
    """20,000 patterns of 500 tools, shuffled as a catalog's join shuffles them."""
    ids = spark.range(20_000).select(F.md5((F.col("id") % 500).cast("string")).alias("uuid"), "id")
    titles = ids.repartition(4, "uuid").sortWithinPartitions("uuid", "id")
    level = F.when(F.col("id") % 3 > 0, "Warning")
    return titles.select("uuid", F.concat(F.lit("Title "), "id").alias("title"), level.alias("level"), F.col("id").alias("n"))


def parts(path):
    return sorted(glob.glob(f"{path}/versions/*/part-*"))


def spoil(path, content):
    """Other content for a file, without the checksum beside it."""
    crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    with open(path, "wb") as file:
        file.write(content)


def test_versions_are_compressed_and_cut_by_rows(spark, patterns, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog_store, "ROWS_PER_FILE", 1500, raising=False)
    path = str(tmp_path / "catalog")
    catalog_store.save_catalog(patterns, path)
    plain = sum(len(json.dumps(r.asDict(), separators=(",", ":"))) + 1 for r in patterns.collect())
    assert sum(map(os.path.getsize, parts(path))) < plain / 4
    stored = catalog_store.read_catalog(spark, path, patterns.schema)
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, patterns.collect()), key=str)
    by_file = stored.groupBy(F.input_file_name()).count().collect()
    assert len(by_file) >= 20_000 / 1500 and max(r["count"] for r in by_file) <= 1500


def test_a_save_leaves_no_rows_in_shuffle_files(spark, patterns, tmp_path, monkeypatch):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        found = (files.apply(i) for i in range(files.size()))
        return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    catalog_store.save_catalog(patterns, str(tmp_path / "catalog"))  # a young JVM collects its garbage often, and files with it
    before, setting, during, write = shuffled(), spark.conf.get(key, None), [], DataFrameWriter.json
    monkeypatch.setattr(DataFrameWriter, "json", lambda *a, **k: (during.append(spark.conf.get(key, None)), write(*a, **k))[1])
    catalog_store.save_catalog(patterns, str(tmp_path / "catalog"))
    deadline = time.time() + 10
    while (left := sum(n for f, n in shuffled().items() if f not in before)) > 20_000 and time.time() < deadline:
        time.sleep(0.2)
    assert left < 20_000  # the counts of rows that follow the write are shuffled too, a few bytes each
    assert during[0] == "true" and spark.conf.get(key, None) == setting  # not only by chance of a collection


@pytest.mark.parametrize("flaw", ["none", "cut", "tail", "head", "checksum", "no file"])
def test_a_broken_version_does_not_decode(spark, patterns, tmp_path, flaw):
    path = str(tmp_path / "catalog")
    catalog_store.save_catalog(patterns, path)
    file = parts(path)[0]
    with open(file, "rb") as stream:
        good = stream.read()
    spoiled = {"none": good, "cut": good[: len(good) // 2], "tail": good[:-3], "head": b"garbage" + good[7:]}
    spoiled["checksum"] = good[:-8] + b"12345678"
    if flaw == "no file":
        os.remove(file)
    else:
        spoil(file, spoiled[flaw])
    stored = catalog_store.read_catalog(spark, path, patterns.schema)
    assert stored.count() == 20_000 if flaw == "none" else stored is None


def test_plain_versions_are_still_read(spark, table, tmp_path):
    path = str(tmp_path / "catalog")
    old = table([("u", "Title", None, 1), (None, None, None, None)], SCHEMA)
    old.write.option("ignoreNullFields", "false").json(f"{path}/versions/plain")
    for n_rows, rows in ((2, 2), (3, None)):
        catalog_store._point(spark, path, "plain", n_rows)
        stored = catalog_store.read_catalog(spark, path, old.schema)
        assert (stored and stored.count()) == rows


def test_rows_without_a_value_make_no_catalog(spark, table, tmp_path):
    schema = "uuid string, share double"
    for i, (rows, present) in enumerate([([(None, None)], False), ([(None, float("nan"))], False), ([(None, 0.5)], True), ([], False)]):
        catalog_store.save_catalog(table(rows, schema), str(tmp_path / f"catalog-{i}"))
        stored = catalog_store.read_catalog(spark, str(tmp_path / f"catalog-{i}"), table([], schema).schema)
        assert (stored is not None) == present
