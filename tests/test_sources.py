from __future__ import annotations

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lintlake.operators import analysers, catalog, paths
from lintlake.sources import catalog_store, trees


@pytest.fixture
def tree(tmp_path):
    for name, text in {"p/src/a.py": "x = 1\n", "p/.git/HEAD": "ref", "p/.gitignore": "*", "q/b.js": "é"}.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    os.chmod(tmp_path / "q/b.js", 0o640)
    return tmp_path


def test_list_trees(table, tree):
    roots = table([("p", str(tree / "p")), ("q", str(tree / "q"))], "project string, root string")
    manifest = trees.list_trees(roots)
    listed = paths.list_files(paths.split_readable(manifest))
    found = {(r.project, r.filename): r.is_readable for r in listed.collect()}
    assert found == {("p", "src/a.py"): True, ("p", ".gitignore"): True, ("q", "b.js"): False}


def test_listing_goes_on_after_faults(table, tree):
    (tree / "p" / "after").mkdir()
    (tree / "p" / "after" / "z").write_text("z")
    os.mkdir(os.fsencode(tree / "p") + b"/dir\xff")
    with open(os.fsencode(tree / "p") + b"/name\xff", "w"):
        pass
    roots = table([("p", str(tree / "p")), ("gone", str(tree / "gone")), ("file", str(tree / "q/b.js"))], "project string, root string")
    manifest = trees.list_trees(roots)
    faults = {(r.project, r.path.rpartition("/")[2], r.error) for r in manifest.filter("error is not null").collect()}
    assert faults == {
        ("p", "dir\ufffd", "the name is not UTF-8"), ("p", "name\ufffd", "the name is not UTF-8"),
        ("gone", "gone", "No such file or directory"), ("file", "b.js", "Not a directory"),
    }
    listed = paths.list_files(paths.split_readable(manifest))
    assert {(r.project, r.filename) for r in listed.collect()} == {("p", "src/a.py"), ("p", ".gitignore"), ("p", "after/z")}


def test_read_trees(spark, tree):
    read = trees.read_trees(spark, str(tree)).select("project", "filename", "text")
    assert {tuple(r) for r in read.collect()} == {("p", "src/a.py", "x = 1\n"), ("q", "b.js", "é")}


def test_catalog_store(spark, table, tmp_path):
    path = str(tmp_path / "catalog")
    schema = table([], "uuid string, n int, languages array<string>").schema
    assert catalog_store.read_catalog(spark, path, schema) is None
    catalog_store.save_catalog(table([("u", 1, ["Python"])], "uuid string, n int, languages array<string>"), path)
    assert [tuple(r) for r in catalog_store.read_catalog(spark, path, schema).collect()] == [("u", 1, ["Python"])]
    catalog_store.save_catalog(table([("v", None, [])], "uuid string, n int, languages array<string>"), path)
    assert [tuple(r) for r in catalog_store.read_catalog(spark, path, schema).collect()] == [("v", None, [])]
    catalog_store.invalidate_catalog(spark, path)
    assert catalog_store.read_catalog(spark, path, schema) is None
    broken = tmp_path / "broken"
    broken.write_text('[{"uuid": "u", ')
    assert catalog_store.read_catalog(spark, str(broken), schema, multi_line=True) is None


def test_unknown_languages_are_dropped(table):
    schema = "uuid string, prefix string, languages array<string>, config_filenames array<string>"
    tools = catalog.normalize_tools(table([("u", None, ["Python", "NotFound"], []), ("v", "V_", ["NotFound"], ["x"])], schema))
    assert [(r.prefix, r.languages, r.has_config_file) for r in tools.collect()] == [("", ["Python"], False), ("V_", [], True)]


def test_strict_vocabulary(table):
    schema = "uuid string, id string, level string, category string, sub_category string"
    good = table([("u", "a", "Info", "Security", None)], schema)
    assert catalog.check_vocabulary(good, strict=True).count() == 0
    bad = table([("u", "a", "Loud", "Security", None)], schema)
    with pytest.raises(Exception, match="unknown level: Loud"):
        catalog.check_vocabulary(bad, strict=True).collect()


def test_a_failing_analyser_fails_its_run_only(spark, table):
    schema = "project string, tool string, language string, filename string, text string"
    rows = [("p", "t", "L", f"f{i}", "fine") for i in range(30)] + [("q", "t", "L", f"f{i}", "bad" if i == 29 else "fine") for i in range(30)]

    def analyse(files: pd.DataFrame) -> pd.DataFrame:
        if (files["text"] == "bad").any():
            raise ValueError("boom")
        return pd.DataFrame({"filename": files["filename"], "size": files["text"].str.len()})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = analysers.custom_analyser(table(rows, schema), analyse, "filename string, size int").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sum(r.project == "p" and r.success and r.size == 4 for r in out) == 30
    assert [(r.success, r.error) for r in out if r.project == "q"] == [(False, "boom")]


def test_saving_a_catalog_keeps_the_old_one_until_the_new_one_is_whole(spark, table, tmp_path):
    path, schema = str(tmp_path / "versions-of-a-catalog"), "uuid string, n int"
    catalog_store.save_catalog(table([("a", 1), ("b", None)], schema), path)
    stored = catalog_store.read_catalog(spark, path, table([], schema).schema)
    catalog_store.save_catalog(stored.withColumn("n", F.coalesce("n", F.lit(0)) + 1), path)  # derived from itself
    again = catalog_store.read_catalog(spark, path, stored.schema)
    assert {tuple(r) for r in again.collect()} == {("a", 2), ("b", 1)}
    assert {tuple(r) for r in stored.collect()} == {("a", 1), ("b", None)}  # readers of the old version go on
    broken = again.withColumn("n", F.when(F.col("uuid") == "b", F.raise_error(F.lit("halfway"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="halfway"):
        catalog_store.save_catalog(broken, path)
    assert {tuple(r) for r in catalog_store.read_catalog(spark, path, stored.schema).collect()} == {("a", 2), ("b", 1)}
    assert catalog_store.drop_old_versions(spark, path, 3600) == 0
    assert catalog_store.drop_old_versions(spark, path, -60) >= 1
    assert catalog_store.read_catalog(spark, path, stored.schema).count() == 2
    catalog_store.invalidate_catalog(spark, path)
    assert catalog_store.read_catalog(spark, path, stored.schema) is None
