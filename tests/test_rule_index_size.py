"""Rules as many as files: the index is merged, not broadcast, and holds all the same."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lintlake.operators import paths


def plan(frame, capsys):
    capsys.readouterr()
    frame.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("n_rules", [50, 150_000])
def test_rules_by_their_measured_size(spark, capsys, n_rules):
    name = F.concat(F.lit("src/f"), F.col("id").cast("string"))
    lone = spark.createDataFrame([("p", "global", None, "glob", "*.md"), ("p", "global", None, "regex", "doc/[0-9]+")], "project string, scope string, tool string, kind string, value string")
    rules = spark.range(n_rules).select(
        F.lit("p").alias("project"), F.lit("global").alias("scope"), F.lit(None).cast("string").alias("tool"),
        F.lit("path").alias("kind"), name.alias("value"),
    ).unionByName(lone)
    names = ["src/f7", "src/f7/x", "src/f7x", "src/f49", f"src/f{n_rules}", "a.md", "doc/12", "doc/a"]
    files = spark.createDataFrame([("p", n) for n in names] + [("q", "src/f7")], "project string, filename string")
    kept = paths.filter_global(files, rules)
    shown = plan(kept, capsys)
    assert ("SortMergeJoin" in shown) == (n_rules > 50)
    assert {tuple(r) for r in kept.collect()} == {("p", "src/f7x"), ("p", f"src/f{n_rules}"), ("p", "doc/a"), ("q", "src/f7")}
