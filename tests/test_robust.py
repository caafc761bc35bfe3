"""Input that must not fail a whole job."""

from __future__ import annotations

import pandas as pd

from lintlake.operators import analysers
from lintlake.sources import tables, trees


def test_undecodable_files_are_unreadable(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "good.txt").write_text("ä\n", encoding="utf-8")
    (tmp_path / "p" / "bad.bin").write_bytes(b"\xff\xfe\x00")
    rows = {r["filename"]: (r["is_readable"], r["text"]) for r in trees.read_trees(spark, str(tmp_path)).collect()}
    assert rows == {"good.txt": (True, "ä\n"), "bad.bin": (False, None)}


def test_runs_with_null_keys_keep_results_and_failures(table):
    files = table(
        [("p", "t", None, "a"), ("p", "t", None, "b"), ("p", "t", "x", "c"), ("q", None, "x", "bad"), ("q", None, "x", "d")],
        "project string, tool string, language string, filename string",
    )

    def analyse(part: pd.DataFrame) -> pd.DataFrame:
        if (part["filename"] == "bad").any():
            raise ValueError("no")
        return part[["filename"]].rename(columns={"filename": "found"})

    rows = analysers.custom_analyser(files.coalesce(1), analyse, "found string").collect()
    assert sorted((r["project"], r["language"] or "", r["found"] or "", r["success"]) for r in rows) == [
        ("p", "", "a", True), ("p", "", "b", True), ("p", "x", "c", True), ("q", "x", "", False)
    ]


def test_reading_a_table_shuffles_nothing(spark):
    plan = tables.read_table(spark, "/root/testdata/sf0.001/documents.parquet")._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Repartition" not in plan
