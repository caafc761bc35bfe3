"""User code that compares files, united in a tree of partial states."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lintlake.operators import analysers

SCHEMA = "name string, files string"


def by_name(file: pd.DataFrame) -> dict[str, list[str]]:
    path = file["filename"].iat[0]
    return {path.rsplit("/", 1)[-1]: [path]}


def joined(a: list[str], b: list[str]) -> list[str]:
    return sorted(a + b)


def repeated(name: str, paths: list[str]) -> pd.DataFrame | None:
    return pd.DataFrame({"name": [name], "files": [" ".join(paths)]}) if len(paths) > 1 else None


def whole(files: pd.DataFrame) -> pd.DataFrame:
    found = files.assign(name=files["filename"].str.rsplit("/", n=1).str[-1]).groupby("name")["filename"].agg(lambda x: sorted(x))
    found = found[found.map(len) > 1]
    return pd.DataFrame({"name": found.index, "files": found.map(" ".join)})


def rows(frame) -> list[tuple]:
    return sorted(frame.select("project", "success", "error", "name", "files").collect(), key=str)


@pytest.mark.parametrize("fan_in", [2, 64])
def test_a_large_run_equals_the_whole_run_in_one_task(spark, monkeypatch, fan_in):
    monkeypatch.setattr(analysers, "HELD_KEYS", 500)
    # Names shared by two files each, and one name of a third of all files.
    n = 100_000 if fan_in == 64 else 3_000
    name = F.when(F.col("id") % 3 == 0, F.lit("index.js")).otherwise(F.concat(F.lit("f"), (F.col("id") % (n // 2)).cast("string")))
    files = spark.range(n).repartition(16).select(
        F.lit("p").alias("project"), F.lit("t").alias("tool"), F.lit(None).cast("string").alias("language"),
        F.concat(F.lit("d"), F.col("id").cast("string"), F.lit("/"), name).alias("filename"),
    )
    apart = analysers.merging_analyser(files, by_name, joined, repeated, SCHEMA, fan_in=fan_in)
    assert rows(apart) == rows(analysers.custom_analyser(files, whole, SCHEMA, whole_runs=True))


@pytest.mark.parametrize("step", ["map", "merge", "finish"])
def test_a_failure_in_any_step_fails_its_run_only(table, step):
    def breaks(at: str, paths: list[str]) -> None:
        if at == step and any(p.startswith("bad/") for p in paths):
            raise ValueError(f"no {at}")

    def mapping(file):
        breaks("map", [file["filename"].iat[0]])
        return by_name(file)

    def merging(a, b):
        breaks("merge", a + b)
        return joined(a, b)

    def finishing(name, paths):
        breaks("finish", paths)
        return repeated(name, paths)

    data = [(p, "t", "x", f"{d}/a") for p in ("p", None) for d in "123456"] + [("q", "t", "x", f"{d}/a") for d in ("1", "bad", "2", "3", "4")]
    files = table(data, "project string, tool string, language string, filename string").repartition(6)
    found = rows(analysers.merging_analyser(files, mapping, merging, finishing, SCHEMA, fan_in=2))
    all_six = "1/a 2/a 3/a 4/a 5/a 6/a"
    assert found == sorted([("p", True, None, "a", all_six), (None, True, None, "a", all_six), ("q", False, f"no {step}", None, None)], key=str)


def test_empty_tables_and_files_without_states(table):
    schema = "project string, tool string, language string, filename string"
    empty = table([], schema)
    assert analysers.merging_analyser(empty, by_name, joined, repeated, SCHEMA).count() == 0
    silent = table([("p", "t", "x", "a/b")], schema)
    assert analysers.merging_analyser(silent, lambda file: {}, joined, repeated, SCHEMA).count() == 0
    with pytest.raises(ValueError):
        analysers.merging_analyser(empty, by_name, joined, repeated, SCHEMA, fan_in=1)
