"""Catalogs grow with the data: no join of theirs broadcasts them, however small their files look."""

from __future__ import annotations

import pytest

from lintlake.functions.scale import stage
from lintlake.operators import catalog
from lintlake.plans.fixtures import Fixtures

TOOLS = [("u1", "Tool-1", 1, "A_", False), ("u2", "Tool-2", 2, "", True), ("u3", "tool-1", 3, "", False)]
TOOL_COLUMNS = "uuid string, short_name string, position int, prefix string, standalone boolean"


@pytest.fixture
def table(spark):
    """Rows as a table of files, whose size Spark goes by."""
    return lambda rows, schema: stage(spark.createDataFrame(rows, schema), "catalog-test")


def joins(frame, capsys):
    capsys.readouterr()
    frame.explain()
    plan = capsys.readouterr().out
    return plan.count("BroadcastHashJoin") + plan.count("BroadcastNestedLoopJoin"), plan.count("SortMergeJoin")


def rows(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=str)


def test_fallback(table, capsys):
    saved = table([("u1", "old"), ("u9", "old")], "uuid string, version string")
    fetched = table([("u1", "new"), ("u2", "new")], "uuid string, version string")
    found = catalog.tools_with_fallback(fetched, saved)
    assert joins(found, capsys) == (0, 1)
    assert rows(found, "uuid", "version") == [("u1", "new"), ("u2", "new"), ("u9", "old")]


def test_find_tool(table, capsys):
    tools = table(TOOLS, TOOL_COLUMNS)
    asked = table([(1, "TOOL-1"), (2, "u2"), (3, "none"), (4, None)], "request_id long, query string")
    found = catalog.find_tool(asked, tools)
    assert joins(found, capsys) == (0, 1)
    assert rows(found, "request_id", "uuid", "status") == [
        (1, "u1", "found"), (2, None, "standalone"), (3, None, "unknown"), (4, None, "unknown"),
    ]


def patterns(table):
    raw = [("u1", "A_x", None, ["Python"]), ("u1", "y", "Y", None), ("u2", "A_z", "Z", []), ("u8", "q", "Q", [])]
    return table(raw, "uuid string, id string, title string, languages array<string>")


def test_normalize_patterns(table, capsys):
    found = catalog.normalize_patterns(patterns(table), table(TOOLS, TOOL_COLUMNS))
    assert joins(found, capsys) == (0, 1)
    assert rows(found, "uuid", "id", "title") == [("u1", "x", "A_x"), ("u1", "y", "Y"), ("u2", "A_z", "Z")]


def test_tool_patterns(table, capsys):
    found = catalog.tool_patterns(table(TOOLS, TOOL_COLUMNS), patterns(table))
    assert joins(found, capsys) == (0, 2)
    assert rows(found, "uuid", "id") == [("u1", "A_x"), ("u1", "y"), ("u2", "A_z"), ("u3", None)]


@pytest.mark.parametrize("view", ["raw_patterns_csv", "saved_patterns", "fetched_patterns"])
def test_views(spark, capsys, view):
    broadcast, merged = joins(Fixtures(spark, "/root/testdata/sf0.001").view(view), capsys)
    assert broadcast == 0 and merged
