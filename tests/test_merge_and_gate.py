from __future__ import annotations

import pytest

from lintlake.operators import gate, merge, planning

VALUES = "complexity int, loc int, cloc int, nr_methods int, nr_classes int, line_complexities array<struct<line:int,value:int>>"
METRICS = f"project string, language string, run_order int, filename string, {VALUES}"


def test_runs_of_a_language_are_reduced_per_file(table):
    rows = [
        ("p", "Java", 1, "test2.java", None, 2, 2, None, None, []),
        ("p", "Java", 1, "test1.java", 1, None, None, 2, 3, [(1, 2)]),
        ("p", "Java", 2, "test1.java", None, 200, 222, None, None, []),
        ("p", "Java", 2, "test2.java", 100, None, None, 23, None, [(12, 2), (66, 6)]),
    ]
    merged = merge.reduce_metrics(table(rows, METRICS)).orderBy("filename").collect()
    assert [tuple(r)[2:] for r in merged] == [
        ("test1.java", 1, 200, 222, 2, 3, [(1, 2)]),
        ("test2.java", 100, 2, 2, 23, None, [(12, 2), (66, 6)]),
    ]


def test_failed_metrics_runs(table):
    runs, files = [], []
    names = {"JS": ["1.js", "2.js"], "Python": ["a.py"], "Ruby": ["a.rb"], "C": ["a.c"], "Go": ["a.go"], "Lua": ["a.lua", "b.lua"]}
    for language, members in names.items():
        order = 0
        if language != "Go":
            order = 1
            runs.append(("p", language, 1, True, None))
            files += [("p", language, 1, f) for f in members]
        runs.append(("p", language, order + 1, False, "FAILED!"))
        # The failed Lua run saw one file fewer than the successful one.
        files += [("p", language, order + 1, f) for f in (members[:1] if language == "Lua" else members)]
    keys = "project string, language string, run_order int"
    found = merge.recover_failed_metrics(
        table(runs, f"{keys}, success boolean, error string"), table(files, f"{keys}, filename string")
    ).collect()
    assert len(found) == len(runs) + 2
    assert {(r.language, r.success) for r in found if r.recovered} == {("Go", True), ("Lua", True)}
    assert {r.language for r in found if not r.success} == set(names)


def test_empty_file_sets_are_equal(table):
    runs = table([("p", "Go", 1, True, None), ("p", "Go", 2, False, "x")], "project string, language string, run_order int, success boolean, error string")
    found = merge.recover_failed_metrics(runs, table([], "project string, language string, run_order int, filename string"))
    assert not [r for r in found.collect() if r.recovered]


def test_missing_line_counts(table):
    files = table([("p", "a.go", "one\n  x\ntwo = 2\n"), ("p", "b.go", "abc\r\ndef")], "project string, filename string, text string")
    metrics = table(
        [("p", "Go", 1, "a.go", 2, None, None, 2, None, [(18, 2)]), ("p", "Go", 1, "gone.go", 1, 1, 1, 1, 1, [])], METRICS
    )
    run_files = table([("p", "Go", "a.go"), ("p", "Go", "b.go"), ("p", "Go", "lost.go")], "project string, language string, filename string")
    filled = merge.fill_missing_loc(run_files, merge.latest_metrics(metrics), files).orderBy("filename").collect()
    assert [(r.filename, r.complexity, r.loc, r.line_complexities) for r in filled] == [
        ("a.go", 2, 2, [(18, 2)]),
        ("b.go", None, 2, []),
        ("lost.go", None, None, []),
    ]


def test_clones_need_two_places_in_scope(table):
    schema = "project string, clone_id string, nr_lines int, nr_tokens int, filename string, start_line int, end_line int"
    rows = [
        ("p", "across", 18, 165, "test.js", 54, 71), ("p", "across", 18, 165, "test2.js", 13, 30),
        ("p", "inside", 22, 69, "test.js", 1, 22), ("p", "inside", 22, 69, "test.js", 33, 54),
        ("p", "short", 4, 9, "test.js", 1, 4), ("p", "short", 4, 9, "test.js", 8, 11),
    ]
    found = merge.filter_clones(table(rows, schema), table([("p", "test.js")], "project string, filename string"))
    assert {(r.clone_id, r.start_line) for r in found.collect()} == {("inside", 1), ("inside", 33)}


RUNS = "project string, kind string, tool string, language string, run_order int, success boolean, error string"
RESULTS = "project string, tool string, language string, line int"


@pytest.mark.parametrize(
    ("issues", "limit", "strict", "failed", "errors", "code"),
    [
        (3, 10, False, False, [], 0),
        (3, 2, False, False, [], 102),
        (3, 3, False, False, [], 0),
        (0, 10, False, False, [], 0),
        (0, 10, True, True, [], 101),
        (0, 10, False, True, [], 0),
        (0, 3, False, False, ["FilesAccessError"], 100),
        (0, 10, True, False, ["UploadError"], 10),
        (0, 10, True, True, ["NonExistingTool"], 13),
        (0, 10, False, False, ["UncommittedChanges"], 11),
        (9, 2, False, False, ["CommitUuidsDoNotMatch"], 12),
    ],
)
def test_gate(table, issues, limit, strict, failed, errors, code):
    runs = table(
        [("p", "issues", "one", "Scala", 1, True, None), ("p", "issues", "two", "Scala", 2, not failed, "x" if failed else None)], RUNS
    )
    # Results of failed runs do not count.
    found = [("p", "one", "Scala", i) for i in range(issues)] + ([("p", "two", "Scala", i) for i in range(99)] if failed else [])
    limits = table([("p", limit, strict)], "project string, max_allowed int, fail_if_incomplete boolean")
    counts = gate.issue_count(limits, runs, table(found, RESULTS))
    error_rows = table([("p", e) for e in errors], "project string, error_kind string")
    row = gate.quality_gate(limits, counts, gate.any_failure(runs), error_rows).first()
    assert (row.n_issues, row.any_failure, row.code) == (issues, failed, code)


def test_errors_are_joined_in_run_order(table):
    rows = [("p", 2, False, "second"), ("p", 1, False, "first"), ("p", 3, True, None), ("q", 1, True, None)]
    folded = gate.collect_errors(table(rows, "project string, run_order int, success boolean, error string"))
    assert {r.project: (r.success, r.error) for r in folded.collect()} == {"p": (False, "first\nsecond"), "q": (True, None)}


TOOLS = "tool_uuid string, kind string, tool string, languages array<string>, standalone boolean"
CATALOG = [
    ("u-pycheck", "issues", "PyCheck", ["Python"], False), ("u-brick", "issues", "Brick", ["Ruby"], False),
    ("u-cop", "issues", "Cop", ["Ruby"], False), ("u-es", "issues", "ES", ["Javascript"], False),
    ("u-alone", "issues", "Alone", ["Ruby"], True), ("u-m", "metrics", "metrics", ["Ruby"], False),
    ("u-m", "metrics", "metrics", ["Ruby"], False), ("u-d", "duplication", "duplication", ["Ruby"], False),
]
CONFIG = "project string, tool_uuid string, enabled boolean"


def test_tool_selection(table):
    tools = table(CATALOG, TOOLS)
    spoken = table([("r", "Ruby"), ("c", "Javascript"), ("c", "Python"), ("n", "Python"), ("x", "Cobol")], "project string, language string")
    config = table([("c", "u-pycheck", True), ("c", "u-es", True), ("c", "gone", False), ("n", "gone", True)], CONFIG)
    runs = planning.plan_with_fallback(config, tools, spoken).collect()
    assert {(r.project, r.tool) for r in runs} == {("r", "Brick"), ("r", "Cop"), ("c", "PyCheck"), ("c", "ES")}
    assert planning.plan_metrics_tools(tools, spoken).count() == 2, "a tool listed twice runs twice"
    errors = planning.plan_errors(spoken, planning.plan_issue_tools(tools, spoken)).collect()
    assert [r.project for r in errors] == ["x"]
    assert [r.tool_uuid for r in planning.unknown_configured_tools(config, tools).collect()] == ["gone"]
    named = planning.select_runs("COP", planning.plan_metrics_tools(tools, spoken), tools, spoken)
    assert [(r.project, r.tool) for r in named.collect()] == [("r", "Cop")]
