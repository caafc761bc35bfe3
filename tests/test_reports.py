from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lintlake.functions import text as tx
from lintlake.operators import export, report
from lintlake.sources import results as documents

ISSUES = (
    "project string, tool string, language string, pattern_id string, filename string, message string, level string, "
    "category string, line int, column int"
)
RESULTS = ISSUES.replace("language string,", "language string, kind string,", 1)
RUNS = "project string, kind string, tool string, language string, run_order int, success boolean, error string"
TOOLS = "kind string, tool string, name string, version string, prefix string"
PATTERNS = "tool string, id string, category string, title string, description string, explanation string"


MESSAGES = {"Security": "Input reaches the shell", "Duplication": "Same block as above"}

# Fixed values, behind the two fingerprints below: the file test.js with the lines "line 1" and "line 2", and the pattern ids.


def assembled(lines):
    ordered = lines.orderBy("project", *report.SORT_COLUMNS).collect()
    return "".join(r.line for r in ordered)


def sarif_inputs(table, prefix=""):
    issues = [
        ("p", "house", "JS", f"{prefix}security-pattern-id", "test.js", "Input reaches the shell", "Error", "Security", 1, None),
        ("p", "house", "JS", f"{prefix}duplication-pattern-id", "test.js", "Same block as above", "Error", "Duplication", 2, None),
    ]
    patterns = [
        ("house", f"{kind.lower()}-pattern-id", kind, f"{kind} finding", f"Looks for {kind} trouble", f"Mend {kind} trouble early")
        for kind in ("Security", "Duplication")
    ]
    return (
        table(issues, ISSUES),
        table([("issues", "house", "house Checks", "v1.0.0", prefix)], TOOLS),
        table(patterns, PATTERNS),
        table([("p", "test.js", "line 1\nline 2")], "project string, filename string, text string"),
        table([("p", "issues", "house", "JS", 1, True, None), ("p", "issues", "broken", "JS", 2, False, "x")], RUNS),
    )


@pytest.mark.parametrize("compat", [True, False])
@pytest.mark.parametrize("legacy", [True, False])
def test_sarif_document(table, compat, legacy):
    issues, tools, patterns, files, runs = sarif_inputs(table)
    sorted_out = report.split_security(issues, tools, patterns)
    document = report.sarif_document(
        runs,
        runs,
        tools,
        report.sarif_rules(sorted_out, patterns),
        report.indexed_artifacts(issues),
        report.sarif_results(issues, tools, patterns, files, compat=compat, legacy_rule_index=legacy),
        information_uri="https://example.org",
        name_suffix=" (reported)",
        root_uri="file:///src",
    )

    def rule(kind):
        text = f"Looks for {kind} trouble"
        return {
            "id": f"{kind.lower()}-pattern-id", "name": f"{kind} finding", "shortDescription": {"text": text},
            "help": {"text": text, "markdown": f"Mend {kind} trouble early"}, "properties": {"category": kind},
        }

    def result(index, kind, line, level, fingerprint):
        place = {"artifactLocation": {"index": 0, "uri": "test.js"}, "region": {"startLine": line, "startColumn": 1}}
        return {
            "ruleIndex": index, "ruleId": f"{kind.lower()}-pattern-id", "message": {"text": MESSAGES[kind]}, "level": level,
            "locations": [{"physicalLocation": place}],
            "partialFingerprints": {"primaryLocationStartColumnFingerprint": "1", "primaryLocationLineHash": fingerprint},
        }

    assert json.loads(assembled(document)) == {
        "$schema": report.SARIF_SCHEMA,
        "version": "2.1.0",
        "runs": [
            {
                "tool": {
                    "driver": {
                        "name": "House Checks (reported)",
                        "version": "1.0.0",
                        "informationUri": "https://example.org",
                        "rules": [rule("Security"), rule("Duplication")],
                    }
                },
                "results": [
                    result(0, "Security", 1, "error", "58405b1dbe14c855b9ae39a4ac1f6a"),
                    result(0 if legacy else 1, "Duplication", 2, "warning" if compat else "error", "556f62f844c32ae92c4b9591faa54dec"),
                ],
                "invocations": [{"executionSuccessful": True, "workingDirectory": {"uri": "file:///src"}}],
                "artifacts": [{"location": {"uri": "test.js"}}],
            }
        ],
    }


def test_prefixed_patterns_find_their_rules(table):
    issues, tools, patterns, files, _ = sarif_inputs(table, prefix="X_")
    flat = report.sarif_results(issues, tools, patterns, files).collect()
    assert {(r.rule_id, r.is_security, r.rule_index) for r in flat} == {
        ("X_security-pattern-id", True, 0),
        ("X_duplication-pattern-id", False, 1),
    }


def one_result(category=None):
    return ("p", "lint-x", "any", "Issue", "P7", "one.py", "unused name", "Info", category, 1, 1)


@pytest.mark.parametrize(("category", "shown"), [(None, ""), ("UnusedCode", '"category":"UnusedCode",')])
def test_nested_report(table, category, shown):
    runs = table([("p", "issues", "lint-x", "any", 1, True, None)], RUNS)
    files = table([("p", "lint-x", "any", "one.py")], "project string, tool string, language string, filename string")
    lines = export.issues_report(runs, files, table([one_result(category)], RESULTS))
    assert assembled(lines) == (
        '[{"tool":"lint-x","issues":{"Success":{"results":[{"filename":"one.py","results":[{"Issue":{"patternId":{"value":"P7"},'
        f'"filename":"one.py","message":{{"text":"unused name"}},"level":"Info",{shown}'
        '"location":{"FullLocation":{"line":1,"column":1}}}}]}]}}}]'
    )


def test_nested_report_of_a_failure(table):
    runs = table([("p", "issues", "lint-x", "any", 1, False, "out of memory")], RUNS)
    nothing = table([], RESULTS)
    lines = export.issues_report(runs, nothing.select("project", "tool", "language", "filename"), nothing)
    assert assembled(lines) == '[{"tool":"lint-x","issues":{"Failure":{"message":"out of memory"}}}]'


CLONES = "project string, language string, clone_id string, clone_lines string, nr_tokens int, nr_lines int"
PLACES = "project string, language string, clone_id string, nr_lines int, nr_tokens int, filename string, start_line int, end_line int"
METRICS = (
    "project string, filename string, complexity int, loc int, cloc int, nr_methods int, nr_classes int, "
    "line_complexities array<struct<line:int,value:int>>"
)


@pytest.fixture
def everything(table):
    results = table([one_result(), ("p", "t", "any", "FileError", None, "bad", 'say "no"', None, None, None, None)], RESULTS)
    metrics = table([("p", "m", 1, None, None, None, None, [(3, 4)]), ("p", "n", None, None, None, None, None, [])], METRICS)
    clones = table([("p", "L", "c1", "x\ny", 9, 5), ("p", "L", "c2", "z", 8, 6)], CLONES)
    places = table(
        [("p", "L", "c1", 5, 9, "a", 1, 5), ("p", "L", "c1", 5, 9, "a", 11, 15), ("p", "L", "c1", 5, 9, "b", 2, 6),
         ("p", "L", "c2", 6, 8, "a", 20, 25), ("p", "L", "c2", 6, 8, "b", 7, 12)], PLACES,
    )
    return results, metrics, clones, places


def test_json_document_round_trip(spark, table, everything, tmp_path):
    results, metrics, clones, places = everything
    records = report.render_json(results, metrics).unionByName(report.clone_json_lines(clones, places))
    projects = table([("p",), ("empty",)], "project string")
    document = report.json_document(projects, records)
    path = str(tmp_path / "report")
    documents.write_document(document, path)
    whole = {}
    for project in ("p", "empty"):
        parts = sorted((tmp_path / "report" / f"project={project}").glob("part-*"))
        whole[project] = "".join(p.read_text() for p in parts)
    assert json.loads(whole["empty"]) == []
    members = json.loads(whole["p"])
    assert [next(iter(m)) for m in members] == ["FileError", "Issue", "FileMetrics", "FileMetrics", "DuplicationClone", "DuplicationClone"]
    assert members[1]["Issue"]["category"] is None, "nulls are kept"
    assert members[4]["DuplicationClone"]["files"][1] == {"filePath": "a", "startLine": 11, "endLine": 15}

    (tmp_path / "one.json").write_text(whole["p"])
    decoded = documents.read_results(spark, str(tmp_path / "one.json"))
    assert documents.issues(decoded).first().column == 1
    assert documents.file_errors(decoded).first().message == 'say "no"'
    assert {r.filename: r.line_complexities for r in documents.metrics(decoded).collect()} == {"m": [(3, 4)], "n": []}
    assert documents.clone_occurrences(decoded).count() == 5


def test_text_document(table, everything):
    results, metrics, _, places = everything
    lines = report.text_document(table([("p",)], "project string"), report.render_text(results, metrics, places))
    text = [r.line for r in lines.orderBy("project", *report.SORT_COLUMNS).collect()]
    assert text == [
        "Starting analysis ...",
        'Found say "no" in bad',
        "Found [Info] `unused name` in one.py:1:1 (P7)",
        "Found [Metrics] in m:\n  CC - 1",
        "No [Metrics] found in n.",
        "Found [Clone] 5 duplicated lines with 9 tokens:",
        "  a\n    l. 1 - 5\n    l. 11 - 15",
        "  b\n    l. 2 - 6",
        "Found [Clone] 6 duplicated lines with 8 tokens:",
        "  a\n    l. 20 - 25",
        "  b\n    l. 7 - 12",
        "Analysis complete",
    ]
    coloured = results.filter("kind = 'Issue'").select(report.issue_text(colour=True)).first()[0]
    assert coloured.startswith("Found [\x1b[34mInfo\x1b[0m")


@pytest.mark.parametrize(
    ("text", "loc"),
    [("", 0), ("ab\nabc", 1), ("  ab \n\t a b \r\nabc\r\rxyz\n", 3), ("\x00abc\x1f", 1), ("a\u00a0b", 1), ("😀a", 1), ("😀", 0), (None, None)],
)
def test_lines_of_code(table, text, loc):
    assert table([(text,)], "t string").select(tx.count_loc(F.col("t"))).first()[0] == loc


def test_line_splitting(table):
    rows = table([("a\r\nb\rc\n\n",), ("",), ("x",)], "t string").select(tx.split_lines(F.col("t")), tx.normalize_lines(F.col("t")))
    assert [r[0] for r in rows.collect()] == [["a", "b", "c", ""], [""], ["x"]]
    messy = table([(" a \t b\n\n \x0b\n\tc  d ",)], "t string").select(tx.normalize_lines(F.col("t"))).first()[0]
    assert messy == "a b\n\n\nc d"


def test_prefixes(table):
    row = table([("A_x", "A_", "src"), ("x", "A_", None), ("x", None, "src")], "id string, prefix string, sub string")
    assert [r[0] for r in row.select(tx.strip_prefix(F.col("id"), F.col("prefix"))).collect()] == ["x", "x", "x"]
    added = row.select(tx.append_sub_directory(F.col("sub"), F.lit("f")).alias("full"), "sub")
    assert [r[0] for r in added.collect()] == ["src/f", "f", "src/f"]
    assert [r[0] for r in added.select(tx.remove_sub_directory(F.col("sub"), F.col("full"))).collect()] == ["f", "f", "f"]
    assert row.select(tx.tool_label(F.lit("eSLint"), "!"), tx.tool_version(F.lit(None).cast("string"))).first()[:] == ("ESLint!", "0.0.0-unknown")
