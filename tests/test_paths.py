from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lintlake.functions import globs, languages as lang, paths as px
from lintlake.operators import paths

RULES = "project string, scope string, tool string, kind string, value string"
FILES = "project string, filename string"
RUNS = "project string, kind string, tool string, language string"

KEPT = [
    "src/main/scala/acme/Engine.scala",
    "src/main/scala/acme/check/Check.scala",
    "src/main/scala/acme/Test1.scala",
    "src/main/scala/acme/TestWeird.sc",
]


def scope(table, files, rules, tool="style", language="Scala"):
    listing = table([("p", f) for f in files], FILES)
    ruled = table([("p", *r) for r in rules], RULES)
    extensions = table([("p", "Scala", ".sc")], "project string, language string, suffix string")
    runs = table([("p", "issues", tool, language)], RUNS)
    kept = paths.filter_tool(runs, paths.filter_global(listing, ruled), ruled, extensions)
    return {r.filename for r in kept.collect()}


def test_remote_excludes(table):
    files = [*KEPT, "src/main/scala/acme/check/Test2.scala", "README.md"]
    rules = [("global", None, "path", "src/main/scala/acme/check/Test2.scala")]
    assert scope(table, files, rules) == set(KEPT)


def test_local_excludes(table):
    files = [*KEPT, "src/main/scala/acme/check/Test2.scala", "other/Test1.scala", "other/check/Test2.scala"]
    rules = [
        ("global", None, "path", "src/main/scala/acme/check/Test2.scala"),
        ("global", None, "glob", "**/Test1.scala"),
        ("tool", "style", "glob", "**/check/Test2.scala"),
    ]
    assert scope(table, files, rules) == set(KEPT) - {"src/main/scala/acme/Test1.scala"}
    assert "other/check/Test2.scala" in scope(table, files, rules, tool="another")


def test_default_ignores(table):
    files = [*KEPT, "src/main/scala/acme/check/Test2.scala", "other/main/scala/acme/check/Test3000.scala"]
    rules = [("global", None, "regex", ".*/main/scala/acme/check/.*")]
    assert scope(table, files, rules) == set(KEPT) - {"src/main/scala/acme/check/Check.scala"}


def test_path_rules_compare_components(table):
    files = ["src/a.scala", "src2/a.scala", "src", "x/src/a.scala"]
    kept = paths.exclude_paths(table([("p", f) for f in files], FILES), table([("p", "global", None, "path", "src")], RULES))
    assert {r.filename for r in kept.collect()} == {"src2/a.scala", "x/src/a.scala"}


def test_regex_with_back_reference(table):
    files = table([("p", f) for f in ("aa", "ab", "xyx", "b")], FILES)
    rules = table([("p", "global", None, "regex", r) for r in (r"(.)\1", "b", r"(x).\1")], RULES)
    assert [r.filename for r in paths.exclude_regex(files, rules).collect()] == ["ab"]


def test_local_configuration_switches_default_ignores_off(table):
    rules = table([(p, "global", None, k, "x") for p in "ab" for k in ("regex", "path")], RULES)
    left = paths.effective_rules(rules, table([("a",)], "project string")).collect()
    assert sorted((r.project, r.kind) for r in left) == [("a", "path"), ("b", "path"), ("b", "regex")]


GLOBS = [
    "**/Test1.scala", "spec/**/*", "spec/**", "*.rb", "**.rb", "a?c", "?", "{a,b}.js", "src/{x,y*}/*.{js,ts}", "[a-c].js",
    "[!a-c].js", ".bundle/", "vendor/**", r"\*.js", "a.b", "a+b(1).js", "a,b", "[^a]", "[a^]", "**", "*", "x[[]y",
]
PATHS = [
    "Test1.scala", "a/Test1.scala", "a/b/Test1.scala", "spec/a.rb", "spec/x/a.rb", "a.rb", "x/a.rb", "abc", "a/c", "a.js",
    "b.js", "c.js", "d.js", "src/x/1.js", "src/yy/2.ts", "src/z/1.js", "src/x/y/1.js", ".bundle/x", "vendor/a/b", "vendor",
    "*.js", "axb", "a.b", "a+b(1).js", "a,b", "a", "b", "^", "x[y", "/x", "ax",
]


def test_globs_agree_with_the_file_system(spark, table):
    """The Java platform's own matcher decides what a glob means."""
    compiled = table([(g,) for g in GLOBS], "glob string").select("glob", globs.glob_to_regex(F.col("glob")).alias("r"))
    files = table([(p,) for p in PATHS], "path string")
    anchored = F.concat(F.lit("^(?:"), "r", F.lit(r")\z"))
    rows = compiled.join(files, F.lit(True)).select("glob", "path", globs.matches(F.col("path"), anchored).alias("hit"))
    mine = {(r.glob, r.path) for r in rows.collect() if r.hit}
    system = spark._jvm.java.nio.file.FileSystems.getDefault()
    theirs = set()
    for glob in GLOBS:
        matcher = system.getPathMatcher(f"glob:{glob}")
        empty = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)
        theirs |= {(glob, p) for p in PATHS if matcher.matches(system.getPath(p, empty))}
    assert mine == theirs


@pytest.mark.parametrize(
    ("files", "custom", "expected"),
    [
        (["test.js", "Test.java", "SomeClazz.rb"], [], {"Java", "Ruby", "Javascript"}),
        (
            ["test.css", "test.js-to_kotlin", "Test-1.java-to_ruby", "test-rb.resource"],
            [("Ruby", "-rb.resource"), ("Ruby", "-1.java-to_ruby"), ("Kotlin", ".js-to_kotlin")],
            {"Kotlin", "Ruby", "CSS"},
        ),
        (["test.exotic", "test-rb.nobody"], [], set()),
        (["MyGemfile", "a/Dockerfile", "x.js.md"], [], {"Ruby", "Dockerfile", "Markdown"}),
        (["a.rb"], [("Python", "b")], {"Python"}),
    ],
)
def test_languages(table, files, custom, expected):
    extensions = table([("p", *c) for c in custom], "project string, language string, suffix string")
    found = paths.detect_languages(table([("p", f) for f in files], FILES), extensions)
    assert {r.language for r in paths.project_languages(found).collect()} == expected


def test_longest_suffix_and_every_language(table):
    suffixes = {"A": [".h"], "B": [".h", ".x.h"], "C": ["file"]}
    row = table([("q.x.h",), ("file",), ("none",)], "f string").select(
        lang.builtin_language(F.col("f"), suffixes).alias("one"), lang.builtin_languages(F.col("f"), suffixes).alias("all")
    )
    assert [(r.one, sorted(r.all)) for r in row.collect()] == [("B", ["A", "B"]), ("C", ["C"]), (None, [])]


def test_configuration_files_match_by_component(table):
    files = [("p", "a/.lintrc", True), ("q", "a/x.lintrc", True), ("r", "conf/lint.yml", True), ("s", "lint.yml", True), ("t", ".lintrc", False)]
    tools = table([("one", True, [".lintrc"]), ("two", True, ["conf/lint.yml"])], "tool string, has_config_file boolean, config_filenames array<string>")
    pairs = table([(p, t) for p in "pqrst" for t in ("one", "two")], "project string, tool string")
    found = paths.has_config_files(table(files, "project string, filename string, is_readable boolean"), tools, pairs)
    assert {(r.project, r.tool) for r in found.collect() if r.has_config_files} == {("p", "one"), ("r", "two")}


def test_path_expressions(table):
    row = table([("a/b/c.js",)], "f string").select(
        px.ancestors(F.col("f")), px.basename(F.col("f")), px.first_component(F.col("f")), px.ends_with_path(F.col("f"), F.lit("b/c.js"))
    )
    assert row.first()[:] == (["a", "a/b", "a/b/c.js"], "c.js", "a", True)


RULES = "project string, scope string, tool string, kind string, value string"


def test_rules_fail_on_their_own(spark, table):
    names = ["src/a1.js", "src/a2.js", "lib/b.js", "x/y/z.py", "x/y", "top.py", "aa/aa", "ab/aa"]
    files = table([(p, n) for p in ("p", "q") for n in names], "project string, filename string")
    rules = [("p", "regex", "(?<n>src)/a1.*"), ("p", "regex", "(?<n>lib)/.*"), ("p", "regex", "("), ("p", "regex", r"(aa)/\1"),
             ("p", "glob", "[z-a]"), ("p", "path", "x/y"), ("q", "glob", "**/*.py"), ("q", "glob", "src/*2.js"), ("q", "regex", "(?x) top # .py")]
    frame = table([(p, "global", None, k, v) for p, k, v in rules], RULES)
    left = {tuple(r) for r in paths.filter_global(files, frame).collect()}
    assert {n for p, n in left if p == "p"} == {"src/a2.js", "top.py", "ab/aa"}
    assert {n for p, n in left if p == "q"} == {*names} - {"x/y/z.py", "src/a2.js"}
    assert {r.value for r in paths.broken_rules(frame).collect()} == {"(", "[z-a]", "(?x) top # .py"}


def test_a_project_with_very_many_paths(spark):
    paths_of = spark.range(100_000).selectExpr("'p' as project", "'global' as scope", "cast(null as string) as tool", "'path' as kind", "concat('d/', id, '/x') as value")
    files = spark.range(1000).selectExpr("'p' as project", "concat('d/', id * 200, '/x/f', id, '.js') as filename")
    assert paths.exclude_paths(files, paths_of).count() == 500
    kept = paths.exclude_paths(files, paths_of)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "CartesianProduct" not in plan


def test_globs_in_chunks(spark, table):
    files = table([("p", f"src/f{i}.js") for i in range(400)], "project string, filename string")
    rules = table([("p", "global", None, "glob", f"src/*f{i}.js") for i in range(0, 400, 2)], RULES)
    index = paths.rule_index(rules).collect()
    assert 1 < len(index) < 10 and {(r.depth, r.key) for r in index} == {(1, "src")}
    expected = {f"src/f{i}.js" for i in range(400)} - {f"src/f{i}.js" for i in range(0, 400, 2)}
    assert {r.filename for r in paths.exclude_globs(files, rules).collect()} == expected
