from __future__ import annotations

import random
import time

import pytest

from lintlake.functions import regexes
from lintlake.operators import analysers

PATTERNS = "tool string, pattern_id string, id string, regex string, level string, category string, message string, languages array<string>, enabled boolean"
FILES = "project string, tool string, language string, filename string, text string"


@pytest.mark.parametrize(
    ("regex", "literals"),
    [
        ("(?i)License", ["license"]), ("key|secret", ["key", "secret"]), ("abc?de", ["ab"]), ("abcd+ef", ["abcd"]),
        ("(foo|bar)b", ["foo", "bar"]), ("(?:foo|b)*x", ["x"]), ("eval\\(", ["eval("]), ("a{0,2}", []), ("a{3}", ["a"]),
        ("\\Qabc\\E", []), ("(?x) a b", []), ("abc(", []), ("[^]abc]", []), ("(?<n>abc)d", ["abc"]), ("ab|", []), ("", []),
        ("(?=foo)ba", ["ba"]), ("\\bconsole\\.log\\b", ["console.log"]), ("日本ab", ["ab"]), ("a|b{2", []), ("[a-z&&[^b]]c", []),
        ("(?iu)kelvin", []), ("\\1abc", []), ("x(y(z", []), ("[[:alpha:]]x", []), (None, []),
    ],
)
def test_required_literals(regex, literals):
    assert regexes.required_literals(regex) == literals


def test_every_match_contains_a_literal():
    """Random regexes of the shared syntax against the interpreter's own engine."""
    import re

    rng = random.Random(1)

    def some(depth: int) -> str:
        parts = ["a", "b", "ab", "\\.", ".", "[ab]", "A", "^", "$", "\\d"]
        out = "".join(rng.choice(parts) + rng.choice(["", "", "", "?", "*", "+", "{2}", "{0,1}"]) for _ in range(rng.randint(1, 4)))
        out = re.sub(r"([\^$])(\?|\*|\+|\{[^}]*\})", r"\1", out)
        if depth:
            out += rng.choice(["(", "(?:", "(?i:"]) + some(depth - 1) + rng.choice(["|", ""]) + some(0) + ")" + rng.choice(["", "?", "+"])
        return out

    for _ in range(3000):
        regex = some(rng.randint(0, 2))
        literals = regexes.required_literals(regex)
        for _ in range(10):
            text = "".join(rng.choice("abAB.1 ") for _ in range(rng.randint(0, 12)))
            if literals and re.search(regex, text):
                assert any(literal in text.lower() for literal in literals), (regex, text)


def test_broken_patterns_are_rows_and_end_no_job(spark, table):
    rows = [(t, f"{t}{i}", str(i), r, "Info", "X", "m", [], True) for i, (t, r) in enumerate(
        [("a", "x+"), ("a", "("), ("b", "(?<n>x)(?<n>y)"), ("b", "[z-a]"), ("b", "y"), ("c", None)])]
    patterns = table(rows, PATTERNS)
    assert {(r.tool, r.pattern_id) for r in analysers.broken_rules(patterns).collect()} == {("a", "a1"), ("b", "b2"), ("b", "b3"), ("c", "c5")}
    files = table([("p", t, "any", "f", "xx\ny\n") for t in "abc"], FILES)
    found = {(r.tool, r.pattern_id, r.line) for r in analysers.scan_issues(files, analysers.rules_of(patterns)).collect()}
    assert found == {("a", "a0", 1), ("b", "b4", 2)}


def test_two_thousand_rules(spark, table):
    """Lines meet only rules that can match; the result is that of plain matching."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(2000)]
    rows = [("t", w, w, f"(?i)\\b{w}[0-9]?\\b", "Info", "X", w, None, i % 50 > 0) for i, w in enumerate(words)]
    texts = ["\n".join(" ".join(rng.choice(words) + rng.choice(["", "7", "x"]) for _ in range(6)).upper() for _ in range(25)) for _ in range(40)]
    files = table([("p", "t", "any", f"f{i}", text) for i, text in enumerate(texts)], FILES).repartition(8).cache()
    files.count()
    rules = analysers.rules_of(table(rows, PATTERNS))
    analysers.scan_issues(files.limit(1), rules).count()
    started = time.time()
    found = {(r.filename, r.line, r.pattern_id) for r in analysers.scan_issues(files, rules).collect()}
    assert time.time() - started < 5
    on = {w for i, w in enumerate(words) if i % 50 > 0}
    expected = set()
    for i, text in enumerate(texts):
        for n, line in enumerate(text.split("\n"), 1):
            for word in line.lower().split():
                expected |= {(f"f{i}", n, w) for w in (word, word.removesuffix("7")) if w in on}
    assert found == expected
