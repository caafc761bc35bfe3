"""Analyses of file contents, all distributed by file.

Input is ``(project, tool, language, filename, text, ...)``, one row per file and run.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from lintlake.functions import regexes, text as tx
from lintlake.functions.scale import lookup_join, stage, weighted_join

ISSUE_COLUMNS = [
    "project", "tool", "language", "pattern_id", "filename", "message", "level", "category", "line", "column",
]


# ---------------------------------------------------------------- issues


@dataclass(frozen=True)
class Rule:
    """A line pattern of a tool. ``pattern_id`` is as reported, ``id`` without the tool prefix."""

    tool: str
    pattern_id: str
    id: str
    regex: str
    level: str
    category: str
    message: str
    languages: Sequence[str] = field(default=())
    enabled: bool = True


_RULE_SCHEMA = (
    "tool string, pattern_id string, id string, regex string, level string, category string, message string, "
    "languages array<string>, enabled boolean"
)


_RULE = ["pattern_id", "id", "regex", "level", "category", "message", "languages", "enabled", "literals"]
_HIT = ["pattern_id", "message", "level", "category"]
_HIT_TYPE = "struct<pattern_id:string,message:string,level:string,category:string,line:int,text:string>"


def broken_rules(patterns: DataFrame) -> DataFrame:
    """(tool, pattern_id, regex, error) of the patterns that do not compile."""
    error = F.concat(F.lit("Broken pattern "), F.coalesce("pattern_id", F.lit("")))
    return patterns.filter(~regexes.is_usable(F.col("regex"))).select("tool", "pattern_id", "regex", error.alias("error"))


def _literals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(literals=batch["regex"].map(regexes.required_literals))


def rules_of(patterns: DataFrame) -> DataFrame:
    """Usable rules of a pattern catalog, one row per tool, so that the plan does not grow with the catalog.

    Each rule knows strings of which a matching line contains one, see :func:`regexes.required_literals`. Patterns that
    do not compile are left out, see :func:`broken_rules`. A row is bounded by the catalog of its tool. Staged: its true
    size decides whether it is broadcast.
    """
    languages = F.coalesce("languages", F.array().cast("array<string>")).alias("languages")
    columns = [languages if c == "languages" else F.col(c) for c in ("tool", *_RULE[:-1])]
    usable = patterns.filter(regexes.is_usable(F.col("regex"))).select(*columns).coalesce(1)
    known = usable.mapInPandas(_literals, f"{_RULE_SCHEMA}, literals array<string>")
    return stage(known.groupBy("tool").agg(F.array_sort(F.collect_set(F.struct(*_RULE))).alias("_rules")), "scan-rules")


def _with_rules(files: DataFrame, rules: DataFrame, how: str) -> DataFrame:
    """Files with ``_rules`` of their tool, ``_ids`` that may run (null: as the rules say) and the text in lower case."""
    ids = F.col("pattern_ids") if "pattern_ids" in files.columns else F.lit(None).cast("array<string>")
    ruled = lookup_join(files.withColumn("_ids", ids), rules, ["tool"], spread=["filename"], how=how)
    return ruled.withColumn("_low", F.lower("text"))


def _hits() -> Column:
    """Array of ``_HIT`` with line number and line, of a row with ``_rules``, ``_ids``, ``_low`` and ``_lines``."""

    def may_run(rule: Column) -> Column:
        allowed = F.coalesce(F.array_contains("_ids", rule["id"]), rule["enabled"])
        possible = (F.size(rule["literals"]) == 0) | F.exists(rule["literals"], lambda text: F.contains("_low", text))
        return allowed & ((F.size(rule["languages"]) == 0) | F.array_contains(rule["languages"], F.col("language"))) & possible

    def hits_of(rule: Column, lines: Column) -> Column:
        # Unlike rlike, regexp_instr keeps the compiled regex from line to line.
        hit = F.filter(lines, lambda line: F.regexp_instr(line["text"], rule["regex"]) > 0)
        fields = [rule[name].alias(name) for name in _HIT]
        return F.transform(hit, lambda line: F.struct(*fields, line["line"].alias("line"), line["text"].alias("text")))

    numbered = F.transform(F.col("_lines"), lambda line, i: F.struct((i + 1).alias("line"), line.alias("text")))
    active = F.filter("_rules", may_run)
    # The lines are bound to a lambda's variable, so that no rule numbers them again.
    hits = F.transform(F.array(numbered), lambda lines: F.flatten(F.transform(active, lambda rule: hits_of(rule, lines))))
    return F.flatten(hits)


def scan_issues(files: DataFrame, rules: DataFrame | Sequence[Rule], fingerprints: bool = False) -> DataFrame:
    """Every line against the rules of the run's tool; one issue per rule and line, numbered from 1.

    ``rules`` come from :func:`rules_of`. An optional column ``pattern_ids`` names the patterns that may run;
    where it is null the rules' own ``enabled`` flags decide. ``fingerprints`` adds the fingerprint of each
    issue while its line is at hand, which saves joining the texts later. A file meets only the rules one of whose
    literals it contains, and each of these all lines, so that a regex is compiled once per file.
    """
    if not isinstance(rules, DataFrame):
        given = [(r.tool, r.pattern_id, r.id, r.regex, r.level, r.category, r.message, list(r.languages), r.enabled) for r in rules]
        rules = rules_of(files.sparkSession.createDataFrame(given, _RULE_SCHEMA))
    split = _with_rules(files, rules, "inner").withColumn("_lines", tx.split_lines(F.col("text")))
    found = split.select("project", "tool", "language", "filename", F.explode(_hits()).alias("_hit"))
    hashed = tx.fingerprint(F.col("filename"), F.col("_hit.pattern_id"), F.col("_hit.text")).alias("fingerprint")
    return found.select(
        "project", "tool", "language", "_hit.pattern_id", "filename", "_hit.message", "_hit.level", "_hit.category",
        "_hit.line", F.lit(None).cast("int").alias("column"), *([hashed] if fingerprints else []),
    )


# ---------------------------------------------------------------- metrics


@dataclass(frozen=True)
class MetricRule:
    """Regexes of a language. ``comment``, ``method`` and ``type_`` select lines, ``branch`` is counted."""

    comment: str
    method: str
    type_: str
    branch: str


METRIC_FIELDS = ["complexity", "loc", "cloc", "nr_methods", "nr_classes", "line_complexities"]


def _measured(rules: Mapping[str, MetricRule]) -> list[Column]:
    """The metrics of a row with ``text``, ``_lines`` and ``language``."""
    by_language = F.col("language")
    lines = F.col("_lines")

    def per_language(value: Callable[[MetricRule], Column]) -> Column:
        return F.coalesce(F.lit(None), *[F.when(by_language == name, value(rule)) for name, rule in sorted(rules.items())])

    def lines_matching(regex: str) -> Column:
        return F.size(F.filter(lines, lambda line: line.rlike(regex)))

    def opened(rule: MetricRule) -> Column:
        numbered = F.transform(lines, lambda line, i: F.struct((i + 1).alias("line"), line.alias("text")))
        methods = F.filter(numbered, lambda n: n["text"].rlike(rule.method))
        return F.transform(
            methods,
            lambda n: F.struct(n["line"].alias("line"), (F.regexp_count(n["text"], F.lit(rule.branch)) + 1).alias("value")),
        )

    nothing = F.array().cast("array<struct<line:int,value:int>>")
    return [
        per_language(lambda r: F.regexp_count("text", F.lit(r.branch)) + 1).cast("int").alias("complexity"),
        tx.count_loc(F.col("text")).alias("loc"),
        per_language(lambda r: lines_matching(r.comment)).cast("int").alias("cloc"),
        per_language(lambda r: lines_matching(r.method)).cast("int").alias("nr_methods"),
        per_language(lambda r: lines_matching(r.type_)).cast("int").alias("nr_classes"),
        F.coalesce(per_language(opened), nothing).alias("line_complexities"),
    ]


def compute_metrics(files: DataFrame, rules: Mapping[str, MetricRule]) -> DataFrame:
    """Size metrics per file; everything but ``loc`` is null for languages without rule.

    ``complexity`` is one plus the branches of the file; ``line_complexities`` holds, for each line that
    opens a method, one plus the branches on it.
    """
    split = files.withColumn("_lines", tx.split_lines(F.col("text")))
    return split.select(*[c for c in files.columns if c != "text"], *_measured(rules))


# ---------------------------------------------------------------- duplication

CLONE_WINDOW = 5
_FILE = ["project", "language", "filename"]
_HASH = ["project", "language", "h"]


WINDOW_FIELDS = ["i", "h", "first_tokens", "tokens", "next_a", "next_b"]
_WINDOW = "struct<i:int,h:binary,first_tokens:int,tokens:int,next_a:bigint,next_b:bigint>"


def _hash_windows(files: DataFrame, size: int, wanted: Column) -> DataFrame:
    """Adds ``_plain``: runs of ``size`` lines, as hashes, of the ``wanted`` rows, computed inside each file row."""
    text = F.when(wanted, tx.normalize_lines(F.col("text")))
    split = files.withColumn("_norm", F.split(text, "\n", -1))

    def n_tokens(line: Column) -> Column:
        spaces = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
        return spaces + (line != "").cast("int")

    lined = split.withColumn("_hashes", F.transform("_norm", F.md5)).withColumn("_tokens", F.transform("_norm", n_tokens))
    n_windows = F.size("_hashes") - size + 1
    starts = F.when(n_windows > 0, F.sequence(F.lit(1), n_windows))

    def window(i: Column) -> Column:
        tokens = F.aggregate(F.slice("_tokens", i, F.lit(size)), F.lit(0), lambda acc, n: acc + n)
        return F.struct(
            F.unhex(F.md5(F.array_join(F.slice("_hashes", i, F.lit(size)), ""))).alias("h"),
            F.get("_tokens", i - 1).alias("first_tokens"),
            tokens.alias("tokens"),
        )

    return lined.withColumn("_plain", F.transform(starts, window))


def _windows() -> Column:
    """The windows of a row with ``_plain``, each with a 128-bit fingerprint of the hash one line further down.

    Windows of blank lines only are left out. To be exploded as an expression: of a plain column Spark would derive
    a filter and compute everything twice.
    """

    def with_next(w: Column, i: Column) -> Column:
        following = F.get(F.col("_plain"), i + 1)
        there = following["tokens"] > 0
        return F.struct(
            i.alias("i"), w["h"].alias("h"), w["first_tokens"].alias("first_tokens"), w["tokens"].alias("tokens"),
            *[F.when(there, c).alias(name) for c, name in zip(_fingerprint(following["h"]), ("next_a", "next_b"))],
        )

    filled = F.filter(F.transform("_plain", with_next), lambda w: w["tokens"] > 0)
    return filled.cast(f"array<{_WINDOW}>")


def line_windows(files: DataFrame, size: int = CLONE_WINDOW) -> DataFrame:
    """``(project, language, filename, i, h, first_tokens, tokens, next_a, next_b)``, see :func:`clones_of_windows`."""
    rows = _hash_windows(files.select(*_FILE, "text"), size, F.lit(True)).select(*_FILE, F.explode(_windows()).alias("_w"))
    return rows.select(*_FILE, "_w.*")


def _fingerprint(h: Column) -> tuple[Column, Column]:
    """A hash as two numbers: unlike binary values they can be aggregated without sorting."""
    return F.xxhash64(h), F.xxhash64(h, F.lit(1))


def _duplicated_windows(windows: DataFrame) -> DataFrame:
    """Hashes that occur at least twice, with ``chains``: always followed by one and the same hash that
    occurs equally often, so the two windows belong to one longer clone."""
    sides = [(c, f(c).alias(f"{f.__name__}_{c}")) for c in ("next_a", "next_b") for f in (F.min, F.max)]
    stats = windows.groupBy(*_HASH).agg(F.count("*").alias("n"), F.count("next_a").alias("n_next"), *[s for _, s in sides])
    same = F.expr("n_next = n and min_next_a = max_next_a and min_next_b = max_next_b")
    repeated = stats.filter("n >= 2").select(
        *_HASH, "n", *[F.when(same, F.col(f"min_{c}")).alias(c) for c in ("next_a", "next_b")]
    )
    repeated = stage(repeated, "duplicated-windows")
    next_a, next_b = _fingerprint(F.col("h"))
    after = repeated.select(
        "project", "language", next_a.alias("next_a"), next_b.alias("next_b"), F.col("n").alias("_n_after")
    )
    joined = repeated.join(after, ["project", "language", "next_a", "next_b"], "left")
    return joined.select(*_HASH, "n", F.coalesce(F.col("_n_after") == F.col("n"), F.lit(False)).alias("chains"))


def detect_clones(files: DataFrame, window: int = CLONE_WINDOW) -> DataFrame:
    """Duplicated blocks of ``files``: :func:`line_windows`, staged so that texts are read once, and their clones."""
    return clones_of_windows(stage(line_windows(files, window), "line-windows"), window)


def clones_of_windows(windows: DataFrame, window: int = CLONE_WINDOW) -> DataFrame:
    """Occurrences of duplicated blocks of at least ``window`` lines within (project, language).

    Rows ``(project, language, clone_id, nr_lines, nr_tokens, filename, start_line, end_line)``, one per
    occurrence, also for blocks repeated within a file. Work is linear in lines: windows are counted by
    hash, never paired. Stays in flat form because a clone can have any number of occurrences. The windows are read
    twice, so they are to be staged.
    """
    repeated = _duplicated_windows(windows)
    located = weighted_join(
        windows.select(*_FILE, "i", "h", "first_tokens", "tokens"), repeated, _HASH, weight="n", spread=["filename", "i"]
    )
    in_file = Window.partitionBy(*_FILE).orderBy("i")
    continues = (F.lag("i").over(in_file) == F.col("i") - 1) & F.lag("chains").over(in_file)
    begins = located.withColumn("_begins", ~F.coalesce(continues, F.lit(False)))
    so_far = in_file.rowsBetween(Window.unboundedPreceding, 0)

    def of_begin(column: str) -> Column:
        return F.last(F.when(F.col("_begins"), F.col(column)), ignorenulls=True).over(so_far)

    # The hash is a grouping key, so that only numbers are aggregated and no sort is needed.
    islands = begins.withColumn("_at", of_begin("i")).withColumn("_first", of_begin("h"))
    blocks = islands.groupBy(*_FILE, "_at", "_first").agg(
        (F.min("i") + 1).alias("start_line"),
        (F.max("i") + window).alias("end_line"),
        (F.sum("first_tokens") + F.max_by(F.col("tokens") - F.col("first_tokens"), "i")).cast("int").alias("nr_tokens"),
    )
    nr_lines = F.col("end_line") - F.col("start_line") + 1
    clone_id = F.md5(F.concat(F.lower(F.hex("_first")), F.lit(":"), nr_lines.cast("string")))
    return blocks.select(
        "project", "language", clone_id.alias("clone_id"), nr_lines.alias("nr_lines"), "nr_tokens", "filename",
        "start_line", "end_line",
    )


def clones(occurrences: DataFrame, files: DataFrame) -> DataFrame:
    """One row per clone with its size, number of occurrences and the text of the first occurrence.

    Only files that hold the first occurrence of a clone are taken apart: their names are looked up first.
    """
    keys = ["project", "language", "clone_id"]
    first = F.min(F.struct("filename", "start_line"))
    summary = occurrences.groupBy(*keys, "nr_lines", "nr_tokens").agg(
        first.alias("_first"), F.count("*").cast("int").alias("n_occurrences")
    )
    located = summary.select(*keys, "nr_lines", "nr_tokens", "n_occurrences", "_first.*")
    asked = located.select(*_FILE).distinct()
    texts = files.select(*_FILE, "text").join(asked, _FILE, "left_semi").select(*_FILE, tx.split_lines(F.col("text")).alias("_lines"))
    block = F.slice(F.col("_lines"), F.col("start_line"), F.col("nr_lines"))
    return located.join(texts, _FILE).select(
        *keys, F.array_join(block, "\n").alias("clone_lines"), "nr_tokens", "nr_lines", "n_occurrences"
    )


# ---------------------------------------------------------------- one pass for everything

KINDS = ["issues", "metrics", "duplication"]


def scan_once(files: DataFrame, rules: DataFrame, metric_rules: Mapping[str, MetricRule], window: int = CLONE_WINDOW) -> DataFrame:
    """All analyses in one pass over the texts, as narrow rows that ``kind`` tells apart.

    ``files (project, kind, tool, language, filename, text, pattern_ids)``: one row per file and job. Jobs of kind issues
    give rows like :func:`scan_issues` with fingerprints, metrics one row like :func:`compute_metrics`, duplication rows
    like :func:`line_windows`; columns of other kinds are null. To be staged by ``kind``.
    """
    kind = F.col("kind")
    lined = _with_rules(files, rules, "left").withColumn("_lines", F.when(kind != "duplication", tx.split_lines(F.col("text"))))
    ready = _hash_windows(lined, window, kind == "duplication")
    measured = "struct<complexity:int,loc:int,cloc:int,nr_methods:int,nr_classes:int,line_complexities:array<struct<line:int,value:int>>>"
    types = {"hit": _HIT_TYPE, "measured": measured, "win": _WINDOW}

    def of(name: str, value: Column) -> Column:
        parts = [(value if n == name else F.lit(None)).cast(kind_).alias(n) for n, kind_ in types.items()]
        return F.struct(*parts)

    outputs = (
        F.when(kind == "issues", F.transform(_hits(), lambda hit: of("hit", hit)))
        .when(kind == "metrics", F.array(of("measured", F.struct(*_measured(metric_rules)))))
        .when(kind == "duplication", F.transform(_windows(), lambda w: of("win", w)))
    )
    job = ["project", "kind", "tool", "language", "filename"]
    rows = ready.select(*job, F.explode(outputs).alias("_o"))
    hashed = F.when(kind == "issues", tx.fingerprint(F.col("filename"), F.col("_o.hit.pattern_id"), F.col("_o.hit.text")))
    return rows.select(
        *job, *[f"_o.hit.{c}" for c in (*_HIT, "line")], hashed.alias("fingerprint"), "_o.measured.*", "_o.win.*"
    )


# ---------------------------------------------------------------- user-supplied analysers


def custom_analyser(
    files: DataFrame,
    analyse: Callable[[pd.DataFrame], pd.DataFrame],
    result_schema: str,
    run: Sequence[str] = ("project", "tool", "language"),
    whole_runs: bool = False,
) -> DataFrame:
    """Run user code over the files of every run and isolate its failures.

    ``analyse`` gets a frame with one file (one row) and returns result rows (``result_schema``, without the run
    columns); it is called once per file, so results do not depend on how Spark slices a run. With
    ``whole_runs`` it gets all files of a run at once, in no set order: for analysers that compare files, and
    only where every run fits one task. Nulls in the run columns make a run of their own. If it raises on any
    file, the run fails: its results are dropped and one row with ``success = false`` and the message stays.
    """
    run = list(run)
    schema, names = _outcome_schema(run, result_schema)
    columns = [*run, "success", "error", *names]

    def outcome(part: pd.DataFrame) -> pd.DataFrame:
        base = {name: None if pd.isna(value) else value for name, value in part[run].iloc[0].items()}
        try:
            found = analyse(part)[names].assign(**base, success=True, error=None)
        except Exception as error:  # the contract: a failing analyser fails its run only
            found = pd.DataFrame([{**base, "success": False, "error": str(error), **dict.fromkeys(names)}])
        return found[columns]

    def by_file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(len(batch)):
                yield outcome(batch.iloc[[at]])

    called = files.groupBy(*run).applyInPandas(outcome, schema) if whole_runs else files.mapInPandas(by_file, schema)
    return _failures_apart(stage(called, "custom-analyser"), run, names)


def _outcome_schema(run: Sequence[str], result_schema: str) -> tuple[str, list[str]]:
    """The schema of raw outcomes, and the names of the result columns."""
    keys = ", ".join(f"{k} string" for k in run)
    names = [part.strip().split(" ")[0] for part in result_schema.split(",")]
    return f"{keys}, success boolean, error string, {result_schema}", names


def _failures_apart(raw: DataFrame, run: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Results of the runs without a failure, and one row with the message for every other run."""
    failed = raw.filter("not success").groupBy(*run).agg(F.min("error").alias("error"))
    # Runs with a null in their key are runs like others, so nulls have to meet.
    known = {f"_{k}": F.coalesce(k, F.lit("\0")) for k in run}
    lost = failed.withColumns(known).select(*known)
    results = lookup_join(raw.filter("success").withColumns(known), lost, list(known), spread=names, how="left_anti").drop(*known)
    return results.unionByName(failed.withColumn("success", F.lit(False)), allowMissingColumns=True)


#: Partial states merged by one step of a tree, keys a task holds while it maps, and keys it hands on together afterwards.
FAN_IN = 64
HELD_KEYS = 20_000
HANDED_ON = 256


def merging_analyser(
    files: DataFrame,
    map_file: Callable[[pd.DataFrame], Mapping[str, Any]],
    merge: Callable[[Any, Any], Any],
    finish: Callable[[str, Any], pd.DataFrame | None],
    result_schema: str,
    run: Sequence[str] = ("project", "tool", "language"),
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Like :func:`custom_analyser` for user code that compares files, without a run ever being in one task.

    ``map_file`` gets a frame with one file and returns partial states by key (texts; what is to be compared has one
    key). ``merge`` unites two states of a key; it must be associative and commutative. ``finish`` turns a key's united state
    into result rows (``result_schema``) or None. Files are mapped where they lie and united within their task first; the
    states of a key, however many, are then united in a tree, ``fan_in`` at a time. So a task needs memory for the
    states of ``HELD_KEYS`` keys at most. If any of the three raises, the run fails with the smallest message; null runs, repeated files
    and empty tables are as in ``custom_analyser``.
    """
    if fan_in < 2:
        raise ValueError("a tree needs a fan-in of 2 or more")
    run = list(run)
    schema, names = _outcome_schema(run, result_schema)
    state_columns = [*run, "_key", "_state", "_error"]
    state_schema = ", ".join(f"{k} string" for k in run) + ", _key string, _state binary, _error string"

    def as_rows(states: Mapping[tuple, Any], errors: Mapping[tuple, str]) -> pd.DataFrame:
        rows = [(*who, key, pickle.dumps(state), None) for (who, key), state in states.items()]
        rows += [(*who, None, None, message) for who, message in errors.items()]
        return pd.DataFrame(rows, columns=state_columns, dtype=object)

    def runs_of(batch: pd.DataFrame) -> Iterator[tuple]:
        return zip(*([None if pd.isna(value) else value for value in batch[k]] for k in run))

    def mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, Any] = {}
        errors: dict[tuple, str] = {}
        for batch in batches:
            for at, who in enumerate(runs_of(batch)):
                try:
                    for key, state in map_file(batch.iloc[[at]]).items():
                        place = (who, key)
                        held[place] = merge(held[place], state) if place in held else state
                except Exception as error:  # the contract: a failing analyser fails its run only
                    errors[who] = min(errors.get(who, str(error)), str(error))
                if len(held) >= HELD_KEYS:
                    yield as_rows(held, {})
                    held = {}
        yield as_rows(held, errors)

    def united(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, str, Any, str | None]]:
        """Run, key, state and error of every stretch of rows with one run and key."""
        place, state, error = None, None, None
        for batch in batches:
            for who, key, blob in zip(runs_of(batch), batch["_key"], batch["_state"]):
                if (who, key) != place:
                    if place is not None:
                        yield *place, state, error
                    place, state, error = (who, key), pickle.loads(blob), None
                elif error is None:
                    try:
                        state = merge(state, pickle.loads(blob))
                    except Exception as fault:
                        error = str(fault)
        if place is not None:
            yield *place, state, error

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, Any] = {}
        errors: dict[tuple, str] = {}
        for who, key, state, error in united(batches):
            if error is None:
                held[who, key] = state
            else:
                errors[who] = min(errors.get(who, error), error)
            if len(held) >= HANDED_ON:
                yield as_rows(held, {})
                held = {}
        yield as_rows(held, errors)

    def finished(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready: list[pd.DataFrame] = []
        for who, key, state, error in united(batches):
            base = dict(zip(run, who))
            found = None
            if error is None:
                try:
                    found = finish(key, state)
                    found = None if found is None else found[names].assign(**base, success=True, error=None)
                except Exception as fault:
                    error = str(fault)
            if error is not None:
                found = pd.DataFrame([{**base, "success": False, "error": error, **dict.fromkeys(names)}])
            if found is not None:
                ready.append(found[[*run, "success", "error", *names]])
            if len(ready) >= HANDED_ON:
                yield pd.concat(ready, ignore_index=True)
                ready = []
        if ready:
            yield pd.concat(ready, ignore_index=True)

    def numbered(states: DataFrame) -> DataFrame:
        # Staged with the numbers, so that a task that runs again deals the states out as before.
        return stage(states.withColumn("_n", F.monotonically_increasing_id()), "analyser-states")

    key = [*run, "_key"]
    states = numbered(files.mapInPandas(mapped, state_schema))
    errors = [states.filter("_error is not null")]
    while True:
        widest = states.filter("_error is null").groupBy(*key).count().agg(F.max("count")).first()[0] or 0
        if widest <= fan_in:
            break
        deal = F.pmod(F.xxhash64("_n"), F.lit(math.ceil(widest / fan_in))).alias("_deal")
        dealt = states.filter("_error is null").select(*key, "_state", deal)
        near = dealt.repartition(*key, "_deal").sortWithinPartitions(*key, "_deal")
        states = numbered(near.mapInPandas(merged, state_schema))
        errors.append(states.filter("_error is not null"))
    last = states.filter("_error is null").select(*key, "_state").repartition(*key).sortWithinPartitions(*key)
    raw = last.mapInPandas(finished, schema)
    for failed in errors:
        lost = failed.select(*run, F.lit(False).alias("success"), F.col("_error").alias("error"))
        raw = raw.unionByName(lost, allowMissingColumns=True)
    return _failures_apart(stage(raw, "merging-analyser"), run, names)
