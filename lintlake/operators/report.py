"""Rendering results as text, JSON and SARIF.

A report can be larger than any task, so documents are tables of lines: ``project``, sort columns
``s1..s4`` and ``line``. Put in order, the lines of a project are its document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lintlake.functions import text as tx
from lintlake.functions.scale import lookup_join, spread_rank, weighted_join

_RUN = ["project", "tool", "language"]
SORT_COLUMNS = ["s1", "s2", "s3", "s4"]

# Texts of the plain report.
HEADER = "Starting analysis ..."
FOOTER = "Analysis complete"


def _line(order: Sequence[Column | int | str], line: Column, *keys: str) -> list[Column]:
    """Select list of a document line."""
    typed = []
    for i, value in enumerate(order):
        column = value if isinstance(value, Column) else F.lit(value)
        typed.append(column.cast("int" if i % 2 == 0 else "string").alias(SORT_COLUMNS[i]))
    return [*[F.col(k) for k in keys or ("project",)], *typed, line.alias("line")]


# ---------------------------------------------------------------- text


def issue_text(colour: bool = False) -> Column:
    def paint(code: str, value: Column) -> Column:
        return F.concat(F.lit(f"\x1b[{code}m"), value, F.lit("\x1b[0m")) if colour else value

    category = F.when(F.col("category").isNull(), F.lit("")).otherwise(F.concat(F.lit("/"), "category"))
    level = F.col("level")
    if colour:
        # Terminal colours by level.
        level = (
            F.when(level == "Info", paint("34", level))
            .when(level == "Warning", paint("33", level))
            .otherwise(paint("31", level))
        )
    return F.concat(
        F.lit("Found ["), level, paint("33", category), F.lit("] `"), F.col("message"), F.lit("` in "), F.col("filename"),
        F.lit(":"), tx.location_text(F.col("line"), F.col("column")), F.lit(" ("), paint("1", F.col("pattern_id")), F.lit(")"),
    )


def file_error_text() -> Column:
    return F.concat(F.lit("Found "), F.col("message"), F.lit(" in "), F.col("filename"))


def metrics_text() -> Column:
    # Labels of the metrics.
    labels = {
        "complexity": "CC",
        "loc": "LOC",
        "cloc": "CLOC",
        "nr_methods": "#methods",
        "nr_classes": "#classes",
    }
    present = F.array_compact(
        F.array(*[F.concat(F.lit(f"  {label} - "), F.col(c).cast("string")) for c, label in labels.items()])
    )
    return F.when(
        F.size(present) == 0, F.concat(F.lit("No [Metrics] found in "), F.col("filename"), F.lit("."))
    ).otherwise(F.concat(F.lit("Found [Metrics] in "), F.col("filename"), F.lit(":\n"), F.array_join(present, "\n")))


def clone_files_grouped(occurrences: DataFrame) -> DataFrame:
    """Occurrences of a clone by file; the ranges of one file are bounded by that file."""
    ranges = F.array_sort(F.collect_set(F.struct("start_line", "end_line")))
    grouped = occurrences.groupBy("project", "clone_id", "filename").agg(ranges.alias("_ranges"))
    shown = F.transform("_ranges", lambda r: F.concat(r["start_line"].cast("string"), F.lit(" - "), r["end_line"].cast("string")))
    return grouped.select("project", "clone_id", "filename", shown.alias("ranges"))


def clone_text_lines(occurrences: DataFrame) -> DataFrame:
    """Block of a clone: a head line and one row per file."""
    heads = occurrences.select("project", "clone_id", "nr_lines", "nr_tokens").distinct()
    head = F.concat(
        F.lit("Found [Clone] "), F.col("nr_lines").cast("string"), F.lit(" duplicated lines with "),
        F.col("nr_tokens").cast("string"), F.lit(" tokens:"),
    )
    ranges = F.transform("ranges", lambda r: F.concat(F.lit("    l. "), r))
    body = F.concat(F.lit("  "), F.col("filename"), F.lit("\n"), F.array_join(ranges, "\n"))
    return heads.select(*_line([4, F.col("clone_id"), 0, ""], head)).unionByName(
        clone_files_grouped(occurrences).select(*_line([4, F.col("clone_id"), 1, F.col("filename")], body))
    )


def render_text(results: DataFrame, metrics: DataFrame, occurrences: DataFrame) -> DataFrame:
    """Lines of the plain report without header and footer."""
    shown = F.when(F.col("kind") == "Issue", issue_text()).otherwise(file_error_text())
    spot = F.format_string("%s\x01%010d", F.col("filename"), F.coalesce("line", F.lit(0)))
    found = results.select(*_line([1, spot, 0, F.coalesce("pattern_id", F.lit(""))], shown))
    measured = metrics.select(*_line([2, F.col("filename"), 0, ""], metrics_text()))
    return found.unionByName(measured).unionByName(clone_text_lines(occurrences))


def text_document(projects: DataFrame, body: DataFrame) -> DataFrame:
    header = projects.select("project").distinct().select(*_line([0, "", 0, ""], F.lit(HEADER)))
    footer = projects.select("project").distinct().select(*_line([9, "", 0, ""], F.lit(FOOTER)))
    return header.unionByName(body).unionByName(footer)


# ---------------------------------------------------------------- JSON


def _keep_nulls(col: Column) -> Column:
    return F.to_json(col, {"ignoreNullFields": "false"})


def _location() -> Column:
    """A location with the one member that applies; the other is null."""
    full = F.struct(F.col("line").alias("line"), F.col("column").alias("column"))
    at_line = F.struct(F.col("line").alias("line"))
    return F.struct(
        F.when(F.col("column").isNotNull(), full).alias("FullLocation"),
        F.when(F.col("column").isNull(), at_line).alias("LineLocation"),
    )


def _issue_fields(location: Column) -> list[Column]:
    return [
        F.struct(F.col("pattern_id").alias("value")).alias("patternId"),
        F.col("filename").alias("filename"),
        F.struct(F.col("message").alias("text")).alias("message"),
        F.col("level").alias("level"),
        F.col("category").alias("category"),
        location.alias("location"),
    ]


def issue_json() -> Column:
    """Tagged issue with nulls kept, except that the location has only the member that applies."""
    full = F.struct(F.struct(F.col("line").alias("line"), F.col("column").alias("column")).alias("FullLocation"))
    at_line = F.struct(F.struct(F.col("line").alias("line")).alias("LineLocation"))

    def tagged(location: Column) -> Column:
        return _keep_nulls(F.struct(F.struct(*_issue_fields(location)).alias("Issue")))

    return F.when(F.col("column").isNull(), tagged(at_line)).otherwise(tagged(full))


def file_error_json() -> Column:
    return _keep_nulls(F.struct(F.struct("filename", "message").alias("FileError")))


def metrics_json() -> Column:
    fields = [
        F.col("filename").alias("filename"), F.col("complexity").alias("complexity"), F.col("loc").alias("loc"),
        F.col("cloc").alias("cloc"), F.col("nr_methods").alias("nrMethods"), F.col("nr_classes").alias("nrClasses"),
        F.col("line_complexities").alias("lineComplexities"),
    ]
    return _keep_nulls(F.struct(F.struct(*fields).alias("FileMetrics")))


def render_json(results: DataFrame, metrics: DataFrame) -> DataFrame:
    """One tagged JSON object per issue, file error and metrics row, with nulls kept."""
    shown = F.when(F.col("kind") == "Issue", issue_json()).otherwise(file_error_json())
    spot = F.format_string("%s\x01%010d", F.col("filename"), F.coalesce("line", F.lit(0)))
    found = results.select(*_line([1, spot, 0, shown], shown))
    measured = metrics.select(*_line([2, F.col("filename"), 0, metrics_json()], metrics_json()))
    return found.unionByName(measured)


def clone_json_lines(clones: DataFrame, occurrences: DataFrame) -> DataFrame:
    """Clone objects, one line for the head, one per occurrence and one for the tail.

    A clone can have any number of occurrences, so its object is never built in one row.
    """
    texts = _keep_nulls(F.struct(F.col("clone_lines").alias("cloneLines"), F.col("nr_tokens").alias("nrTokens"), F.col("nr_lines").alias("nrLines")))
    head = F.concat(F.lit('{"DuplicationClone":'), F.substr(texts, F.lit(1), F.length(texts) - 1), F.lit(',"files":['))
    spot = F.format_string("%s\x01%010d", F.col("filename"), F.col("start_line"))
    first = occurrences.groupBy("project", "clone_id").agg(F.min(spot).alias("_first"), F.count("*").alias("_n"))
    entry = _keep_nulls(
        F.struct(
            F.col("filename").alias("filePath"), F.col("start_line").alias("startLine"), F.col("end_line").alias("endLine")
        )
    )
    rows = weighted_join(occurrences.withColumn("_spot", spot), first, ["project", "clone_id"], "_n", spread=["_spot"])
    body = F.concat(F.when(F.col("_spot") == F.col("_first"), F.lit("")).otherwise(F.lit(",")), entry)
    heads = clones.select(*_line([3, F.col("clone_id"), 0, ""], head))
    tails = clones.select(*_line([3, F.col("clone_id"), 2, ""], F.lit("]}}")))
    return heads.unionByName(rows.select(*_line([3, F.col("clone_id"), 1, F.col("_spot")], body))).unionByName(tails)


def json_document(projects: DataFrame, records: DataFrame) -> DataFrame:
    """Bracket the records of each project and put a comma before each but the first.

    Continuation lines of a clone (``s1 = 3`` with ``s3 > 0``) belong to the record begun by its head.
    """
    order = F.struct(*SORT_COLUMNS)
    begins = (F.col("s1") != 3) | (F.col("s3") == 0)
    first = records.groupBy("project").agg(F.min(order).alias("_first"))
    joined = lookup_join(records, first, ["project"], spread=["s2", "s4"])
    comma = F.when(begins & (order != F.col("_first")), F.lit(",")).otherwise(F.lit(""))
    body = joined.select("project", *SORT_COLUMNS, F.concat(comma, "line").alias("line"))
    named = projects.select("project").distinct()
    return (
        named.select(*_line([0, "", 0, ""], F.lit("[")))
        .unionByName(body)
        .unionByName(named.select(*_line([9, "", 0, ""], F.lit("]"))))
    )


# ---------------------------------------------------------------- SARIF

# Identity of the SARIF format.
SARIF_SCHEMA = "https://docs.oasis-open.org/sarif/sarif/v2.1.0/cos02/schemas/sarif-schema-2.1.0.json"
SARIF_VERSION = "2.1.0"
DEFAULT_CATEGORY = "CodeStyle"


def sarif_line(line: Column) -> Column:
    """Some tools report line 0; SARIF starts at 1."""
    return F.greatest(line, F.lit(1))


def sarif_level(level: Column, is_security: Column, compat: bool = False) -> Column:
    """SARIF severity; in compatibility mode issues outside security are one step lower."""
    high, medium = level.isin("Error", "High"), level == "Warning"
    base = F.when(high, F.lit("error")).when(medium, F.lit("warning")).otherwise(F.lit("note"))
    if not compat:
        return base
    lowered = F.when(high, F.lit("warning")).when(medium, F.lit("note")).otherwise(F.lit("none"))
    return F.when(is_security, base).otherwise(lowered)


def split_security(issues: DataFrame, tools: DataFrame, patterns: DataFrame) -> DataFrame:
    """Adds ``bare_id`` (without tool prefix) and ``is_security``, decided by the catalog category of the
    pattern; the category an issue carries does not count."""
    prefixes = tools.filter("kind = 'issues'").groupBy("tool").agg(F.min("prefix").alias("_prefix"))
    catalog = patterns.select("tool", F.col("id").alias("bare_id"), F.col("category").alias("_category"))
    bare = lookup_join(issues, prefixes, ["tool"], spread=["filename", "line"]).withColumn(
        "bare_id", tx.strip_prefix(F.col("pattern_id"), F.col("_prefix"))
    )
    joined = lookup_join(bare, catalog, ["tool", "bare_id"], spread=["filename", "line"])
    return joined.select(
        *issues.columns, "bare_id", F.coalesce(F.col("_category") == "Security", F.lit(False)).alias("is_security")
    )


def sarif_rules(categorized: DataFrame, patterns: DataFrame, legacy_rule_index: bool = False) -> DataFrame:
    """One rule per reported pattern that the catalog knows, with its index.

    The index counts the run's rules, security first. ``legacy_rule_index`` counts security and other
    rules apart. Rules of a run are bounded by the pattern catalog.
    """
    used = categorized.groupBy(*_RUN, "pattern_id", "bare_id", "is_security").agg(
        F.min_by("category", F.struct("filename", "line", "message")).alias("_category")
    )
    catalog = patterns.select("tool", F.col("id").alias("bare_id"), "title", "description", "explanation")
    known = lookup_join(used, catalog, ["tool", "bare_id"], spread=["project"], how="inner")
    lists = [*_RUN, "is_security"] if legacy_rule_index else _RUN
    order = Window.partitionBy(*lists).orderBy(F.col("is_security").desc(), "pattern_id")
    return known.select(
        *_RUN, "is_security", F.col("pattern_id").alias("rule_id"), F.col("title").alias("name"),
        F.coalesce("description", "title").alias("short_text"), F.col("explanation").alias("help_markdown"),
        F.coalesce("_category", F.lit(DEFAULT_CATEGORY)).alias("category"),
        (F.row_number().over(order) - 1).alias("rule_index"),
    )


def sarif_artifacts(issues: DataFrame) -> DataFrame:
    return issues.select(*_RUN, "filename").distinct()


def indexed_artifacts(issues: DataFrame) -> DataFrame:
    """Files with issues, their number of issues and their index within the run.

    The index follows the hash of the name: a run can have any number of files.
    """
    counted = issues.groupBy(*_RUN, "filename").agg(F.count("*").alias("n_issues"))
    return spread_rank(counted, _RUN, "filename", "artifact_index")


def sarif_indexes(categorized: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds the artifact index and the rule index (-1 for patterns without rule)."""
    artifacts = indexed_artifacts(categorized)
    indexed = weighted_join(categorized, artifacts, [*_RUN, "filename"], "n_issues", spread=["line", "pattern_id"])
    positions = rules.select(*_RUN, F.col("rule_id").alias("pattern_id"), "rule_index")
    joined = lookup_join(indexed, positions, [*_RUN, "pattern_id"], spread=["filename", "line"])
    return joined.withColumn("rule_index", F.coalesce("rule_index", F.lit(-1))).drop("n_issues")


def fingerprint_issues(issues: DataFrame, files: DataFrame) -> DataFrame:
    """Adds ``fingerprint`` from the source line; lines outside the file count as empty.

    For results that come without one (see ``scan_issues``). Only files with issues are taken apart: their names are
    looked up first, and no text moves while that list fits a broadcast. Lines, not texts, meet the issues, so a file
    with very many issues is spread over its lines. Blank lines are left out: they count as empty anyway.
    """
    asked = issues.select("project", "filename").distinct()
    files = files.select("project", "filename", "text").join(asked, ["project", "filename"], "left_semi")
    lines = files.select("project", "filename", F.posexplode(tx.split_lines(F.col("text"))).alias("_pos", "_content"))
    contents = lines.select("project", "filename", (F.col("_pos") + 1).alias("line"), "_content").filter("trim(_content) <> ''")
    joined = issues.join(contents, ["project", "filename", "line"], "left")
    content = F.coalesce("_content", F.lit(""))
    return joined.select(
        *issues.columns, tx.fingerprint(F.col("filename"), F.col("pattern_id"), content).alias("fingerprint")
    )


def union_security(security: DataFrame, others: DataFrame) -> DataFrame:
    """Security results before the others, kept in order by ``part``."""
    return security.withColumn("part", F.lit(0)).unionByName(others.withColumn("part", F.lit(1)))


def sarif_results(
    issues: DataFrame,
    tools: DataFrame,
    patterns: DataFrame,
    files: DataFrame,
    compat: bool = False,
    legacy_rule_index: bool = False,
) -> DataFrame:
    """SARIF results in flat form, one row per issue of a known tool.

    ``files`` is only read for issues without a ``fingerprint`` column.
    """
    known = lookup_join(issues, tools.select("tool").distinct(), ["tool"], spread=["filename", "line"], how="left_semi")
    categorized = split_security(known, tools, patterns)
    rules = sarif_rules(categorized, patterns, legacy_rule_index)
    indexed = sarif_indexes(categorized, rules)
    if "fingerprint" not in issues.columns:
        indexed = fingerprint_issues(indexed, files)
    return indexed.select(
        *_RUN, "is_security", F.col("pattern_id").alias("rule_id"), "rule_index",
        sarif_level(F.col("level"), F.col("is_security"), compat).alias("level"), "message", "filename", "artifact_index",
        sarif_line(F.col("line")).alias("start_line"), "fingerprint",
    )


def _without_braces(col: Column) -> Column:
    return F.substr(col, F.lit(2), F.length(col) - 2)


def sarif_document(
    projects: DataFrame,
    runs: DataFrame,
    tools: DataFrame,
    rules: DataFrame,
    artifacts: DataFrame,
    results: DataFrame,
    information_uri: str = "",
    name_suffix: str = "",
    root_uri: str = "file:///",
) -> DataFrame:
    """SARIF documents as lines: one SARIF run per successful issue run of a known tool.

    ``rules``, ``artifacts`` and ``results`` come from :func:`sarif_rules`, :func:`indexed_artifacts`
    and :func:`sarif_results`. Rules and artifacts appear in index order; the first result of a run is
    found by an aggregate, so no list is ever gathered.
    """
    run_key = F.concat_ws("\x01", "tool", "language")
    names = tools.select("tool", F.col("name").alias("_name"), F.col("version").alias("_version")).distinct()
    good = runs.filter("kind = 'issues' and success").select(*_RUN).distinct()
    good = lookup_join(good, names, ["tool"], spread=["project"], how="inner").withColumn("_key", run_key)
    first_run = good.groupBy("project").agg(F.min("_key").alias("_first"))
    good = good.join(first_run, "project")

    driver = F.struct(
        tx.tool_label(F.col("_name"), name_suffix).alias("name"),
        tx.tool_version(F.col("_version")).alias("version"),
        F.lit(information_uri).alias("informationUri"),
    )
    opened = F.concat(
        F.when(F.col("_key") == F.col("_first"), F.lit("")).otherwise(F.lit(",")),
        F.lit('{"tool":{"driver":{'), _without_braces(F.to_json(driver)), F.lit(',"rules":['),
    )
    rule = F.to_json(
        F.struct(
            F.col("rule_id").alias("id"),
            F.col("name").alias("name"),
            F.struct(F.col("short_text").alias("text")).alias("shortDescription"),
            F.struct(F.col("short_text").alias("text"), F.col("help_markdown").alias("markdown")).alias("help"),
            F.struct(F.col("category").alias("category")).alias("properties"),
        )
    )
    place = F.struct(
        F.struct(F.col("artifact_index").alias("index"), F.col("filename").alias("uri")).alias("artifactLocation"),
        F.struct(F.col("start_line").alias("startLine"), F.lit(1).alias("startColumn")).alias("region"),
    )
    result = F.to_json(
        F.struct(
            F.col("rule_index").alias("ruleIndex"),
            F.col("rule_id").alias("ruleId"),
            F.struct(F.col("message").alias("text")).alias("message"),
            F.col("level").alias("level"),
            F.array(F.struct(place.alias("physicalLocation"))).alias("locations"),
            F.struct(
                F.lit("1").alias("primaryLocationStartColumnFingerprint"),
                F.col("fingerprint").alias("primaryLocationLineHash"),
            ).alias("partialFingerprints"),
        )
    )
    artifact = F.to_json(F.struct(F.struct(F.col("filename").alias("uri")).alias("location")))
    invocation = F.to_json(
        F.struct(F.lit(True).alias("executionSuccessful"), F.struct(F.lit(root_uri).alias("uri")).alias("workingDirectory"))
    )

    def comma(test: Column) -> Column:
        return F.when(test, F.lit("")).otherwise(F.lit(","))

    spot = F.format_string(
        "%d\x01%s\x01%010d\x01%s\x01%s",
        (~F.col("is_security")).cast("int"), F.col("filename"), F.col("start_line"), F.col("rule_id"), F.md5(result),
    )
    spotted = results.withColumn("_spot", spot)
    first_result = spotted.groupBy(*_RUN).agg(F.min("_spot").alias("_first"))
    spotted = lookup_join(spotted, first_result, _RUN, spread=["filename", "start_line"])

    ordered_rules = rules.withColumn("_at", F.row_number().over(Window.partitionBy(*_RUN).orderBy(F.col("is_security").desc(), "rule_id")))
    padded = F.format_string("%012d", F.col("artifact_index"))
    parts = [
        good.select(*_line([1, F.col("_key"), 0, ""], opened)),
        ordered_rules.select(*_line([1, run_key, 1, F.format_string("%012d", F.col("_at"))], F.concat(comma(F.col("_at") == 1), rule))),
        good.select(*_line([1, F.col("_key"), 2, ""], F.lit(']}},"results":['))),
        spotted.select(*_line([1, run_key, 3, F.col("_spot")], F.concat(comma(F.col("_spot") == F.col("_first")), result))),
        good.select(*_line([1, F.col("_key"), 4, ""], F.concat(F.lit('],"invocations":['), invocation, F.lit('],"artifacts":[')))),
        artifacts.select(*_line([1, run_key, 5, padded], F.concat(comma(F.col("artifact_index") == 0), artifact))),
        good.select(*_line([1, F.col("_key"), 6, ""], F.lit("]}"))),
    ]
    named = projects.select("project").distinct()
    begin = f'{{"$schema":"{SARIF_SCHEMA}","version":"{SARIF_VERSION}","runs":['
    document = named.select(*_line([0, "", 0, ""], F.lit(begin)))
    for part in [*parts, named.select(*_line([9, "", 0, ""], F.lit("]}")))]:
        document = document.unionByName(part)
    return document
