"""Pass or fail per project.

``runs (project, kind, tool, language, run_order, success, error)``; ``results`` carry
``project, tool, language``. Results are counted per run before any join, so hot projects cost nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lintlake.functions.scale import lookup_join

# Status codes.
SUCCESS = 0
FAILED_UPLOAD = 10
UNCOMMITTED_CHANGES = 11
COMMITS_DO_NOT_MATCH = 12
UNUSABLE_TOOL = 13
INVALID_CONFIGURATION = 14
FAILED_ANALYSIS = 100
PARTIALLY_FAILED_ANALYSIS = 101
MAX_ALLOWED_ISSUES_EXCEEDED = 102

# Error kinds with a code of their own; any other error is FAILED_ANALYSIS.
ERROR_CODES = {
    "CommitUuidsDoNotMatch": COMMITS_DO_NOT_MATCH,
    "UncommittedChanges": UNCOMMITTED_CHANGES,
    "NonExistingTool": UNUSABLE_TOOL,
    "StandaloneTool": UNUSABLE_TOOL,
    "UploadError": FAILED_UPLOAD,
    "MissingUploadRequisites": FAILED_UPLOAD,
    "InvalidConfiguration": INVALID_CONFIGURATION,
}

_RUN = ["project", "tool", "language"]


def status_code(error_kind: Column) -> Column:
    """Code of an error kind; null stays null."""
    code = F.lit(FAILED_ANALYSIS)
    for kind, value in ERROR_CODES.items():
        code = F.when(error_kind == kind, F.lit(value)).otherwise(code)
    return F.when(error_kind.isNotNull(), code)


def issue_count(projects: DataFrame, runs: DataFrame, results: DataFrame) -> DataFrame:
    """Results (issues and file errors) of successful issue runs; projects without any have 0."""
    per_run = results.groupBy(*_RUN).agg(F.count("*").alias("_n"))
    good = runs.filter("kind = 'issues' and success").select(*_RUN)
    summed = per_run.join(good, _RUN).groupBy("project").agg(F.sum("_n").alias("_n"))
    joined = projects.select("project").distinct().join(summed, "project", "left")
    return joined.select("project", F.coalesce("_n", F.lit(0)).alias("n_issues"))


def any_failure(runs: DataFrame) -> DataFrame:
    return runs.groupBy("project").agg(F.bool_or(~F.col("success")).alias("any_failure"))


def quality_gate(limits: DataFrame, counts: DataFrame, failures: DataFrame, errors: DataFrame) -> DataFrame:
    """``limits (project, max_allowed, fail_if_incomplete)`` and ``errors (project, error_kind)`` decide the code:
    an error first, then an unfinished run where that counts, then too many issues."""
    first_error = errors.groupBy("project").agg(F.min(status_code(F.col("error_kind"))).alias("_error_code"))
    joined = (
        limits.join(counts, "project", "left").join(failures, "project", "left").join(first_error, "project", "left")
    )
    n_issues = F.coalesce("n_issues", F.lit(0))
    failed = F.coalesce("any_failure", F.lit(False))
    code = (
        F.when(F.col("_error_code").isNotNull(), F.col("_error_code"))
        .when(F.col("fail_if_incomplete") & failed, F.lit(PARTIALLY_FAILED_ANALYSIS))
        .when(n_issues > F.col("max_allowed"), F.lit(MAX_ALLOWED_ISSUES_EXCEEDED))
        .otherwise(F.lit(SUCCESS))
    )
    return joined.select("project", n_issues.alias("n_issues"), failed.alias("any_failure"), code.alias("code"))


def run_summary(runs: DataFrame, results: DataFrame) -> DataFrame:
    """Per run: number of results, or the failure."""
    counts = results.groupBy("kind", *_RUN).agg(F.count("*").alias("_n"))
    joined = runs.join(counts, ["kind", *_RUN], "left")
    n = F.when(F.col("success"), F.coalesce("_n", F.lit(0)))
    return joined.select("project", "kind", "tool", "language", "run_order", "success", n.alias("n_results"), "error")


def collect_errors(statuses: DataFrame, fixed_message: str | None = None) -> DataFrame:
    """Fold the statuses of a project's runs: success only if all succeed, else the messages by run order.

    A project has at most tools x languages runs, so the message list is bounded by the catalog.
    """
    messages = F.array_sort(F.collect_list(F.when(~F.col("success"), F.struct("run_order", "error"))))
    joined = F.array_join(F.transform(messages, lambda m: m["error"]), "\n")
    folded = statuses.groupBy("project").agg(F.bool_and("success").alias("success"), joined.alias("_errors"))
    shown = F.col("_errors") if fixed_message is None else F.lit(fixed_message)
    return folded.select("project", "success", F.when(~F.col("success"), shown).alias("error"))


def drop_failed_runs(results: DataFrame, runs: DataFrame) -> DataFrame:
    """Results of runs that did not fail."""
    failed = runs.filter("not success").select(*_RUN).distinct()
    return lookup_join(results, failed, _RUN, spread=["filename"], how="left_anti")
