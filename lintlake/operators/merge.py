"""Merging partial results of several runs, and attaching them to files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lintlake.functions import text as tx
from lintlake.functions.scale import lookup_join, stage, weighted_join

METRICS = ["complexity", "loc", "cloc", "nr_methods", "nr_classes"]
MIN_CLONE_LINES = 5


def _no_lines() -> Column:
    return F.array().cast("array<struct<line:int,value:int>>")


# ---------------------------------------------------------------- metrics


def reduce_metrics(metrics: DataFrame) -> DataFrame:
    """Merge the runs of a language: per file the first value of each metric that is present, by run order."""
    present = [c for c in METRICS if c in metrics.columns]
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("run_order"))).alias(c) for c in present]
    if "line_complexities" in metrics.columns:
        filled = F.when(F.size("line_complexities") > 0, F.col("run_order"))
        firsts.append(F.coalesce(F.min_by("line_complexities", filled), _no_lines()).alias("line_complexities"))
    return metrics.groupBy("project", "language", "filename").agg(*firsts)


def run_files_union(run_files: DataFrame) -> DataFrame:
    """Files of merged runs: the union per language."""
    return run_files.select("project", "language", "filename").distinct()


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """One row per file whatever the language: the later run wins, then the greater language name."""
    values = [c for c in metrics.columns if c not in ("project", "filename")]
    last = F.max_by(F.struct(*values), F.struct("run_order", "language"))
    return metrics.groupBy("project", "filename").agg(last.alias("_m")).select("project", "filename", "_m.*")


def files_with_metrics(run_files: DataFrame, metrics: DataFrame) -> DataFrame:
    """Every file of a run with its metrics, or nulls."""
    return run_files.join(metrics, ["project", "language", "filename"], "left")


def metrics_in_scope(metrics: DataFrame, run_files: DataFrame) -> DataFrame:
    """Metrics of the files a run asked for."""
    keys = ["project", "run_order", "filename"]
    return metrics.join(run_files.select(*keys).distinct(), keys, "left_semi")


def fill_missing_loc(run_files: DataFrame, metrics: DataFrame, files: DataFrame) -> DataFrame:
    """Every run file with metrics and a line count.

    ``metrics`` has one row per (project, filename), see :func:`latest_metrics`; rows of files outside
    the run drop out. Texts are counted where they are read, only the counts are joined; ``files`` that carry
    a ``loc`` already are not counted again.
    """
    values = metrics.drop("language", "run_order", "tool")
    loc = F.col("loc") if "loc" in files.columns else tx.count_loc(F.col("text"))
    counted = files.select("project", "filename", loc.alias("_loc"))
    joined = run_files.join(values, ["project", "filename"], "left").join(counted, ["project", "filename"], "left")
    filled = joined.withColumn("loc", F.coalesce("loc", "_loc")).drop("_loc")
    if "line_complexities" in values.columns:
        filled = filled.withColumn("line_complexities", F.coalesce("line_complexities", _no_lines()))
    return filled


_RUN = ["project", "language", "run_order"]
_DIGEST = ["n", "digest_a", "digest_b"]


def set_digests(run_files: DataFrame, run: Sequence[str] = _RUN) -> DataFrame:
    """One row per run with an order-free digest of its files: their number and two sums of hashes of their names.

    Sums of partial groups add up, so a run with very many files is digested by many tasks.
    """
    files = run_files.select(*run, "filename").distinct()
    name = F.sha2(F.encode("filename", "UTF-8"), 256)
    parts = [F.conv(F.substring(name, at, 15), 16, 10).cast("decimal(20,0)") for at in (1, 17)]
    return files.groupBy(*run).agg(
        F.count("*").alias("n"), F.sum(parts[0]).alias("digest_a"), F.sum(parts[1]).alias("digest_b")
    )


def merge_metrics_runs(runs: DataFrame) -> DataFrame:
    """Runs with the successful ones of a language as one, named by the first; failed runs stay as they are."""
    ok = runs.filter("success").groupBy("project", "language").agg(F.min("run_order").alias("run_order"))
    return ok.select(*_RUN, F.lit(True).alias("success"), F.lit(None).cast("string").alias("error")).unionByName(
        runs.filter("not success").select(*_RUN, "success", "error")
    )


def merged_run_files(runs: DataFrame, run_files: DataFrame) -> DataFrame:
    """Files of the runs of :func:`merge_metrics_runs`: a merged run has the files of all its runs."""
    flagged = lookup_join(run_files.select(*_RUN, "filename"), runs.select(*_RUN, "success"), _RUN, ["filename"], "inner")
    ok = runs.filter("success").groupBy("project", "language").agg(F.min("run_order").alias("_first"))
    named = lookup_join(flagged, ok, ["project", "language"], ["filename"])
    order = F.when(F.col("success"), F.col("_first")).otherwise(F.col("run_order"))
    return named.select("project", "language", order.alias("run_order"), "filename").distinct()


def recover_failed_metrics(runs: DataFrame, run_files: DataFrame) -> DataFrame:
    """Metrics runs after the merge, plus a recovered success for each failure nobody else covered.

    ``runs (project, language, run_order, success, error)`` and ``run_files`` with the same keys. A
    failed run is covered when a successful run of the language has exactly the same files. Runs meet by the digests of
    their files, and the names themselves are compared only where digests agree, with the first successful run that has
    the digest: no run is paired with another, no set is gathered in one place, and a coincidence of digests can't cover
    a run.
    """
    digested = runs.join(set_digests(run_files), _RUN, "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in _DIGEST]
    digested = digested.select(*_RUN, "success", *zero)
    alike = ["project", "language", *_DIGEST]
    first = digested.filter("success").groupBy(*alike).agg(F.min("run_order").alias("ok_order"))
    candidates = stage(digested.filter("not success").join(first, alike).select(*_RUN, "n", "ok_order"), "run-candidates")

    def files_of(side: DataFrame) -> DataFrame:
        return lookup_join(run_files.select(*_RUN, "filename"), side, _RUN, ["filename"], "inner").distinct()

    failed_files = files_of(candidates.select(*_RUN, "ok_order"))
    ok_files = files_of(candidates.select("project", "language", F.col("ok_order").alias("run_order")).distinct())
    ok_files = ok_files.withColumnRenamed("run_order", "ok_order")
    shared = failed_files.join(ok_files, ["project", "language", "ok_order", "filename"]).groupBy(*_RUN).agg(F.count("*").alias("n_shared"))
    same = F.col("n") == F.coalesce("n_shared", F.lit(0))
    covered = candidates.join(shared, _RUN, "left").filter(same).select(*_RUN)
    recovered = runs.filter("not success").join(covered, _RUN, "left_anti").withColumn("success", F.lit(True))
    recovered = recovered.withColumn("error", F.lit(None).cast("string")).withColumn("recovered", F.lit(True))
    return runs.withColumn("recovered", F.lit(False)).unionByName(recovered.select(*runs.columns, "recovered"))


# ---------------------------------------------------------------- clones


def clones_min_lines(clones: DataFrame, min_lines: int = MIN_CLONE_LINES) -> DataFrame:
    return clones.filter(F.col("nr_lines") >= min_lines)


def filter_clones(
    occurrences: DataFrame, files: DataFrame, min_lines: int = MIN_CLONE_LINES, clone: Sequence[str] = ("project", "clone_id")
) -> DataFrame:
    """Occurrences in files in scope, of clones of which more than one such occurrence is left."""
    clone = list(clone)
    scope = files.select("project", "filename").distinct()
    kept = clones_min_lines(occurrences, min_lines).join(scope, ["project", "filename"], "left_semi")
    counts = kept.groupBy(*clone).agg(F.count("*").alias("_n")).filter("_n > 1")
    matched = weighted_join(kept, counts, clone, weight="_n", spread=["filename", "start_line"])
    return matched.select(*occurrences.columns).distinct()


# ---------------------------------------------------------------- result sets

RESULT_COLUMNS = [
    "project", "tool", "language", "kind", "pattern_id", "filename", "message", "level", "category", "line", "column",
]


def dedupe_results(results: DataFrame) -> DataFrame:
    """Results are sets: identical rows collapse."""
    return results.dropDuplicates()


def results_union(issues: DataFrame, file_errors: DataFrame) -> DataFrame:
    """Issues and file errors as one result table with a ``kind`` column."""
    errors = file_errors.withColumn("message", tx.error_message(F.col("message")))
    both = issues.withColumn("kind", F.lit("Issue")).unionByName(
        errors.withColumn("kind", F.lit("FileError")), allowMissingColumns=True
    )
    return dedupe_results(both.select(*RESULT_COLUMNS))


def partition_results(results: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split a mixed table by ``kind``: issue results, clones, metrics. Other kinds are dropped."""
    return tuple(results.filter(F.col("kind") == k) for k in ("issues", "duplication", "metrics"))  # type: ignore[return-value]


def recombine_results(issues: DataFrame, duplication: DataFrame, metrics: DataFrame) -> DataFrame:
    return issues.unionByName(duplication, allowMissingColumns=True).unionByName(metrics, allowMissingColumns=True)


_RUN_FILE = ["project", "tool", "language", "filename"]


def count_results_by_file(run_files: DataFrame, results: DataFrame) -> DataFrame:
    """Every run file with its number of results; results of other files are dropped."""
    counts = results.groupBy(*_RUN_FILE).agg(F.count("*").alias("_n"))
    joined = run_files.select(*_RUN_FILE).distinct().join(counts, _RUN_FILE, "left")
    return joined.select(*_RUN_FILE, F.coalesce("_n", F.lit(0)).alias("n_results"))


def group_results_by_file(run_files: DataFrame, results: DataFrame) -> DataFrame:
    """Every run file with each of its results; a file without results is one row of nulls.

    Flat, because a file can have any number of results. Results of other files are dropped, and results
    of a file that has very many of them are spread over several tasks.
    """
    values = [c for c in results.columns if c not in _RUN_FILE]
    counts = count_results_by_file(run_files, results)
    found = weighted_join(results, counts.filter("n_results > 0"), _RUN_FILE, "n_results", spread=values)
    empty = counts.filter("n_results = 0").select(*_RUN_FILE)
    return found.select(*_RUN_FILE, *values).unionByName(empty, allowMissingColumns=True)
