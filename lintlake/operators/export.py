"""Nested reports and upload payloads."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lintlake.functions.scale import lookup_join, spread_rank, weighted_join
from lintlake.operators.merge import group_results_by_file
from lintlake.operators.report import _issue_fields, _line, _location

DEFAULT_BATCH_SIZE = 50000
_RUN = ["project", "tool", "language"]
_RUN_FILE = [*_RUN, "filename"]


# ---------------------------------------------------------------- batches


def _plan_batches(counts: DataFrame, size: int) -> DataFrame:
    """Where each class of equally large files starts, per run.

    Greedy packing in descending order of results only depends on how many files have each number of
    results, so the packing is folded over those (size, count) pairs: at most ``size`` per run, however
    many files there are. Adds ``start`` (batch of the first file), ``first`` (files that still fit that
    batch) and ``per_batch`` (files in each later batch).
    """

    def fold(pairs: pd.DataFrame) -> pd.DataFrame:
        ordered = pairs.sort_values("n_results", ascending=False)
        used, batch, plan = 0, 0, []
        for n, count in zip(ordered["n_results"].tolist(), ordered["_count"].tolist()):
            if n >= size:
                batch += count
            elif n > 0:
                room, per_batch = (size - 1 - used) // n, (size - 1) // n
                plan.append((n, batch, room, per_batch))
                over = count - room
                if over <= 0:
                    used += count * n
                else:
                    opened = -(-over // per_batch)
                    used, batch = (over - (opened - 1) * per_batch) * n, batch + opened
        plan.append((0, batch, 0, 0))
        found = pd.DataFrame(plan, columns=["n_results", "start", "first", "per_batch"])
        return found.assign(**pairs[_RUN].iloc[0])

    runs = ", ".join(f"{key} string" for key in _RUN)
    schema = f"{runs}, n_results long, start long, first long, per_batch long"
    return counts.groupBy(*_RUN).applyInPandas(fold, schema)


def _quotient(a: Column, b: Column) -> Column:
    return F.floor(a / b).cast("bigint")


def upload_batches(files: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """Adds ``batch`` (from 0, per run) to ``(project, tool, language, filename, n_results)``.

    Files are packed greedily and never split: a file goes into the next batch when the results so far
    and its own reach ``batch_size``. The order of files is free; here it is by results, most first,
    counting ``batch_size`` and more as equal, then by the hash of the name. So the files that fill a batch
    come first, one batch each, and the batch of every other file follows from its position among the
    files of its size.
    """
    size = batch_size if batch_size > 0 else DEFAULT_BATCH_SIZE
    sized = files.select(*_RUN_FILE, F.col("n_results").cast("bigint").alias("n_results"))
    capped = F.when(F.col("n_results") >= size, F.lit(size).cast("bigint")).otherwise(F.col("n_results"))
    counts = sized.groupBy(*_RUN, capped.alias("n_results")).agg(F.count("*").alias("_count"))
    plan = _plan_batches(counts, size).withColumnRenamed("n_results", "_class")
    ranked = spread_rank(sized.withColumn("_class", capped), [*_RUN, "_class"], "filename", "_rank")
    joined = lookup_join(ranked, plan, [*_RUN, "_class"], spread=["filename"])
    rank, first = F.col("_rank"), F.col("first")
    batch = (
        F.when(F.col("_class") >= size, rank)
        .when(F.col("_class") == 0, F.col("start"))
        .when(rank < first, F.col("start"))
        .otherwise(F.col("start") + 1 + _quotient(rank - first, F.col("per_batch")))
    )
    return joined.select(*_RUN_FILE, "n_results", batch.cast("int").alias("batch"))


# ---------------------------------------------------------------- nested JSON


def _tagged(kind: Column) -> Column:
    """Result as a struct with the one member that applies (nulls are dropped when rendered)."""
    issue = F.struct(*_issue_fields(_location()))
    error = F.struct(F.col("filename").alias("filename"), F.col("message").alias("message"))
    return F.struct(F.when(kind == "Issue", issue).alias("Issue"), F.when(kind == "FileError", error).alias("FileError"))


def result_rows_json(run_files: DataFrame, results: DataFrame) -> DataFrame:
    """``(project, tool, language, filename, json)``: one row per result, ``json`` null for files without."""
    rows = group_results_by_file(run_files, results).withColumn("json", F.to_json(_tagged(F.col("kind"))))
    return rows.select(*_RUN_FILE, F.when(F.col("kind").isNotNull(), F.col("json")).alias("json"))


def issues_report(runs: DataFrame, run_files: DataFrame, results: DataFrame) -> DataFrame:
    """Per project a JSON array with one entry per issue run, as document lines.

    A successful run lists its files with their results, a failed one has its message. Files and results
    are lines of their own; the first of each list is found by an aggregate.
    """
    run_key = F.concat_ws("\x01", "tool", "language")
    issue_runs = runs.filter("kind = 'issues'").select(*_RUN, "success", "error").withColumn("_key", run_key)
    first_run = issue_runs.groupBy("project").agg(F.min("_key").alias("_first"))
    keyed = issue_runs.join(first_run, "project")
    name = F.to_json(F.struct("tool"))
    lead = F.concat(
        F.when(F.col("_key") == F.col("_first"), F.lit("")).otherwise(F.lit(",")),
        F.substr(name, F.lit(1), F.length(name) - 1), F.lit(',"issues":{'),
    )
    failure = F.to_json(F.struct(F.struct(F.col("error").alias("message")).alias("Failure")))
    good, failed = keyed.filter("success"), keyed.filter("not success")

    listed = run_files.select(*_RUN_FILE).distinct()
    first_file = listed.groupBy(*_RUN).agg(F.min("filename").alias("_first_file"))
    heads = lookup_join(listed, good.select(*_RUN, "_key").join(first_file, _RUN), _RUN, spread=["filename"], how="inner")
    file_name = F.to_json(F.struct("filename"))
    opened = F.concat(
        F.when(F.col("filename") == F.col("_first_file"), F.lit("")).otherwise(F.lit(",")),
        F.substr(file_name, F.lit(1), F.length(file_name) - 1), F.lit(',"results":['),
    )

    tagged = results.select(*_RUN_FILE, F.to_json(_tagged(F.col("kind"))).alias("json")).distinct()
    grouped = tagged.groupBy(*_RUN_FILE).agg(F.count("*").alias("_n"), F.min("json").alias("_first_json"))
    scoped = heads.select(*_RUN_FILE, "_key").join(grouped, _RUN_FILE)
    rows = weighted_join(tagged, scoped, _RUN_FILE, "_n", spread=["json"])
    comma = F.when(F.col("json") == F.col("_first_json"), F.lit("")).otherwise(F.lit(","))

    def at(part: str, *more: str) -> Column:
        return F.concat("filename", F.lit("\x01" + part), *more)

    projects = runs.select("project").distinct()
    parts = [
        projects.select(*_line([0, "", 0, ""], F.lit("["))),
        good.select(*_line([1, F.col("_key"), 0, ""], F.concat(lead, F.lit('"Success":{"results":[')))),
        heads.select(*_line([1, F.col("_key"), 1, at("0")], opened)),
        rows.select(*_line([1, F.col("_key"), 1, at("1", "json")], F.concat(comma, "json"))),
        heads.select(*_line([1, F.col("_key"), 1, at("2")], F.lit("]}"))),
        good.select(*_line([1, F.col("_key"), 2, ""], F.lit("]}}}"))),
        failed.select(*_line([1, F.col("_key"), 0, ""], F.concat(lead, F.substr(failure, F.lit(2)), F.lit("}")))),
        projects.select(*_line([9, "", 0, ""], F.lit("]"))),
    ]
    document = parts[0]
    for part in parts[1:]:
        document = document.unionByName(part)
    return document


# ---------------------------------------------------------------- upload payloads


def issue_payloads(runs: DataFrame, run_files: DataFrame, results: DataFrame, counts: DataFrame, batch_size: int) -> DataFrame:
    """Rows of the issue payloads ``(project, kind, tool, language, batch, filename, payload)``.

    One row per result, in the batch of its file, and one without payload per file without results; a
    failed run is one row with its message.
    """
    good = runs.filter("kind = 'issues' and success").select(*_RUN).distinct()
    batched = lookup_join(upload_batches(counts, batch_size), good, _RUN, spread=["filename"], how="left_semi")
    found = result_rows_json(run_files, results)
    weights = batched.withColumn("_n", F.greatest("n_results", F.lit(1))).drop("n_results")
    rendered = weighted_join(found, weights, _RUN_FILE, "_n", spread=["json"])
    return rendered.select(
        "project", F.lit("issues").alias("kind"), "tool", "language", "batch", "filename", F.col("json").alias("payload")
    ).unionByName(_failure_payloads(runs, "issues"))


def _failure_payloads(runs: DataFrame, kind: str) -> DataFrame:
    message = F.to_json(F.struct(F.struct(F.col("error").alias("message")).alias("Failure")))
    failed = runs.filter((F.col("kind") == kind) & ~F.col("success"))
    return failed.select(
        "project", F.lit(kind).alias("kind"), "tool", "language", F.lit(0).alias("batch"),
        F.lit(None).cast("string").alias("filename"), message.alias("payload"),
    )


def metrics_payloads(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row per file with its metrics or null, in one batch per project."""
    values = F.struct(
        F.col("complexity").alias("complexity"), F.col("loc").alias("loc"), F.col("cloc").alias("cloc"),
        F.col("nr_methods").alias("nrMethods"), F.col("nr_classes").alias("nrClasses"),
        F.col("line_complexities").alias("lineComplexities"),
    )
    payload = F.to_json(F.struct(F.col("filename").alias("file"), values.alias("metrics")))
    return metrics.select(
        "project", F.lit("metrics").alias("kind"), F.lit("metrics").alias("tool"), "language", F.lit(0).alias("batch"),
        "filename", payload.alias("payload"),
    ).unionByName(_failure_payloads(runs, "metrics"))


def duplication_payloads(runs: DataFrame, occurrences: DataFrame, clones: DataFrame, files: DataFrame) -> DataFrame:
    """Clones, their occurrences and the analysed files, one row each, in one batch per project."""

    def rows(table: DataFrame, filename: Column, fields: dict[str, str]) -> DataFrame:
        entry = F.struct(*[F.col(column).alias(name) for name, column in fields.items()])
        return table.select(
            "project", F.lit("duplication").alias("kind"), F.lit("duplication").alias("tool"), "language",
            F.lit(0).alias("batch"), filename.alias("filename"), F.to_json(entry).alias("payload"),
        )

    place = {"cloneId": "clone_id", "filePath": "filename", "startLine": "start_line", "endLine": "end_line"}
    text = {"cloneId": "clone_id", "cloneLines": "clone_lines", "nrTokens": "nr_tokens", "nrLines": "nr_lines"}
    found = rows(occurrences, F.col("filename"), place).unionByName(rows(clones, F.lit(None).cast("string"), text))
    analysed = rows(files.select("project", "language", "filename").distinct(), F.col("filename"), {"analysedFile": "filename"})
    return found.unionByName(analysed).unionByName(_failure_payloads(runs, "duplication"))
