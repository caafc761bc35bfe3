"""End-to-end analysis of many projects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from lintlake.functions.scale import lookup_join, stage
from lintlake.operators import analysers, gate, merge, paths, planning


@dataclass
class Analysis:
    """Tables of one analysis, each derived from the inputs when first asked for.

    ``files (project, filename, is_readable, text)``; ``failures (project, tool, error)`` are runs that
    failed outside. Rules and planned runs are small and read by every later step, so they are staged once.
    ``reported_metrics`` names the metrics that a metrics tool reports; a tool it does not name reports all.

    The texts are read once, by ``scanned``, which all results come from; texts of clones take a second pass.
    """

    files: DataFrame
    listing: DataFrame
    rules: DataFrame
    local_config: DataFrame
    extensions: DataFrame
    tools: DataFrame
    patterns: DataFrame
    tool_config: DataFrame
    failures: DataFrame
    metric_rules: Mapping[str, analysers.MetricRule]
    reported_metrics: Mapping[str, Sequence[str]] = field(default_factory=dict)

    @cached_property
    def projects(self) -> DataFrame:
        return self.files.select("project").distinct()

    @cached_property
    def global_rules(self) -> DataFrame:
        return stage(paths.rule_index(paths.effective_rules(self.rules, self.local_config)), "global-rules")

    @cached_property
    def tool_rules(self) -> DataFrame:
        return paths.tool_rule_profile(self.rules)

    @cached_property
    def suffixes(self) -> DataFrame:
        return paths.extension_profile(self.extensions)

    @cached_property
    def kept(self) -> DataFrame:
        """Readable files that no global rule excludes."""
        return paths.filter_global(self.files.filter("is_readable").drop("is_readable"), self.global_rules)

    @cached_property
    def project_languages(self) -> DataFrame:
        detected = paths.detect_languages(self.kept.select("project", "filename"), self.suffixes)
        return stage(paths.project_languages(detected), "project-languages")

    @cached_property
    def planned(self) -> DataFrame:
        issues = planning.plan_with_fallback(self.tool_config, self.tools, self.project_languages)
        metrics = planning.plan_metrics_tools(self.tools, self.project_languages)
        duplication = planning.plan_duplication_tools(self.tools, self.project_languages)
        runs = planning.union_tool_runs(issues, metrics, duplication)
        return stage(planning.number_runs(runs), "planned-runs")

    @cached_property
    def modes(self) -> DataFrame:
        """Configuration mode of every planned issue tool."""
        pairs = self.planned.filter("kind = 'issues'").select("project", "tool", "tool_uuid").distinct()
        found = paths.has_config_files(self.listing, self.tools.filter("kind = 'issues'"), pairs)
        return stage(planning.tool_run_mode(pairs.join(found, ["project", "tool"]), self.tool_config), "run-modes")

    @cached_property
    def runs(self) -> DataFrame:
        """Planned runs with ``success`` and ``error``."""
        unusable = self.modes.filter("mode = 'error'").select("project", "tool", "error")
        errors = unusable.unionByName(self.failures).groupBy("project", "tool").agg(F.min("error").alias("error"))
        joined = self.planned.join(errors, ["project", "tool"], "left")
        return stage(joined.withColumn("success", F.col("error").isNull()), "runs")

    def files_of(self, kind: str) -> DataFrame:
        """Files, with text, of the successful runs of a kind.

        Metrics and duplication do not depend on which tool asks, so their files are read once per language.
        """
        jobs = self.jobs.filter((F.col("kind") == kind) & F.col("success")).drop("success")
        return paths.filter_tool(jobs, self.kept, self.tool_rules, self.suffixes)

    @cached_property
    def jobs(self) -> DataFrame:
        """(project, kind, tool, language, success): what a text is read for.

        Metrics and duplication are one job per language, whichever tools ask; a job has succeeded if one of its runs has.
        Files of failed metrics runs still get their line count.
        """
        tool = F.when(F.col("kind") == "issues", F.col("tool")).otherwise(F.col("kind")).alias("tool")
        return self.runs.groupBy("project", "kind", tool, "language").agg(F.max("success").alias("success"))

    @cached_property
    def run_files(self) -> DataFrame:
        """Files of every run, failed ones included."""
        return paths.filter_tool(self.runs, self.kept.drop("text"), self.tool_rules, self.suffixes)

    @cached_property
    def scanned(self) -> DataFrame:
        """All analyses of all texts, staged by kind, see :func:`analysers.scan_once`."""
        enabled = planning.enabled_patterns(self.modes, self.tool_config, self.tools, self.patterns)
        allowed = planning.run_patterns(self.modes, enabled)
        jobs = self.jobs.filter("success or kind = 'metrics'").drop("success")
        files = paths.filter_tool(jobs, self.kept, self.tool_rules, self.suffixes)
        files = lookup_join(files, allowed, ["project", "tool"], spread=["filename"])
        found = analysers.scan_once(files, analysers.rules_of(self.patterns), self.metric_rules)
        return stage(found, "scanned", by=["kind"])

    @cached_property
    def rule_errors(self) -> DataFrame:
        """(project, tool, pattern_id, regex, error): broken patterns of the tools that run for a project."""
        broken = analysers.broken_rules(self.patterns)
        return lookup_join(self.modes.select("project", "tool").distinct(), broken, ["tool"], spread=["project"], how="inner")

    @cached_property
    def issues(self) -> DataFrame:
        column = F.lit(None).cast("int").alias("column")
        return self.scanned.filter("kind = 'issues'").select(*analysers.ISSUE_COLUMNS[:-1], column, "fingerprint")

    @cached_property
    def measured(self) -> DataFrame:
        """Everything that can be measured of each file of a metrics run."""
        columns = ["project", "language", "filename", *analysers.METRIC_FIELDS]
        return self.scanned.filter("kind = 'metrics'").select(*columns)

    @cached_property
    def metrics_run_files(self) -> DataFrame:
        """(project, language, run_order, tool, success, filename) of every metrics run."""
        runs = self.runs.filter("kind = 'metrics'").select("project", "language", "run_order", "tool", "success")
        files = self.measured.select("project", "language", "filename")
        return lookup_join(files, runs, ["project", "language"], spread=["filename"], how="inner")

    @cached_property
    def partial_metrics(self) -> DataFrame:
        """What each successful metrics run reports, one row per run and file."""
        runs = self.runs.filter("kind = 'metrics' and success").select("project", "language", "run_order", "tool")
        rows = lookup_join(self.measured, runs, ["project", "language"], spread=["filename"], how="inner")

        def reported(metric: str) -> Column:
            silent = [tool for tool, metrics in self.reported_metrics.items() if metric not in metrics]
            return F.when(~F.col("tool").isin(silent), F.col(metric)).otherwise(F.lit(None)).alias(metric)

        return rows.select("project", "language", "run_order", "filename", *map(reported, analysers.METRIC_FIELDS))

    @cached_property
    def metrics_runs(self) -> DataFrame:
        """(project, language, run_order, success, error, recovered): the runs whose results count.

        The successful runs of a language as one, the failed ones, and for each of these that no successful run covers
        a recovered one, which has line counts only.
        """
        runs = self.runs.filter("kind = 'metrics'").select("project", "language", "run_order", "success", "error")
        files = merge.merged_run_files(runs, self.metrics_run_files)
        return stage(merge.recover_failed_metrics(merge.merge_metrics_runs(runs), files), "metrics-runs")

    @cached_property
    def metrics(self) -> DataFrame:
        """Metrics of every file of a metrics run, with line counts, one row per (project, language, file).

        The successful runs of a language are merged; recovered runs only bring their files.
        """
        good = self.metrics_runs.filter("success").select("project", "language", "run_order")
        files = merge.merged_run_files(self.runs.filter("kind = 'metrics'"), self.metrics_run_files)
        kept = lookup_join(files, good, ["project", "language", "run_order"], spread=["filename"], how="left_semi")
        merged = merge.reduce_metrics(self.partial_metrics).withColumn("run_order", F.lit(1))
        counted = self.measured.select("project", "filename", "loc").distinct()
        return merge.fill_missing_loc(merge.run_files_union(kept), merge.latest_metrics(merged), counted)

    @cached_property
    def clone_occurrences(self) -> DataFrame:
        windows = self.scanned.filter("kind = 'duplication'").select("project", "language", "filename", *analysers.WINDOW_FIELDS)
        found = analysers.clones_of_windows(windows)
        return merge.filter_clones(found, self.kept, clone=("project", "language", "clone_id"))

    @cached_property
    def plan_errors(self) -> DataFrame:
        """Projects without any usable tool."""
        with_config = planning.enabled_tools(self.tool_config).select("project").distinct()
        open_projects = self.projects.join(with_config, "project", "left_anti")
        errors = planning.plan_errors(open_projects, self.planned.filter("kind = 'issues'"))
        return errors.select("project", F.lit("NoToolsFound").alias("error_kind"))

    def quality_gate(self, limits: DataFrame) -> DataFrame:
        counts = gate.issue_count(self.projects, self.runs, self.issues)
        return gate.quality_gate(limits, counts, gate.any_failure(self.runs), self.plan_errors)

    def overview(self, limits: DataFrame) -> DataFrame:
        """Per project: the gate and the size of each kind of result."""
        files = self.metrics.groupBy("project").agg(
            F.count("*").alias("n_metrics"), F.sum("loc").alias("loc"), F.sum("complexity").alias("complexity")
        )
        clones = self.clone_occurrences.groupBy("project").agg(
            F.count("*").alias("n_clone_occurrences"), F.countDistinct("language", "clone_id").alias("n_clones")
        )
        metrics_runs = self.runs.filter("kind = 'metrics'").groupBy("project").agg(F.count("*").alias("n_metrics_runs"))
        recovered = self.metrics_runs.filter("recovered").groupBy("project").agg(F.count("*").alias("n_recovered_runs"))
        gated = self.quality_gate(limits)
        for part in (files, clones, metrics_runs, recovered):
            gated = gated.join(part, "project", "left")
        numbers = ["n_metrics", "loc", "complexity", "n_clone_occurrences", "n_clones", "n_metrics_runs", "n_recovered_runs"]
        return gated.select(
            "project", "n_issues", "any_failure", "code", *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers]
        )


