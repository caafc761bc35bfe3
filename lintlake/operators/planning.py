"""Which tools run on which project and language.

``tools`` is ``(tool_uuid, kind, tool, prefix, languages, standalone, ...)``; runs are
``(project, kind, tool, tool_uuid, language)`` rows with bag semantics: a tool listed twice runs twice.
Projects can be many, tools are few, so the tool side is always the lookup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lintlake.functions import text
from lintlake.functions.scale import lookup_join

RUN_COLUMNS = ["project", "kind", "tool", "tool_uuid", "language"]
# Messages of planning errors.
NO_TOOLS = "No tools found for files provided"
NO_ACTIVE_TOOL = "No active tool found on the remote configuration"


def _offered(tools: DataFrame, kind: str) -> DataFrame:
    of_kind = tools.filter((F.col("kind") == kind) & ~F.col("standalone"))
    return of_kind.select("kind", "tool", "tool_uuid", F.explode(F.array_distinct("languages")).alias("language"))


def plan_tools(tools: DataFrame, project_languages: DataFrame, kind: str) -> DataFrame:
    """One run per tool and language of the project."""
    joined = lookup_join(project_languages, _offered(tools, kind), ["language"], spread=["project"], how="inner")
    return joined.select(*RUN_COLUMNS)


def plan_issue_tools(tools: DataFrame, project_languages: DataFrame) -> DataFrame:
    return plan_tools(tools, project_languages, "issues")


def plan_metrics_tools(tools: DataFrame, project_languages: DataFrame) -> DataFrame:
    return plan_tools(tools, project_languages, "metrics")


def plan_duplication_tools(tools: DataFrame, project_languages: DataFrame) -> DataFrame:
    return plan_tools(tools, project_languages, "duplication")


def plan_errors(projects: DataFrame, runs: DataFrame, message: str = NO_TOOLS) -> DataFrame:
    """Projects for which nothing was planned."""
    missing = projects.select("project").distinct().join(runs.select("project").distinct(), "project", "left_anti")
    return missing.withColumn("error", F.lit(message))


def languages_without_tools(project_languages: DataFrame, tools: DataFrame, kind: str) -> DataFrame:
    offered = _offered(tools, kind).select("language").distinct()
    return lookup_join(project_languages, offered, ["language"], spread=["project"], how="left_anti")


def enabled_tools(tool_config: DataFrame) -> DataFrame:
    return tool_config.filter("enabled")


def select_configured_tools(tool_config: DataFrame, tools: DataFrame, project_languages: DataFrame) -> DataFrame:
    """Runs of the tools each project has enabled (uuid as written)."""
    enabled = enabled_tools(tool_config).select("project", "tool_uuid").distinct()
    offered = lookup_join(enabled, _offered(tools, "issues"), ["tool_uuid"], spread=["project"], how="inner")
    return offered.join(project_languages, ["project", "language"]).select(*RUN_COLUMNS)


def projects_without_active_tool(projects: DataFrame, tool_config: DataFrame) -> DataFrame:
    return plan_errors(projects, enabled_tools(tool_config), NO_ACTIVE_TOOL)


def unknown_configured_tools(tool_config: DataFrame, tools: DataFrame) -> DataFrame:
    known = tools.filter((F.col("kind") == "issues") & ~F.col("standalone")).select("tool_uuid").distinct()
    enabled = enabled_tools(tool_config).select("project", "tool_uuid").distinct()
    return lookup_join(enabled, known, ["tool_uuid"], spread=["project"], how="left_anti")


def plan_with_fallback(tool_config: DataFrame, tools: DataFrame, project_languages: DataFrame) -> DataFrame:
    """Configured tools where a project enables any, else all tools for its languages."""
    configured = select_configured_tools(tool_config, tools, project_languages)
    with_config = enabled_tools(tool_config).select("project").distinct()
    by_language = plan_issue_tools(tools, project_languages).join(with_config, "project", "left_anti")
    return configured.unionByName(by_language.select(*RUN_COLUMNS))


def union_tool_runs(issues: DataFrame, metrics: DataFrame, duplication: DataFrame) -> DataFrame:
    return issues.unionByName(metrics).unionByName(duplication)


def select_runs(selection: str | None, runs: DataFrame, tools: DataFrame, project_languages: DataFrame) -> DataFrame:
    """All runs, one kind of runs, or the runs of one issue tool given by short name or uuid.

    ``runs`` is the result of :func:`union_tool_runs`. Naming a tool ignores the project configuration.
    """
    if selection is None:
        return runs
    if selection in ("issues", "metrics", "duplication"):
        return runs.filter(F.col("kind") == selection)
    asked = selection.lower()
    named = tools.filter((F.lower("tool") == asked) | (F.lower("tool_uuid") == asked))
    return plan_issue_tools(named, project_languages)


def number_runs(runs: DataFrame) -> DataFrame:
    """Adds ``run_order``, 1-based within the project. A project has at most tools x languages runs."""
    order = Window.partitionBy("project").orderBy("kind", "tool", "language")
    return runs.withColumn("run_order", F.row_number().over(order))


def intersect_languages(tools: DataFrame, project_languages: DataFrame, kind: str = "issues") -> DataFrame:
    """Languages a tool shares with a project; the array is bounded by the language vocabulary."""
    runs = plan_tools(tools, project_languages, kind)
    return runs.groupBy("project", "tool").agg(F.array_sort(F.collect_set("language")).alias("languages"))


# ---------------------------------------------------------------- configuration of a run


def _config_by_uuid(tool_config: DataFrame) -> DataFrame:
    """One entry per project and tool uuid, ignoring case."""
    entry = F.struct("not_edited", "patterns")
    return tool_config.groupBy("project", F.lower("tool_uuid").alias("_uuid")).agg(F.min_by(entry, "tool_uuid").alias("_entry"))


def tool_run_mode(pairs: DataFrame, tool_config: DataFrame) -> DataFrame:
    """Adds ``mode`` to ``(project, tool, tool_uuid, has_config_files)``.

    ``defaults`` without an entry for the tool; ``file`` if the entry was not edited and a configuration
    file exists; ``patterns`` if the entry lists patterns; else ``error``.
    """
    keyed = pairs.withColumn("_uuid", F.lower("tool_uuid"))
    joined = keyed.join(_config_by_uuid(tool_config), ["project", "_uuid"], "left")
    mode = (
        F.when(F.col("_entry").isNull(), F.lit("defaults"))
        .when(F.col("_entry.not_edited") & F.col("has_config_files"), F.lit("file"))
        .when(F.size("_entry.patterns") > 0, F.lit("patterns"))
        .otherwise(F.lit("error"))
    )
    message = F.concat(F.lit("Could not find conditions to run tool "), F.col("tool"))
    return (
        joined.withColumn("mode", mode)
        .withColumn("error", F.when(F.col("mode") == "error", message))
        .select(*pairs.columns, "mode", "error")
    )


def engine_extras(pairs: DataFrame, engine_config: DataFrame) -> DataFrame:
    """Sub-directory and free-form options of a tool, by tool name."""
    return pairs.join(engine_config, ["project", "tool"], "left")


def configured_patterns(tool_config: DataFrame, tools: DataFrame) -> DataFrame:
    """``(project, tool, id, parameters)`` with ids without tool prefix and parameters as a map."""
    entries = _config_by_uuid(tool_config).select("project", "_uuid", F.explode("_entry.patterns").alias("_p"))
    names = tools.filter("kind = 'issues'").select(F.lower("tool_uuid").alias("_uuid"), "tool", "prefix").distinct()
    joined = lookup_join(entries, names, ["_uuid"], spread=["project"], how="inner")
    parameters = F.map_from_entries(F.transform("_p.parameters", lambda p: F.struct(p["name"], p["value"])))
    bare = text.strip_prefix(F.col("_p.id"), F.col("prefix"))
    return joined.select("project", "tool", bare.alias("id"), parameters.alias("parameters"))


def enabled_patterns(modes: DataFrame, tool_config: DataFrame, tools: DataFrame, patterns: DataFrame) -> DataFrame:
    """Catalog patterns that run in projects whose mode for the tool is ``patterns``."""
    chosen = modes.filter("mode = 'patterns'").select("project", "tool").distinct()
    configured = configured_patterns(tool_config, tools).join(chosen, ["project", "tool"], "left_semi")
    catalog = patterns.select("tool", "id", "level", "category")
    return lookup_join(configured, catalog, ["tool", "id"], spread=["project"], how="inner")


def run_patterns(modes: DataFrame, enabled: DataFrame) -> DataFrame:
    """Per (project, tool) the ids that may run, or null where the catalog defaults decide."""
    listed = enabled.groupBy("project", "tool").agg(F.collect_set("id").alias("_ids"))
    joined = modes.select("project", "tool", "mode").distinct().join(listed, ["project", "tool"], "left")
    ids: Column = F.when(F.col("mode") == "patterns", F.coalesce("_ids", F.array().cast("array<string>")))
    return joined.select("project", "tool", ids.alias("pattern_ids"))
