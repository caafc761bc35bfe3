"""Catalogs and planning: registered queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lintlake.functions import languages as lang, text
from lintlake.functions.scale import scratch_path, stage
from lintlake.operators import catalog, paths, planning
from lintlake.plans.fixtures import Fixtures
from lintlake.plans.path_queries import project_languages
from lintlake.plans.registry import ctes, query
from lintlake.sources import catalog_store

_DIGIT = "cast(right(project, 1) as int)"
_KNOWN = "('Python', 'Ruby', 'Javascript', 'CSS', 'Java', 'Scala', 'Kotlin')"


def _known_csv(column: str) -> str:
    return f"coalesce(array_to_string(list_sort(list_filter(string_split({column}, ','), lambda x: x in {_KNOWN})), ','), '')"


ctes(
    norm_tools=f"""
        select uuid, position, name, short_name, version, coalesce(prefix, '') as prefix, {_known_csv('languages_csv')} as languages,
               config_csv <> '' as has_config_file, standalone
        from raw_tools_csv""",
    norm_patterns=f"""
        select p.uuid, case when t.prefix <> '' and starts_with(p.id, t.prefix) then substr(p.id, length(t.prefix) + 1) else p.id end as id,
               coalesce(p.title, p.id) as title, p.description, p.level, p.category, p.sub_category, p.enabled, p.time_to_fix,
               {_known_csv('p.languages_csv')} as languages, p.max_default
        from raw_patterns_csv p join norm_tools t on p.uuid = t.uuid""",
    tool_languages="""
        select tool_uuid, kind, tool, standalone, unnest(string_split(languages_csv, ',')) as language from tools_csv""",
    issue_offer="select * from tool_languages where kind = 'issues' and not standalone",
    language_runs="""
        select l.project, o.kind, o.tool, o.tool_uuid, l.language from project_languages l join issue_offer o on l.language = o.language""",
    metrics_runs_planned="""
        select l.project, o.kind, o.tool, o.tool_uuid, l.language from project_languages l join tool_languages o
        on l.language = o.language where o.kind = 'metrics'""",
    duplication_runs_planned="""
        select l.project, o.kind, o.tool, o.tool_uuid, l.language from project_languages l join tool_languages o
        on l.language = o.language where o.kind = 'duplication'""",
    enabled_config="select distinct project, tool_uuid from tool_config_csv where enabled",
    configured_runs="""
        select r.* from language_runs r join enabled_config e on r.project = e.project and r.tool_uuid = e.tool_uuid""",
    issue_runs="""
        select * from configured_runs
        union all select * from language_runs where project not in (select project from enabled_config)""",
    all_runs="""
        select * from issue_runs union all select * from metrics_runs_planned union all select * from duplication_runs_planned""",
    config_found="""
        select distinct project, 'lint-b' as tool from listing where is_readable and regexp_matches(filename, '(^|/)lint[.]yml$')""",
    tool_pairs="select distinct project, tool, tool_uuid from issue_runs",
    modes="""
        select p.project, p.tool, p.tool_uuid, f.tool is not null as has_config_files,
               case when c.project is null then 'defaults' when c.not_edited and f.tool is not null then 'file'
                    when c.pattern_csv <> '' then 'patterns' else 'error' end as mode
        from tool_pairs p left join config_found f on p.project = f.project and p.tool = f.tool
        left join tool_config_csv c on c.project = p.project and lower(c.tool_uuid) = lower(p.tool_uuid)""",
    modes_by_language="""
        select p.project, p.tool, f.tool is not null as has_config_files,
               case when c.project is null then 'defaults' when c.not_edited and f.tool is not null then 'file'
                    when c.pattern_csv <> '' then 'patterns' else 'error' end as mode
        from (select distinct project, tool, tool_uuid from language_runs) p
        left join config_found f on p.project = f.project and p.tool = f.tool
        left join tool_config_csv c on c.project = p.project and lower(c.tool_uuid) = lower(p.tool_uuid)""",
    configured_ids="""
        select project, lower(tool_uuid) as tool_uuid,
               unnest(list_filter(string_split(pattern_csv, ','), lambda x: x <> '')) as id from tool_config_csv""",
    configured_patterns="""
        select c.project, p.tool, p.id, case when c.id = 'A_phone' then 'max=3' else '' end as parameters
        from configured_ids c join patterns p on p.tool_uuid = c.tool_uuid
        and case when p.tool = 'lint-a' and starts_with(c.id, 'A_') then substr(c.id, 3) else c.id end = p.id""",
)


def csv(column: str):
    return F.coalesce(F.array_join(F.array_sort(column), ","), F.lit("")).alias(column)


# ---------------------------------------------------------------- catalogs


@query(
    "catalog_fallback",
    """
    select uuid, position, name, short_name, version from fetched_tools
    union all select uuid, position, name, short_name, version from saved_tools
    where uuid not in (select uuid from fetched_tools)""",
)
def catalog_fallback(fx: Fixtures) -> DataFrame:
    return catalog.tools_with_fallback(fx.fetched_tools, fx.saved_tools)


@query(
    "catalog_fallback_patterns",
    """
    select uuid, version, id, origin from saved_patterns
    union all select f.uuid, f.version, f.id, f.origin from fetched_patterns f
    where not exists (select 1 from saved_patterns s where s.uuid = f.uuid and s.version = f.version)""",
)
def catalog_fallback_patterns(fx: Fixtures) -> DataFrame:
    return catalog.patterns_with_fallback(fx.fetched_patterns, fx.saved_patterns)


def _tools(fx: Fixtures) -> DataFrame:
    return catalog.normalize_tools(fx.raw_tools)


def _patterns(fx: Fixtures) -> DataFrame:
    return catalog.normalize_patterns(fx.raw_patterns, _tools(fx))


@query("normalize_tools", "select * from norm_tools")
def normalize_tools(fx: Fixtures) -> DataFrame:
    return _tools(fx).select(
        "uuid", "position", "name", "short_name", "version", "prefix", csv("languages"), "has_config_file", "standalone"
    )


_PATTERN_COLUMNS = ["uuid", "id", "title", "description", "level", "category", "sub_category", "enabled", "time_to_fix"]


@query("normalize_patterns", f"select {', '.join(_PATTERN_COLUMNS)}, languages from norm_patterns")
def normalize_patterns(fx: Fixtures) -> DataFrame:
    return _patterns(fx).select(*_PATTERN_COLUMNS, csv("languages"))


@query("save_catalog", f"select {', '.join(_PATTERN_COLUMNS)}, languages from norm_patterns")
def save_catalog(fx: Fixtures) -> DataFrame:
    """Save twice, the second time what was read back and the rest, and read that."""
    patterns = _patterns(fx)
    path = scratch_path(fx.spark, "catalog")
    catalog_store.save_catalog(patterns.filter("enabled"), path)
    stored = catalog_store.read_catalog(fx.spark, path, patterns.schema)
    catalog_store.save_catalog(stored.unionByName(patterns.filter("not enabled")), path)
    return catalog_store.read_catalog(fx.spark, path, patterns.schema).select(*_PATTERN_COLUMNS, csv("languages"))


@query("read_catalog", "select uuid, short_name, version, prefix, languages from norm_tools")
def read_catalog(fx: Fixtures) -> DataFrame:
    tools = _tools(fx)
    path = scratch_path(fx.spark, "catalog")
    catalog_store.save_catalog(tools, path)
    stored = catalog_store.read_catalog(fx.spark, path, tools.schema)
    return stored.select("uuid", "short_name", "version", "prefix", csv("languages"))


@query("supported_tools", "select uuid, short_name from raw_tools_csv where not standalone")
def supported_tools(fx: Fixtures) -> DataFrame:
    return catalog.supported_tools(_tools(fx)).select("uuid", "short_name")


@query(
    "find_tool",
    """
    with matched as (
        select r.request_id, r.query, t.uuid, t.standalone,
               row_number() over (partition by r.request_id order by t.position) as rn
        from requests r left join norm_tools t on lower(t.short_name) = lower(r.query) or t.uuid = lower(r.query))
    select request_id, query, case when not standalone then uuid end as uuid,
           case when uuid is null then 'unknown' when standalone then 'standalone' else 'found' end as status
    from matched where rn = 1""",
)
def find_tool(fx: Fixtures) -> DataFrame:
    return catalog.find_tool(fx.requests, _tools(fx))


@query(
    "tool_patterns",
    """
    select t.uuid, t.short_name, t.version, p.id, p.title, p.level, p.enabled
    from norm_tools t left join norm_patterns p on t.uuid = p.uuid""",
)
def tool_patterns(fx: Fixtures) -> DataFrame:
    return catalog.tool_patterns(_tools(fx), _patterns(fx)).select(
        "uuid", "short_name", "version", "id", "title", "level", "enabled"
    )


@query(
    "pattern_specifications",
    """
    select uuid, id, level, category, sub_category, 'max=' || max_default || ',min=0' as parameters, languages, enabled
    from norm_patterns""",
)
def pattern_specifications(fx: Fixtures) -> DataFrame:
    shown = F.array_join(F.transform("parameters", lambda p: F.concat(p["name"], F.lit("="), p["default"])), ",")
    specs = catalog.pattern_specifications(_patterns(fx))
    return specs.withColumn("parameters", shown).withColumn("languages", csv("languages"))


@query(
    "pattern_descriptions",
    "select uuid, id, title, description, time_to_fix, 'max=Upper limit' as parameters from norm_patterns",
)
def pattern_descriptions(fx: Fixtures) -> DataFrame:
    shown = F.array_join(F.transform("parameters", lambda p: F.concat(p["name"], F.lit("="), p["description"])), ",")
    described = catalog.pattern_descriptions(_patterns(fx)).withColumn("parameters", shown)
    return described.drop("explanation")


@query(
    "parameter_map",
    """
    select uuid, id, 'max' as name, max_default as value from norm_patterns
    union all select uuid, id, 'min', '0' from norm_patterns""",
)
def parameter_map(fx: Fixtures) -> DataFrame:
    mapped = catalog.parameter_map(F.col("parameters"))
    return _patterns(fx).select("uuid", "id", F.explode(mapped).alias("name", "value"))


@query(
    "check_vocabulary",
    """
    select uuid, id, 'level' as field, level as value from norm_patterns where level not in ('Info', 'Warning', 'High', 'Error')
    union all select uuid, id, 'category', category from norm_patterns where category not in ('Security', 'CodeStyle')
    union all select uuid, id, 'sub_category', sub_category from norm_patterns where sub_category <> 'XSS'""",
)
def check_vocabulary(fx: Fixtures) -> DataFrame:
    return catalog.check_vocabulary(_patterns(fx))


@query("known_languages", f"select uuid, {_known_csv('languages_csv')} as languages from raw_tools_csv")
def known_languages(fx: Fixtures) -> DataFrame:
    return fx.raw_tools.select("uuid", lang.known_languages(F.col("languages")).alias("languages")).select("uuid", csv("languages"))


@query(
    "strip_prefix",
    """
    select p.uuid, p.id, case when t.prefix is not null and starts_with(p.id, t.prefix)
                              then substr(p.id, length(t.prefix) + 1) else p.id end as bare_id,
           'src/' || p.id as filename, p.id as inner_name
    from raw_patterns_csv p join raw_tools_csv t on p.uuid = t.uuid""",
)
def strip_prefix(fx: Fixtures) -> DataFrame:
    prefixes = fx.raw_tools.select("uuid", "prefix")
    sub = F.lit("src")
    return fx.raw_patterns.join(prefixes, "uuid").select(
        "uuid", "id", text.strip_prefix(F.col("id"), F.col("prefix")).alias("bare_id"),
        text.append_sub_directory(sub, F.col("id")).alias("filename"),
        text.remove_sub_directory(sub, F.concat(F.lit("src/"), "id")).alias("inner_name"),
    )


@query(
    "tool_label",
    """
    select uuid, upper(substr(name, 1, 1)) || substr(name, 2) || ' (checked)' as label,
           coalesce(regexp_replace(case when position % 7 > 0 then version end, '^v', ''), '0.0.0-unknown') as version
    from raw_tools_csv""",
)
def tool_label(fx: Fixtures) -> DataFrame:
    version = F.when(F.col("position") % 7 > 0, F.col("version"))
    return fx.raw_tools.select(
        "uuid", text.tool_label(F.col("name"), " (checked)").alias("label"), text.tool_version(version).alias("version")
    )


# ---------------------------------------------------------------- planning

_RUN = "project, kind, tool, tool_uuid, language"


@query("enabled_tools", "select project, tool_uuid from tool_config_csv where enabled")
def enabled_tools(fx: Fixtures) -> DataFrame:
    return planning.enabled_tools(fx.tool_config).select("project", "tool_uuid")


def _languages(fx: Fixtures) -> DataFrame:
    return project_languages(fx)


@query(
    "plan_issue_tools",
    f"""
    select {_RUN}, cast(null as varchar) as error from language_runs
    union all select project, null, null, null, null, 'No tools found for files provided' from projects
    where project not in (select project from language_runs)""",
)
def plan_issue_tools(fx: Fixtures) -> DataFrame:
    runs = planning.plan_issue_tools(fx.tools, _languages(fx))
    errors = planning.plan_errors(fx.projects, runs)
    return runs.withColumn("error", F.lit(None).cast("string")).unionByName(errors, allowMissingColumns=True)


@query("plan_metrics_tools", f"select {_RUN} from metrics_runs_planned")
def plan_metrics_tools(fx: Fixtures) -> DataFrame:
    return planning.plan_metrics_tools(fx.tools, _languages(fx))


@query("plan_duplication_tools", f"select {_RUN} from duplication_runs_planned")
def plan_duplication_tools(fx: Fixtures) -> DataFrame:
    return planning.plan_duplication_tools(fx.tools, _languages(fx))


@query(
    "languages_without_tools",
    """
    select 'duplication' as kind, project, language from project_languages where language not in ('Javascript', 'Python', 'Ruby')
    union all select 'metrics', project, language from project_languages
    where language not in ('Javascript', 'Python', 'Ruby', 'CSS')""",
)
def languages_without_tools(fx: Fixtures) -> DataFrame:
    spoken = stage(_languages(fx), "project-languages")
    kinds = [
        planning.languages_without_tools(spoken, fx.tools, kind).withColumn("kind", F.lit(kind))
        for kind in ("duplication", "metrics")
    ]
    return reduce(DataFrame.unionByName, kinds)


@query("select_configured_tools", f"select {_RUN} from configured_runs")
def select_configured_tools(fx: Fixtures) -> DataFrame:
    return planning.select_configured_tools(fx.tool_config, fx.tools, _languages(fx))


@query(
    "no_active_tool",
    """
    select project, 'No active tool found on the remote configuration' as error from projects
    where project not in (select project from enabled_config)""",
)
def no_active_tool(fx: Fixtures) -> DataFrame:
    return planning.projects_without_active_tool(fx.projects, fx.tool_config)


@query(
    "unknown_configured_tools",
    "select project, tool_uuid from enabled_config where tool_uuid not in ('uuid-lint-a', 'uuid-lint-b')",
)
def unknown_configured_tools(fx: Fixtures) -> DataFrame:
    return planning.unknown_configured_tools(fx.tool_config, fx.tools)


@query("tools_config_fallback", f"select {_RUN} from issue_runs")
def tools_config_fallback(fx: Fixtures) -> DataFrame:
    return planning.plan_with_fallback(fx.tool_config, fx.tools, stage(_languages(fx), "project-languages"))


def all_runs(fx: Fixtures) -> DataFrame:
    spoken = stage(_languages(fx), "project-languages")
    return planning.union_tool_runs(
        planning.plan_with_fallback(fx.tool_config, fx.tools, spoken),
        planning.plan_metrics_tools(fx.tools, spoken),
        planning.plan_duplication_tools(fx.tools, spoken),
    )


@query("union_tool_runs", f"select {_RUN} from all_runs")
def union_tool_runs(fx: Fixtures) -> DataFrame:
    return all_runs(fx)


@query(
    "kind_selection",
    f"""
    select 'all' as selection, {_RUN} from all_runs
    union all select kind, {_RUN} from all_runs
    union all select 'LINT-B', {_RUN} from language_runs where tool = 'lint-b'""",
)
def kind_selection(fx: Fixtures) -> DataFrame:
    spoken = stage(_languages(fx), "project-languages")
    runs = stage(all_runs(fx), "runs")
    chosen = [
        planning.select_runs(s, runs, fx.tools, spoken).withColumn("selection", F.lit(s or "all"))
        for s in (None, "issues", "metrics", "duplication", "LINT-B")
    ]
    return reduce(DataFrame.unionByName, chosen)


@query(
    "intersect_languages",
    "select project, tool, string_agg(distinct language, ',' order by language) as languages from language_runs group by 1, 2",
)
def intersect_languages(fx: Fixtures) -> DataFrame:
    return planning.intersect_languages(fx.tools, _languages(fx)).select("project", "tool", csv("languages"))


def modes(fx: Fixtures, configured: bool = True) -> DataFrame:
    """Modes of the tools that run (``configured``) or of all tools for the project's languages."""
    if configured:
        runs = planning.plan_with_fallback(fx.tool_config, fx.tools, stage(_languages(fx), "project-languages"))
    else:
        runs = planning.plan_issue_tools(fx.tools, _languages(fx))
    pairs = stage(runs.select("project", "tool", "tool_uuid").distinct(), "tool-pairs")
    found = paths.has_config_files(fx.listing, fx.tools.filter("kind = 'issues'"), pairs)
    return planning.tool_run_mode(pairs.join(found, ["project", "tool"]), fx.tool_config)


@query(
    "tool_run_mode",
    """
    select project, tool, has_config_files, mode,
           case when mode = 'error' then 'Could not find conditions to run tool ' || tool end as error
    from modes_by_language""",
)
def tool_run_mode(fx: Fixtures) -> DataFrame:
    return modes(fx, configured=False).drop("tool_uuid")


@query(
    "engine_extras",
    """
    select p.project, p.tool, e.base_sub_dir, e.extra from tool_pairs p
    left join engine_config e on p.project = e.project and p.tool = e.tool""",
)
def engine_extras(fx: Fixtures) -> DataFrame:
    runs = planning.plan_with_fallback(fx.tool_config, fx.tools, stage(_languages(fx), "project-languages"))
    return planning.engine_extras(runs.select("project", "tool").distinct(), fx.engine_config)


@query(
    "enabled_patterns",
    """
    select c.project, c.tool, c.id, c.parameters, p.level, p.category
    from configured_patterns c join modes_by_language m on c.project = m.project and c.tool = m.tool and m.mode = 'patterns'
    join patterns p on p.tool = c.tool and p.id = c.id""",
)
def enabled_patterns(fx: Fixtures) -> DataFrame:
    found = planning.enabled_patterns(modes(fx, configured=False), fx.tool_config, fx.tools, fx.patterns)
    entries = F.transform(F.map_entries("parameters"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.withColumn("parameters", F.array_join(entries, ","))
