"""Analysis, merging and the gate: registered queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lintlake.functions import text as tx
from lintlake.functions.scale import stage
from lintlake.operators import analysers, gate, merge
from lintlake.plans.fixtures import METRIC_RULES, Fixtures
from lintlake.plans.path_queries import detected, kept
from lintlake.plans.pipeline import Analysis
from lintlake.plans.registry import ctes, query

_DIGIT = "cast(right({0}.project, 1) as int)"
_SPLIT = r"string_split_regex({0}, '\r\n|\r|\n')"


def sql_lines(column: str) -> str:
    split = _SPLIT.format(column)
    return f"(case when {split}[-1] = '' then {split}[:-2] else {split} end)"


def sql_trim(column: str) -> str:
    return rf"regexp_replace({column}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


# The fixture's patterns as constants: the oracle's engine compiles a pattern held in a column for every row.
RULES_SQL = """case {id} when 'phone' then regexp_matches({line}, '[0-9]{{3}}-[0-9]{{4}}')
    when 'handle' then regexp_matches({line}, '@[a-z]+') when 'license' then regexp_matches({line}, '(?i)license')
    when 'secret' then regexp_matches({line}, 'key|secret|token') when 'commas' then regexp_matches({line}, ',.*,.*,')
    when 'digit' then regexp_matches({line}, '[0-9]') when 'long' then length({line}) >= 400 end"""


def sql_loc(column: str) -> str:
    return f"len(list_filter({_SPLIT.format(column)}, lambda x: length({sql_trim('x')}) >= 3))"


def _sql_metrics() -> str:
    """Metrics of ``detected`` files, with the fixture's regexes."""

    def per_language(pattern: str) -> str:
        arms = " ".join(
            f"when '{name}' then {pattern.format(c=r.comment, m=r.method, t=r.type_, b=r.branch)}"
            for name, r in sorted(METRIC_RULES.items())
        )
        return f"case language {arms} end"

    matching = "len(list_filter(lines, lambda x: regexp_matches(x, '{%s}')))"
    branches = "len(regexp_extract_all({0}, '{{b}}'))"
    opened = (
        "array_to_string(list_transform(list_filter(list_zip(lines, range(1, len(lines) + 1)), lambda x: regexp_matches(x[1], '{m}')), "
        "lambda x: x[2] || '=' || (" + branches.format("x[1]") + " + 1)), ',')"
    )
    return f"""
        select project, language, filename, cast({per_language(branches.format('text') + ' + 1')} as int) as complexity,
               cast({sql_loc('text')} as int) as loc, cast({per_language(matching % 'c')} as int) as cloc,
               cast({per_language(matching % 'm')} as int) as nr_methods, cast({per_language(matching % 't')} as int) as nr_classes,
               coalesce({per_language(opened)}, '') as line_complexities
        from (select *, {sql_lines('text')} as lines from detected)"""


def sql_clones(source: str, prefix: str) -> dict[str, str]:
    """Clone detection over ``source (project, language, filename, text)``, as named results."""
    key = "project, language"
    return {
        f"{prefix}_arrays": f"""
            select {key}, filename, text, list_transform({sql_lines('text')},
                   lambda x: regexp_replace({sql_trim('x')}, '[\\x00-\\x20]+', ' ', 'g')) as norm from {source}""",
        f"{prefix}_norm": f"""
            select {key}, filename, unnest(range(len(norm))) as i, unnest(norm) as line from {prefix}_arrays""",
        f"{prefix}_tokens": f"""
            select *, md5(line) as lh, length(line) - length(replace(line, ' ', '')) + case when line = '' then 0 else 1 end as n
            from {prefix}_norm""",
        f"{prefix}_windows": f"""
            select * from (
                select {key}, filename, i, n, md5(string_agg(lh, '') over w) as h, sum(n) over w as tokens, count(*) over w as size
                from {prefix}_tokens
                window w as (partition by {key}, filename order by i rows between current row and 4 following)) x
            where size = 5 and tokens > 0""",
        f"{prefix}_next": f"""
            select *, case when lead(i) over f = i + 1 then lead(h) over f end as next from {prefix}_windows
            window f as (partition by {key}, filename order by i)""",
        f"{prefix}_stats": f"""
            select {key}, h, count(*) as cnt, case when count(next) = count(*) and min(next) = max(next) then min(next) end as next
            from {prefix}_next group by {key}, h having count(*) >= 2""",
        f"{prefix}_chains": f"""
            select a.project, a.language, a.h, coalesce(b.cnt = a.cnt, false) as chains
            from {prefix}_stats a left join {prefix}_stats b on a.project = b.project and a.language = b.language and a.next = b.h""",
        f"{prefix}_flags": f"""
            select w.*, c.chains, case when lag(w.i) over f = w.i - 1 and lag(c.chains) over f then 0 else 1 end as fresh
            from {prefix}_next w join {prefix}_chains c using (project, language, h)
            window f as (partition by w.project, w.language, w.filename order by w.i)""",
        f"{prefix}_islands": f"""
            select *, sum(fresh) over (partition by {key}, filename order by i rows unbounded preceding) as island from {prefix}_flags""",
        f"{prefix}_occurrences": f"""
            select {key}, md5(arg_min(h, i) || ':' || cast(max(i) + 5 - min(i) as varchar)) as clone_id,
                   cast(max(i) + 5 - min(i) as int) as nr_lines,
                   cast(sum(n) + arg_max(tokens - n, i) as int) as nr_tokens, filename,
                   cast(min(i) + 1 as int) as start_line, cast(max(i) + 5 as int) as end_line
            from {prefix}_islands group by {key}, filename, island""",
    }


ctes(
    failing=f"""
        select r.project, r.kind, r.tool, min(coalesce(f.error,
               case when m.mode = 'error' then 'Could not find conditions to run tool ' || r.tool end)) as error
        from (select distinct project, kind, tool from all_runs) r
        left join modes m on r.kind = 'issues' and m.project = r.project and m.tool = r.tool
        left join (select project, tool, min(error) as error from (
                       select project, tool, 'Could not find conditions to run tool ' || tool as error from modes where mode = 'error'
                       union all select project, tool, error from failures) group by 1, 2) f
               on f.project = r.project and f.tool = r.tool
        group by 1, 2, 3""",
    runs="""
        select r.project, r.kind, r.tool, r.language, f.error is null as success, f.error,
               row_number() over (partition by r.project order by r.kind, r.tool, r.language) as run_order
        from all_runs r join failing f on r.project = f.project and r.kind = f.kind and r.tool = f.tool""",
    run_files=r"""
        select r.project, r.kind, r.tool, r.language, r.run_order, r.success, d.filename, d.doc_id, d.text
        from runs r join detected d on r.project = d.project and r.language = d.language
        where not (r.tool = 'lint-b' and regexp_matches(d.filename, '^src/[^/]*[.]rb$'))
          and not (r.kind = 'metrics' and starts_with(d.filename, 'src/doc_2'))""",
    issue_files="select * from run_files where kind = 'issues' and success",
    allowed="""
        select p.tool, p.id, p.pattern_id, p.level, p.category, p.message, m.project
        from patterns p join modes m on m.tool = p.tool
        where case when m.mode = 'patterns'
                   then exists (select 1 from configured_patterns c where c.project = m.project and c.tool = p.tool and c.id = p.id)
                   else p.enabled end""",
    issue_lines=f"""
        select project, tool, language, filename, unnest(range(1, len(ls) + 1)) as line, unnest(ls) as content
        from (select *, {sql_lines('text')} as ls from issue_files)""",
    issues=f"""
        select distinct l.project, l.tool, l.language, a.pattern_id, l.filename, a.message, a.level, a.category,
               cast(l.line as int) as line
        from issue_lines l join allowed a on a.project = l.project and a.tool = l.tool
        where {RULES_SQL.format(id='a.id', line='l.content')}""",
    all_lines=f"""
        select project, filename, unnest(range(1, len(ls) + 1)) as line, unnest(ls) as content
        from (select *, {sql_lines('text')} as ls from files)""",
    all_issues=f"""
        select l.project, p.tool, 'any' as language, p.pattern_id, l.filename, p.message, p.level, p.category,
               cast(l.line as int) as line
        from all_lines l join patterns p on p.enabled and {RULES_SQL.format(id='p.id', line='l.content')}""",
    file_errors="""
        select project, tool, language, filename, coalesce(case when doc_id % 2 = 1 then 'Cannot parse' end, 'Failed to analyze file.') as message
        from issue_files where tool = 'lint-b' and doc_id % 3 = 0""",
    results="""
        select project, tool, language, 'Issue' as kind, pattern_id, filename, message, level, category, line from issues
        union all select project, tool, language, 'FileError', null, filename, message, null, null, null from file_errors""",
    all_metrics=_sql_metrics(),
    metrics_files="select distinct project, language, filename from run_files where kind = 'metrics'",
    metrics_done="select distinct project, language, filename from run_files where kind = 'metrics' and success",
    metrics_full=f"""
        select f.project, f.language, f.filename, m.complexity, cast({sql_loc('k.text')} as int) as loc, m.cloc, m.nr_methods,
               m.nr_classes, coalesce(m.line_complexities, '') as line_complexities
        from metrics_files f
        left join (select a.* from all_metrics a join metrics_done using (project, language, filename)) m
             using (project, language, filename)
        join kept k on k.project = f.project and k.filename = f.filename""",
    clone_files="select distinct project, language, filename, text from run_files where kind = 'duplication' and success",
    **sql_clones("clone_files", "clone"),
    all_lang_files="select 'all' as project, 'any' as language, project || '/' || filename as filename, text from files",
    **sql_clones("all_lang_files", "wide"),
    gate_input="""
        select l.project, l.max_allowed, l.fail_if_incomplete, coalesce(n.n, 0) as n_issues, coalesce(f.failed, false) as any_failure,
               p.project is not null as no_tools
        from limits l
        left join (select project, count(*) as n from issues group by 1) n on n.project = l.project
        left join (select project, bool_or(not success) as failed from runs group by 1) f on f.project = l.project
        left join (select project from projects where project not in (select project from enabled_config)
                   and project not in (select project from all_runs where kind = 'issues')) p on p.project = l.project""",
    gate="""
        select project, n_issues, any_failure,
               case when no_tools then 100 when fail_if_incomplete and any_failure then 101 when n_issues > max_allowed then 102
                    else 0 end as code
        from gate_input""",
)


def analysis(fx: Fixtures, **changed) -> Analysis:
    given = dict(
        files=fx.files.select("project", "filename", "is_readable", "text"),
        listing=fx.listing,
        rules=fx.exclusion_rules,
        local_config=fx.local_config,
        extensions=fx.custom_extensions,
        tools=fx.tools,
        patterns=fx.rules_table,
        tool_config=fx.tool_config,
        failures=fx.failures,
        metric_rules=METRIC_RULES,
    )
    return Analysis(**{**given, **changed})


def file_errors(fx: Fixtures, a: Analysis) -> DataFrame:
    """Files that lint-b could not analyse, some without a message."""
    files = a.files_of("issues").join(fx.files.select("project", "filename", "doc_id"), ["project", "filename"])
    message = F.when(F.col("doc_id") % 2 == 1, F.lit("Cannot parse"))
    bad = files.filter("tool = 'lint-b' and doc_id % 3 = 0")
    return bad.select("project", "tool", "language", "filename", message.alias("message"))


def results(fx: Fixtures, a: Analysis) -> DataFrame:
    return merge.results_union(a.issues, file_errors(fx, a))


def complexities(column: str = "line_complexities"):
    shown = F.transform(column, lambda c: F.concat_ws("=", c["line"].cast("string"), c["value"].cast("string")))
    return F.array_join(shown, ",").alias(column)


_RUN_FILE = "project, tool, language, filename"
_METRICS = ["project", "language", "filename", "complexity", "loc", "cloc", "nr_methods", "nr_classes"]


# ---------------------------------------------------------------- analysers


@query("filter_tool", "select project, kind, tool, language, filename from run_files")
def filter_tool(fx: Fixtures) -> DataFrame:
    return analysis(fx).run_files.select("project", "kind", "tool", "language", "filename")


@query("count_loc", f"select doc_id, cast({sql_loc('text')} as int) as loc from documents")
def count_loc(fx: Fixtures) -> DataFrame:
    return fx.view("documents").select("doc_id", tx.count_loc(F.col("text")).alias("loc"))


@query(
    "scan_issues", "select project, tool, language, pattern_id, filename, message, level, category, line from issues"
)
def scan_issues(fx: Fixtures) -> DataFrame:
    return analysis(fx).issues.drop("column", "fingerprint")


def all_issues(fx: Fixtures, fingerprints: bool = False) -> DataFrame:
    """Every enabled rule on every file, without planning."""
    names = F.explode(F.array(F.lit("lint-a"), F.lit("lint-b"))).alias("tool")
    files = fx.files.select("project", names, F.lit("any").alias("language"), "filename", "text")
    return analysers.scan_issues(files, analysers.rules_of(fx.rules_table), fingerprints)


@query(
    "scan_all_lines", "select project, tool, language, pattern_id, filename, message, level, category, line from all_issues"
)
def scan_all_lines(fx: Fixtures) -> DataFrame:
    return all_issues(fx).drop("column")


@query("compute_metrics", f"select {', '.join(_METRICS)}, line_complexities from all_metrics")
def compute_metrics(fx: Fixtures) -> DataFrame:
    files = detected(fx).select("project", "language", "filename", "text")
    return analysers.compute_metrics(files, METRIC_RULES).select(*_METRICS, complexities())


_CLONE = ["project", "language", "clone_id", "nr_lines", "nr_tokens", "filename", "start_line", "end_line"]


def _wide_files(fx: Fixtures) -> DataFrame:
    """All documents as one project, so that one (project, language) owns every row."""
    name = F.concat_ws("/", "project", "filename")
    return fx.files.select(F.lit("all").alias("project"), F.lit("any").alias("language"), name.alias("filename"), "text")


@query("detect_clones", f"select {', '.join(_CLONE)} from wide_occurrences")
def detect_clones(fx: Fixtures) -> DataFrame:
    return analysers.detect_clones(_wide_files(fx)).select(*_CLONE)


def sql_clone_texts(source: str, prefix: str) -> str:
    """One row per clone of ``sql_clones`` with the text of its first occurrence."""
    return f"""
    select c.project, c.language, c.clone_id, c.nr_lines, c.nr_tokens, c.n as n_occurrences,
           array_to_string({sql_lines('f.text')}[c.start_line:c.start_line + c.nr_lines - 1], chr(10)) as clone_lines
    from (select project, language, clone_id, nr_lines, nr_tokens, cast(count(*) as int) as n, min((filename, start_line)) as first,
                 arg_min(filename, (filename, start_line)) as filename, arg_min(start_line, (filename, start_line)) as start_line
          from {prefix}_occurrences group by 1, 2, 3, 4, 5) c
    join {source} f on f.project = c.project and f.language = c.language and f.filename = c.filename"""


ctes(wide_clones=sql_clone_texts("all_lang_files", "wide"))


@query(
    "clones",
    "select project, language, clone_id, nr_lines, nr_tokens, n_occurrences, clone_lines from wide_clones",
)
def clones(fx: Fixtures) -> DataFrame:
    files = _wide_files(fx)
    return analysers.clones(stage(analysers.detect_clones(files), "occurrences"), files)


@query(
    "project_clones",
    f"""
    with kept_occurrences as (
        select o.*, count(*) over (partition by project, language, clone_id) as n from clone_occurrences o)
    select {', '.join(_CLONE)} from kept_occurrences where n > 1""",
)
def project_clones(fx: Fixtures) -> DataFrame:
    return analysis(fx).clone_occurrences.select(*_CLONE)


@query(
    "custom_analyser",
    """
    with analysed as (
        select project, tool, language, filename, length(text) as n_chars, contains(text, '@') as breaks from issue_files),
    broken as (select distinct project, tool, language from analysed where breaks)
    select project, tool, language, true as success, cast(null as varchar) as error, filename, n_chars from analysed
    where not exists (select 1 from broken b where b.project = analysed.project and b.tool = analysed.tool and b.language = analysed.language)
    union all select project, tool, language, false, 'unexpected @', null, null from broken""",
)
def custom_analyser(fx: Fixtures) -> DataFrame:
    def measure(files: pd.DataFrame) -> pd.DataFrame:
        if files["text"].str.contains("@").any():
            raise ValueError("unexpected @")
        return pd.DataFrame({"filename": files["filename"], "n_chars": files["text"].str.len()})

    files = analysis(fx).files_of("issues").select("project", "tool", "language", "filename", "text")
    return analysers.custom_analyser(files, measure, "filename string, n_chars long")


@query(
    "merging_analyser",
    """
    with opened as (
        select project, tool, language, filename, left(text, 1) as opening, contains(text, '@') as breaks from issue_files),
    broken as (select distinct project, tool, language from opened where breaks)
    select project, tool, language, true as success, cast(null as varchar) as error, opening, min(filename) as first_file, count(*) as n_files
    from opened
    where not exists (select 1 from broken b where b.project = opened.project and b.tool = opened.tool and b.language = opened.language)
    group by project, tool, language, opening having count(*) > 1
    union all select project, tool, language, false, 'unexpected @', null, null, null from broken""",
)
def merging_analyser(fx: Fixtures) -> DataFrame:
    """Files of a run that begin with the same letter."""

    def first_letter(file: pd.DataFrame) -> dict[str, tuple[str, int]]:
        text = file["text"].iat[0]
        if "@" in text:
            raise ValueError("unexpected @")
        return {text[:1]: (file["filename"].iat[0], 1)}

    def both(a: tuple[str, int], b: tuple[str, int]) -> tuple[str, int]:
        return min(a[0], b[0]), a[1] + b[1]

    def alike(letter: str, state: tuple[str, int]) -> pd.DataFrame | None:
        name, n = state
        return pd.DataFrame({"opening": [letter], "first_file": [name], "n_files": [n]}) if n > 1 else None

    files = analysis(fx).files_of("issues").select("project", "tool", "language", "filename", "text")
    return analysers.merging_analyser(files, first_letter, both, alike, "opening string, first_file string, n_files long", fan_in=4)


# ---------------------------------------------------------------- merging


@query(
    "reduce_metrics",
    """
    select project, language, filename, arg_min(complexity, run_order) filter (complexity is not null) as complexity,
           arg_min(loc, run_order) filter (loc is not null) as loc,
           arg_min(nr_methods, run_order) filter (nr_methods is not null) as nr_methods
    from partial_metrics group by 1, 2, 3""",
)
def reduce_metrics(fx: Fixtures) -> DataFrame:
    return merge.reduce_metrics(fx.partial_metrics)


@query("run_files_union", "select distinct project, language, filename from metrics_run_files")
def run_files_union(fx: Fixtures) -> DataFrame:
    return merge.run_files_union(fx.metrics_run_files)


@query(
    "latest_metrics",
    """
    select project, filename, run_order, complexity, loc, nr_methods from (
        select *, row_number() over (partition by project, filename order by run_order desc) as rn from partial_metrics) x
    where rn = 1""",
)
def latest_metrics(fx: Fixtures) -> DataFrame:
    return merge.latest_metrics(fx.partial_metrics).drop("tool", "language")


def _all_files(fx: Fixtures) -> DataFrame:
    return fx.files.select("project", F.lit("Any").alias("language"), "filename")


@query(
    "files_with_metrics",
    """
    select f.project, f.filename, m.run_order, m.complexity, m.loc, m.nr_methods
    from files f left join partial_metrics m on m.project = f.project and m.filename = f.filename""",
)
def files_with_metrics(fx: Fixtures) -> DataFrame:
    joined = merge.files_with_metrics(_all_files(fx), fx.partial_metrics)
    return joined.select("project", "filename", "run_order", "complexity", "loc", "nr_methods")


@query(
    "metrics_in_scope",
    """
    select m.project, m.run_order, m.filename, m.complexity from partial_metrics m
    where exists (select 1 from metrics_run_files f where f.project = m.project and f.run_order = m.run_order and f.filename = m.filename)""",
)
def metrics_in_scope(fx: Fixtures) -> DataFrame:
    scoped = merge.metrics_in_scope(fx.partial_metrics, fx.metrics_run_files)
    return scoped.select("project", "run_order", "filename", "complexity")


@query(
    "fill_missing_loc",
    f"""
    select f.project, f.filename, m.complexity, cast(coalesce(m.loc, {sql_loc('f.text')}) as int) as loc, m.nr_methods
    from files f left join (
        select *, row_number() over (partition by project, filename order by run_order desc) as rn from partial_metrics) m
    on m.rn = 1 and m.project = f.project and m.filename = f.filename""",
)
def fill_missing_loc(fx: Fixtures) -> DataFrame:
    filled = merge.fill_missing_loc(_all_files(fx), merge.latest_metrics(fx.partial_metrics), fx.files)
    return filled.select("project", "filename", "complexity", "loc", "nr_methods")


@query(
    "recover_failed_metrics",
    """
    with sets as (
        select r.project, r.language, r.run_order, r.success,
               coalesce(string_agg(distinct f.filename, '|' order by f.filename), '') as names
        from metrics_runs r left join metrics_run_files f
        on f.project = r.project and f.language = r.language and f.run_order = r.run_order
        group by 1, 2, 3, 4)
    select project, language, run_order, success, error, false as recovered from metrics_runs
    union all
    select project, language, run_order, true, null, true from sets a where not success and not exists (
        select 1 from sets b where b.success and b.project = a.project and b.language = a.language and b.names = a.names)""",
)
def recover_failed_metrics(fx: Fixtures) -> DataFrame:
    return merge.recover_failed_metrics(fx.metrics_runs, fx.metrics_run_files)


@query("merged_metrics", f"select {', '.join(_METRICS)}, line_complexities from metrics_full")
def merged_metrics(fx: Fixtures) -> DataFrame:
    """Metrics of the whole pipeline: computed, reduced, completed."""
    return analysis(fx).metrics.select(*_METRICS, complexities())


# Metrics tools that fail in more projects, one of which reports two metrics only.
_REPORTED = {"metrics-2": ["complexity", "cloc"]}

ctes(
    partial_runs="""
        select r.project, r.tool, r.language, r.run_order, f.error is null as success, f.error from runs r
        left join (select project, tool, min(error) as error from metric_failures group by 1, 2) f
        on f.project = r.project and f.tool = r.tool where r.kind = 'metrics'""",
    partial_sets="""
        select r.project, r.language, r.success, case when r.success then 0 else r.run_order end as part,
               coalesce(string_agg(distinct f.filename, '|' order by f.filename), '') as names, count(distinct f.filename) as n_files
        from partial_runs r left join run_files f on f.kind = 'metrics' and f.project = r.project and f.run_order = r.run_order
        group by all""",
)


def partial_analysis(fx: Fixtures) -> Analysis:
    return analysis(fx, failures=fx.metric_failures, reported_metrics=_REPORTED)


@query(
    "metrics_run_results",
    """
    select p.project, p.language, p.run_order, p.success, p.error, false as recovered, s.n_files
    from (select project, language, min(run_order) as run_order, true as success, null as error, 0 as part
          from partial_runs where success group by 1, 2
          union all select project, language, run_order, false, error, run_order from partial_runs where not success) p
    join partial_sets s on s.project = p.project and s.language = p.language and s.part = p.part
    union all
    select r.project, r.language, r.run_order, true, null, true, a.n_files from partial_runs r
    join partial_sets a on a.project = r.project and a.language = r.language and a.part = r.run_order
    where not r.success and not exists (
        select 1 from partial_sets b where b.success and b.project = a.project and b.language = a.language and b.names = a.names)""",
)
def metrics_run_results(fx: Fixtures) -> DataFrame:
    """Every metrics run whose results count: merged, failed or recovered, with its number of files."""
    a = partial_analysis(fx)
    files = merge.merged_run_files(a.runs.filter("kind = 'metrics'"), a.metrics_run_files)
    sizes = files.groupBy("project", "language", "run_order").agg(F.count("*").alias("n_files"))
    joined = a.metrics_runs.join(sizes, ["project", "language", "run_order"], "left")
    return joined.withColumn("n_files", F.coalesce("n_files", F.lit(0)))


@query(
    "partial_metrics_merged",
    f"""
    with able as (
        select project, language, bool_or(success and tool = 'metrics-1') as full_report,
               bool_or(success and tool = 'metrics-2') as short_report
        from partial_runs group by 1, 2)
    select f.project, f.language, f.filename, case when a.full_report or a.short_report then m.complexity end as complexity,
           cast({sql_loc('k.text')} as int) as loc, case when a.full_report or a.short_report then m.cloc end as cloc,
           case when a.full_report then m.nr_methods end as nr_methods, case when a.full_report then m.nr_classes end as nr_classes,
           case when a.full_report then m.line_complexities else '' end as line_complexities
    from metrics_files f join able a on a.project = f.project and a.language = f.language
    join all_metrics m on m.project = f.project and m.language = f.language and m.filename = f.filename
    join kept k on k.project = f.project and k.filename = f.filename""",
)
def partial_metrics_merged(fx: Fixtures) -> DataFrame:
    """Runs that report different metrics merged per file, in the whole pipeline."""
    return partial_analysis(fx).metrics.select(*_METRICS, complexities())


@query(
    "clones_min_lines",
    "select project, clone_id, filename, nr_lines from reported_clones where nr_lines >= 5",
)
def clones_min_lines(fx: Fixtures) -> DataFrame:
    return merge.clones_min_lines(fx.reported_clones).select("project", "clone_id", "filename", "nr_lines")


@query(
    "filter_clones",
    """
    with in_scope as (
        select c.*, count(*) over (partition by c.project, c.clone_id) as n
        from reported_clones c join kept k on k.project = c.project and k.filename = c.filename where c.nr_lines >= 5)
    select distinct project, clone_id, nr_lines, nr_tokens, filename, start_line, end_line from in_scope where n > 1""",
)
def filter_clones(fx: Fixtures) -> DataFrame:
    return merge.filter_clones(fx.reported_clones, kept(fx))


# ---------------------------------------------------------------- result sets

_RESULT = "project, tool, language, kind, pattern_id, filename, message, level, category, line"


@query("results_union", f"select {_RESULT} from results")
def results_union(fx: Fixtures) -> DataFrame:
    return results(fx, analysis(fx)).drop("column")


@query(
    "dedupe_results",
    """
    select distinct l_partkey as part, l_suppkey as supplier, l_returnflag as level, l_linestatus as category from lineitem""",
)
def dedupe_results(fx: Fixtures) -> DataFrame:
    rows = fx.view("lineitem").select(
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"),
        F.col("l_returnflag").alias("level"), F.col("l_linestatus").alias("category"),
    )
    return merge.dedupe_results(rows)


@query("error_message", "select project, tool, language, filename, message from file_errors")
def error_message(fx: Fixtures) -> DataFrame:
    errors = file_errors(fx, analysis(fx))
    return errors.withColumn("message", tx.error_message(F.col("message")))


@query(
    "partition_results",
    """
    select kind, project, language, filename, line from (
        select 'issues' as kind, project, language, filename, line from issues
        union all select 'duplication', project, language, filename, start_line from (
            select o.*, count(*) over (partition by project, language, clone_id) as n from clone_occurrences o) x where n > 1
        union all select 'metrics', project, language, filename, loc from metrics_full) y""",
)
def partition_results(fx: Fixtures) -> DataFrame:
    """A mixed table, split by kind and put together again; rows of other kinds disappear."""
    a = analysis(fx)
    columns = ["kind", "project", "language", "filename", "line"]
    mixed = (
        a.issues.withColumn("kind", F.lit("issues")).select(*columns)
        .unionByName(a.metrics.withColumn("kind", F.lit("metrics")).withColumn("line", F.col("loc")).select(*columns))
        .unionByName(a.clone_occurrences.withColumn("kind", F.lit("duplication")).withColumn("line", F.col("start_line")).select(*columns))
        .unionByName(fx.files.select(F.lit("other").alias("kind"), "project", F.lit("").alias("language"), "filename", F.lit(0).alias("line")))
    )
    return merge.recombine_results(*merge.partition_results(mixed))


@query(
    "group_results_by_file",
    f"""
    select f.project, f.tool, f.language, f.filename, r.kind, r.pattern_id, r.message, r.line
    from (select {_RUN_FILE} from issue_files) f left join results r using ({_RUN_FILE})""",
)
def group_results_by_file(fx: Fixtures) -> DataFrame:
    a = analysis(fx)
    grouped = merge.group_results_by_file(a.files_of("issues").drop("text"), results(fx, a))
    return grouped.drop("level", "category", "column")


# ---------------------------------------------------------------- gate


@query(
    "issue_count",
    """
    select p.project, count(r.project) as n_issues from projects p left join results r on r.project = p.project group by 1""",
)
def issue_count(fx: Fixtures) -> DataFrame:
    a = analysis(fx)
    return gate.issue_count(a.projects, a.runs, results(fx, a))


@query("any_failure", "select project, bool_or(not success) as any_failure from runs group by 1")
def any_failure(fx: Fixtures) -> DataFrame:
    return gate.any_failure(analysis(fx).runs)


@query("quality_gate", "select * from gate")
def quality_gate(fx: Fixtures) -> DataFrame:
    return analysis(fx).quality_gate(fx.limits)


@query(
    "status_code",
    """
    select project, min(case error_kind when 'CommitUuidsDoNotMatch' then 12 when 'UncommittedChanges' then 11
                   when 'NonExistingTool' then 13 when 'StandaloneTool' then 13 when 'UploadError' then 10
                   when 'MissingUploadRequisites' then 10 when 'InvalidConfiguration' then 14 when 'FilesAccessError' then 100 end) as code
    from error_rows group by project""",
)
def status_code(fx: Fixtures) -> DataFrame:
    return fx.error_rows.groupBy("project").agg(F.min(gate.status_code(F.col("error_kind"))).alias("code"))


@query(
    "run_summary",
    """
    select r.project, r.kind, r.tool, r.language, r.success, r.error,
           case when r.success then coalesce(n.n, 0) end as n_results
    from runs r left join (
        select 'issues' as kind, project, tool, language, count(*) as n from results group by all
    ) n on n.kind = r.kind and n.project = r.project and n.tool = r.tool and n.language = r.language""",
)
def run_summary(fx: Fixtures) -> DataFrame:
    a = analysis(fx)
    found = results(fx, a).withColumn("kind", F.lit("issues"))
    return gate.run_summary(a.runs, found).drop("run_order")


@query(
    "collect_errors",
    """
    select project, bool_and(success) as success, string_agg(error, chr(10) order by run_order) as error,
           case when not bool_and(success) then 'Upload failed' end as fixed_error
    from runs group by 1""",
)
def collect_errors(fx: Fixtures) -> DataFrame:
    runs = analysis(fx).runs
    folded = gate.collect_errors(runs)
    fixed = gate.collect_errors(runs, "Upload failed").select("project", F.col("error").alias("fixed_error"))
    return folded.join(fixed, "project")


@query(
    "analyse_projects",
    """
    select g.project, g.n_issues, g.any_failure, g.code, coalesce(m.n, 0) as n_metrics, coalesce(m.loc, 0) as loc,
           coalesce(m.complexity, 0) as complexity, coalesce(c.n, 0) as n_clone_occurrences, coalesce(c.clones, 0) as n_clones,
           coalesce(r.n, 0) as n_metrics_runs, coalesce(r.recovered, 0) as n_recovered_runs
    from gate g
    left join (select project, count(*) as n, count(*) filter (not success and not any_success) as recovered
               from (select *, bool_or(success) over (partition by project, language) as any_success from runs where kind = 'metrics')
               group by 1) r on r.project = g.project
    left join (select project, count(*) as n, cast(sum(loc) as bigint) as loc, cast(sum(complexity) as bigint) as complexity
               from metrics_full group by 1) m on m.project = g.project
    left join (select project, count(*) as n, count(distinct language || clone_id) as clones from (
                   select o.*, count(*) over (partition by project, language, clone_id) as size from clone_occurrences o) x
               where size > 1 group by 1) c on c.project = g.project""",
)
def analyse_projects(fx: Fixtures) -> DataFrame:
    return analysis(fx).overview(fx.limits)


