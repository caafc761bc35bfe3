"""Reports and exports: registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lintlake.functions import text as tx
from lintlake.functions.scale import lookup_join, scratch_path, stage
from lintlake.operators import analysers, export, gate, merge, report
from lintlake.plans.analysis_queries import _wide_files, all_issues, sql_clone_texts, sql_clones
from lintlake.plans.fixtures import Fixtures
from lintlake.plans.registry import ctes, query
from lintlake.sources import results as documents

BATCH_SIZE = 20

_RUN = "project, tool, language"
_ISSUE_JSON = """to_json({'Issue': {'patternId': {'value': pattern_id}, 'filename': filename, 'message': {'text': message},
    'level': level, 'category': category, 'location': {'LineLocation': {'line': line}}}})"""
_ERROR_JSON = "to_json({'FileError': {'filename': filename, 'message': message}})"
_METRICS_JSON = """to_json({'FileMetrics': {'filename': filename, 'complexity': complexity, 'loc': loc, 'cloc': null,
    'nrMethods': null, 'nrClasses': null, 'lineComplexities': []}})"""
_CLONE_JSON = "cast(to_json({'cloneLines': clone_lines, 'nrTokens': nr_tokens, 'nrLines': nr_lines}) as varchar)"
_PLACE_JSON = "cast(to_json({'filePath': filename, 'startLine': start_line, 'endLine': end_line}) as varchar)"


def _sql_batches(source: str, prefix: str, size: int) -> dict[str, str]:
    """Greedy batches of the files of ``source``, as named results."""
    return {
        f"{prefix}_order": f"""
        select *, row_number() over (partition by project, tool, language order by least(n_results, {size}) desc, md5(filename)) as rn from {source}""",
        f"recursive_{prefix}": f"""
        select project, tool, language, filename, n_results, rn, n_results as acc, 0 as batch from {prefix}_order where rn = 1
        union all
        select o.project, o.tool, o.language, o.filename, o.n_results, o.rn,
               case when b.acc + o.n_results >= {size} then o.n_results else b.acc + o.n_results end,
               case when b.acc + o.n_results >= {size} then b.batch + 1 else b.batch end
        from recursive_{prefix} b join {prefix}_order o
        on o.project = b.project and o.tool = b.tool and o.language = b.language and o.rn = b.rn + 1""",
    }


ctes(
    good_report_runs="select project, tool, language from report_runs where kind = 'issues' and success",
    report_issues="select i.* from all_issues i join good_report_runs r using (project, tool, language)",
    report_errors="""
        select project, 'lint-b' as tool, 'any' as language, filename, 'Failed to analyze file.' as message
        from files where doc_id % 29 = 0 and cast(right(project, 1) as int) <> 7""",
    report_results="""
        select project, tool, language, 'Issue' as kind, pattern_id, filename, message, level, category, line from report_issues
        union all select project, tool, language, 'FileError', null, filename, message, null, null, null from report_errors""",
    moved_issues="""
        select project, tool, language, pattern_id, filename, message, level, category,
               case when line % 7 = 0 then 0 when line % 5 = 0 then line + 1000000 else line end as line
        from report_issues""",
    catalog_patterns="select tool, pattern_id, category = 'Security' as is_security, title, description, explanation from patterns",
    categorized="""
        select i.*, c.is_security from report_issues i join catalog_patterns c on c.tool = i.tool and c.pattern_id = i.pattern_id""",
    rules="""
        select u.project, u.tool, u.language, u.is_security, u.pattern_id as rule_id, c.title as name,
               coalesce(c.description, c.title) as short_text, c.explanation as help_markdown, u.category,
               cast(row_number() over (partition by u.project, u.tool, u.language order by u.is_security desc, u.pattern_id) - 1 as int) as rule_index
        from (select project, tool, language, is_security, pattern_id, min(category) as category from categorized group by all) u
        join catalog_patterns c on c.tool = u.tool and c.pattern_id = u.pattern_id""",
    artifacts="""
        select project, tool, language, filename,
               cast(row_number() over (partition by project, tool, language order by md5(filename), filename) - 1 as int) as artifact_index
        from (select distinct project, tool, language, filename from report_issues) x""",
    moved_with_text="""
        select m.*, coalesce(l.content, '') as content from moved_issues m
        left join all_lines l on l.project = m.project and l.filename = m.filename and l.line = m.line""",
    report_metrics="""
        select project, filename, case when length(text) % 3 = 0 then null else cast(length(text) % 50 as int) end as complexity,
               case when length(text) % 3 = 0 then null else cast(length(text) as int) end as loc from files""",
    report_run_files="""
        select f.project, t.tool, 'any' as language, f.filename
        from files f cross join (select 'lint-a' as tool union all select 'lint-b') t""",
    file_counts="""
        select f.project, f.tool, f.language, f.filename, count(r.kind) as n_results
        from report_run_files f left join report_results r using (project, tool, language, filename) group by all""",
    **_sql_batches("file_counts", "batches", BATCH_SIZE),
    order_counts="""
        select 'p' || (o_custkey % 40) as project, 'lint-a' as tool, 'any' as language, cast(o_orderkey as varchar) as filename,
               cast(floor(o_totalprice) as bigint) % 60000 as n_results from orders""",
    **_sql_batches("order_counts", "defaults", export.DEFAULT_BATCH_SIZE),
    own_files="select project, 'any' as language, filename, text from files",
    **sql_clones("own_files", "own"),
    own_clones=sql_clone_texts("own_files", "own"),
    result_json=f"""
        select f.project, f.tool, f.language, f.filename, cast(r.item as varchar) as json
        from report_run_files f left join (
            select distinct project, tool, language, filename, case kind when 'Issue' then {_ISSUE_JSON} else {_ERROR_JSON} end as item
            from report_results) r using (project, tool, language, filename)""",
    shown_text="""
        select project, 'Found [' || level || '/' || category || '] `' || message || '` in ' || filename || ':' || line || ' (' || pattern_id || ')' as line
        from report_issues
        union all select project, 'Found ' || message || ' in ' || filename from report_errors
        union all select project, case when complexity is null then 'No [Metrics] found in ' || filename || '.'
            else 'Found [Metrics] in ' || filename || ':' || chr(10) || '  CC - ' || complexity || chr(10) || '  LOC - ' || loc end
        from report_metrics
        union all select project, 'Found [Clone] ' || nr_lines || ' duplicated lines with ' || nr_tokens || ' tokens:'
            from (select distinct project, clone_id, nr_lines, nr_tokens from own_occurrences) c
        union all select project, '  ' || filename || chr(10) || string_agg('    l. ' || start_line || ' - ' || end_line, chr(10) order by start_line)
            from own_occurrences group by project, clone_id, filename""",
    shown_json=f"""
        select project, 1 as s1, filename || chr(1) || lpad(cast(line as varchar), 10, '0') as s2, 0 as s3,
               cast({_ISSUE_JSON} as varchar) as s4, cast({_ISSUE_JSON} as varchar) as shown from report_issues
        union all select project, 1, filename || chr(1) || '0000000000', 0, cast({_ERROR_JSON} as varchar), cast({_ERROR_JSON} as varchar)
            from report_errors
        union all select project, 2, filename, 0, '', cast({_METRICS_JSON} as varchar) from report_metrics
        union all select project, 3, clone_id, 0, '',
               '{{"DuplicationClone":' || left({_CLONE_JSON}, length({_CLONE_JSON}) - 1) || ',"files":[' from own_clones
        union all select project, 3, clone_id, 1, spot,
               case when spot = min(spot) over (partition by project, clone_id) then '' else ',' end || {_PLACE_JSON}
            from (select *, filename || chr(1) || lpad(cast(start_line as varchar), 10, '0') as spot from own_occurrences) x
        union all select project, 3, clone_id, 2, '', ']}}}}' from own_clones""",
)


# ---------------------------------------------------------------- inputs


def issues(fx: Fixtures) -> DataFrame:
    """Issues of all files without those of failed runs."""
    return gate.drop_failed_runs(all_issues(fx), fx.report_runs)


def results(fx: Fixtures) -> DataFrame:
    bad = fx.files.filter("doc_id % 29 = 0 and cast(right(project, 1) as int) <> 7")
    errors = bad.select(
        "project", F.lit("lint-b").alias("tool"), F.lit("any").alias("language"), "filename",
        F.lit(None).cast("string").alias("message"),
    )
    return merge.results_union(issues(fx), errors)


def moved_issues(fx: Fixtures) -> DataFrame:
    """Issues of which some point to line 0 or behind the end of the file."""
    line = F.when(F.col("line") % 7 == 0, 0).when(F.col("line") % 5 == 0, F.col("line") + 1000000).otherwise(F.col("line"))
    return issues(fx).withColumn("line", line)


def metrics(fx: Fixtures) -> DataFrame:
    size = F.length("text").cast("int")
    known = size % 3 != 0
    nothing = F.lit(None).cast("int")
    return fx.files.select(
        "project", "filename", F.when(known, size % 50).alias("complexity"), F.when(known, size).alias("loc"),
        nothing.alias("cloc"), nothing.alias("nr_methods"), nothing.alias("nr_classes"),
        F.array().cast("array<struct<line:int,value:int>>").alias("line_complexities"),
    )


def run_files(fx: Fixtures) -> DataFrame:
    names = F.explode(F.array(F.lit("lint-a"), F.lit("lint-b"))).alias("tool")
    return fx.files.select("project", names, F.lit("any").alias("language"), "filename")


def issue_tools(fx: Fixtures) -> DataFrame:
    return fx.tools.filter("kind = 'issues' and not standalone")


def categorized(fx: Fixtures) -> DataFrame:
    return report.split_security(issues(fx), issue_tools(fx), fx.patterns)


def occurrences(fx: Fixtures) -> DataFrame:
    return stage(analysers.detect_clones(_wide_files(fx)), "occurrences")


def own_files(fx: Fixtures) -> DataFrame:
    """Every project by itself."""
    return fx.files.select("project", F.lit("any").alias("language"), "filename", "text")


def own_occurrences(fx: Fixtures) -> DataFrame:
    return stage(analysers.detect_clones(own_files(fx)), "occurrences")


def json_records(fx: Fixtures, shown: DataFrame | None = None) -> DataFrame:
    places = own_occurrences(fx)
    found = stage(analysers.clones(places, own_files(fx)), "clones")
    lines = report.render_json(results(fx) if shown is None else shown, metrics(fx))
    return lines.unionByName(report.clone_json_lines(found, places))


def clone_objects(fx: Fixtures) -> DataFrame:
    """Clones as one JSON object per clone and file: any number of files can share a clone."""
    places = own_occurrences(fx)
    entry = F.struct(F.col("filename").alias("filePath"), F.col("start_line").alias("startLine"), F.col("end_line").alias("endLine"))
    by_file = places.groupBy("project", "clone_id", "filename").agg(F.collect_list(entry).alias("files"))
    found = analysers.clones(places, own_files(fx))
    shown = lookup_join(by_file, found, ["project", "clone_id"], spread=["filename"])
    clone = F.struct(
        F.col("clone_lines").alias("cloneLines"), F.col("nr_tokens").alias("nrTokens"), F.col("nr_lines").alias("nrLines"), "files"
    )
    return shown.select(F.to_json(F.struct(clone.alias("DuplicationClone"))).alias("line"))


# ---------------------------------------------------------------- expressions


@query(
    "fingerprint",
    r"""
    select doc_id, coalesce(nullif(ltrim(md5(source || lang || regexp_replace(text, '[\s\x0B]', '', 'g')), '0'), ''), '0') as fingerprint
    from documents""",
)
def fingerprint(fx: Fixtures) -> DataFrame:
    hashed = tx.fingerprint(F.col("source"), F.col("lang"), F.col("text"))
    return fx.view("documents").select("doc_id", hashed.alias("fingerprint"))


@query(
    "sarif_line",
    "select l_orderkey, l_linenumber, greatest(l_linenumber - 3, 1) as start_line from lineitem",
)
def sarif_line(fx: Fixtures) -> DataFrame:
    line = report.sarif_line(F.col("l_linenumber") - 3)
    return fx.view("lineitem").select("l_orderkey", "l_linenumber", line.alias("start_line"))


@query(
    "sarif_level",
    """
    select uuid, id, category = 'Security' as is_security, level,
           case when level in ('High', 'Error') then 'error' when level = 'Warning' then 'warning' else 'note' end as plain,
           case when category = 'Security' then case when level in ('High', 'Error') then 'error' when level = 'Warning' then 'warning' else 'note' end
                when level in ('High', 'Error') then 'warning' when level = 'Warning' then 'note' else 'none' end as compat
    from raw_patterns_csv""",
)
def sarif_level(fx: Fixtures) -> DataFrame:
    security = F.col("category") == "Security"
    return fx.raw_patterns.select(
        "uuid", "id", security.alias("is_security"), "level",
        report.sarif_level(F.col("level"), security).alias("plain"),
        report.sarif_level(F.col("level"), security, compat=True).alias("compat"),
    )


@query(
    "location_text",
    """
    select l_orderkey, l_linenumber, case when l_partkey % 2 = 0 then cast(l_linenumber as varchar)
           else l_linenumber || ':' || l_suppkey end as location from lineitem""",
)
def location_text(fx: Fixtures) -> DataFrame:
    column = F.when(F.col("l_partkey") % 2 != 0, F.col("l_suppkey"))
    where = tx.location_text(F.col("l_linenumber"), column)
    return fx.view("lineitem").select("l_orderkey", "l_linenumber", where.alias("location"))


# ---------------------------------------------------------------- SARIF


@query("split_security", f"select {_RUN}, filename, line, pattern_id, is_security from categorized")
def split_security(fx: Fixtures) -> DataFrame:
    return categorized(fx).select("project", "tool", "language", "filename", "line", "pattern_id", "is_security")


@query("sarif_rules", "select * from rules")
def sarif_rules(fx: Fixtures) -> DataFrame:
    return report.sarif_rules(categorized(fx), fx.patterns)


@query(
    "sarif_rules_legacy",
    f"""
    select {_RUN}, rule_id, cast(row_number() over (partition by {_RUN}, is_security order by rule_id) - 1 as int) as rule_index
    from rules""",
)
def sarif_rules_legacy(fx: Fixtures) -> DataFrame:
    rules = report.sarif_rules(categorized(fx), fx.patterns, legacy_rule_index=True)
    return rules.select("project", "tool", "language", "rule_id", "rule_index")


@query("sarif_artifacts", f"select distinct {_RUN}, filename from report_issues")
def sarif_artifacts(fx: Fixtures) -> DataFrame:
    return report.sarif_artifacts(issues(fx))


@query(
    "sarif_indexes",
    f"""
    select c.project, c.tool, c.language, c.filename, c.line, c.pattern_id, a.artifact_index,
           case when c.pattern_id = 'long' then -1 else coalesce(r.rule_index, -1) end as rule_index
    from categorized c join artifacts a using ({_RUN}, filename)
    left join (select {_RUN}, rule_id as pattern_id,
                      cast(row_number() over (partition by {_RUN} order by is_security desc, rule_id) - 1 as int) as rule_index
               from rules where rule_id <> 'long') r using ({_RUN}, pattern_id)""",
)
def sarif_indexes(fx: Fixtures) -> DataFrame:
    """One pattern is missing from the rules, so its index is -1."""
    found = categorized(fx)
    rules = report.sarif_rules(found, fx.patterns.filter("id <> 'long'"))
    indexed = report.sarif_indexes(found, rules)
    return indexed.select("project", "tool", "language", "filename", "line", "pattern_id", "artifact_index", "rule_index")


@query(
    "fingerprint_issues",
    rf"""
    select {_RUN}, filename, pattern_id, line,
           coalesce(nullif(ltrim(md5(filename || pattern_id || regexp_replace(content, '[\s\x0B]', '', 'g')), '0'), ''), '0') as fingerprint
    from moved_with_text""",
)
def fingerprint_issues(fx: Fixtures) -> DataFrame:
    return report.fingerprint_issues(moved_issues(fx), fx.files).drop("message", "level", "category", "column")


@query(
    "scan_fingerprints",
    rf"""
    select {_RUN}, i.filename, i.pattern_id, i.line, coalesce(nullif(ltrim(md5(i.filename || i.pattern_id ||
           regexp_replace(l.content, '[\s\x0B]', '', 'g')), '0'), ''), '0') as fingerprint
    from all_issues i join all_lines l using (project, filename, line)""",
)
def scan_fingerprints(fx: Fixtures) -> DataFrame:
    """Fingerprints taken while scanning."""
    found = all_issues(fx, fingerprints=True)
    return found.select("project", "tool", "language", "filename", "pattern_id", "line", "fingerprint")


@query(
    "union_security",
    f"""
    select {_RUN}, filename, line, pattern_id, case when is_security then 0 else 1 end as part from categorized""",
)
def union_security(fx: Fixtures) -> DataFrame:
    found = categorized(fx).select("project", "tool", "language", "filename", "line", "pattern_id", "is_security")
    both = report.union_security(found.filter("is_security"), found.filter("not is_security"))
    return both.drop("is_security")


@query(
    "sarif_report",
    rf"""
    select m.project, m.tool, m.language, c.is_security, m.pattern_id as rule_id, r.rule_index,
           case when c.is_security then case when m.level in ('High', 'Error') then 'error' when m.level = 'Warning' then 'warning' else 'note' end
                when m.level in ('High', 'Error') then 'warning' when m.level = 'Warning' then 'note' else 'none' end as level,
           m.message, m.filename, a.artifact_index, greatest(m.line, 1) as start_line,
           coalesce(nullif(ltrim(md5(m.filename || m.pattern_id || regexp_replace(m.content, '[\s\x0B]', '', 'g')), '0'), ''), '0') as fingerprint
    from moved_with_text m join catalog_patterns c on c.tool = m.tool and c.pattern_id = m.pattern_id
    join artifacts a on a.project = m.project and a.tool = m.tool and a.language = m.language and a.filename = m.filename
    join rules r on r.project = m.project and r.tool = m.tool and r.language = m.language and r.rule_id = m.pattern_id""",
)
def sarif_report(fx: Fixtures) -> DataFrame:
    """All SARIF results, in flat form."""
    return report.sarif_results(moved_issues(fx), issue_tools(fx), fx.patterns, fx.files, compat=True)


def _sql_line(s1: int, s2: str, s3: int, s4: str, line: str, source: str) -> str:
    return f"select project, {s1} as s1, {s2} as s2, {s3} as s3, {s4} as s4, {line} as line from {source}"


_COMMA = "case when {} then '' else ',' end || "
_TOOL_JSON = """cast(to_json({'name': case tool when 'lint-a' then 'Lint-a (reported)' else 'Lint-b (reported)' end,
    'version': case tool when 'lint-a' then '1.2.0' else '2.0' end, 'informationUri': ''}) as varchar)"""
# Members that are null are left out of a record.
_RULE_JSON = """cast(case when help_markdown is null
    then to_json({'id': rule_id, 'name': name, 'shortDescription': {'text': short_text}, 'help': {'text': short_text},
                  'properties': {'category': category}})
    else to_json({'id': rule_id, 'name': name, 'shortDescription': {'text': short_text},
                  'help': {'text': short_text, 'markdown': help_markdown}, 'properties': {'category': category}}) end as varchar)"""
_RESULT_JSON = """cast(to_json({'ruleIndex': rule_index, 'ruleId': rule_id, 'message': {'text': message}, 'level': level,
    'locations': [{'physicalLocation': {'artifactLocation': {'index': artifact_index, 'uri': filename},
                                        'region': {'startLine': start_line, 'startColumn': 1}}}],
    'partialFingerprints': {'primaryLocationStartColumnFingerprint': '1', 'primaryLocationLineHash': fingerprint}}) as varchar)"""

ctes(
    flat_results=r"""
        select m.project, m.tool, m.language, c.is_security, m.pattern_id as rule_id, r.rule_index,
               case when m.level in ('High', 'Error') then 'error' when m.level = 'Warning' then 'warning' else 'note' end as level,
               m.message, m.filename, a.artifact_index, greatest(m.line, 1) as start_line,
               coalesce(nullif(ltrim(md5(m.filename || m.pattern_id || regexp_replace(m.content, '[\s\x0B]', '', 'g')), '0'), ''), '0') as fingerprint
        from moved_with_text m join catalog_patterns c on c.tool = m.tool and c.pattern_id = m.pattern_id
        join artifacts a on a.project = m.project and a.tool = m.tool and a.language = m.language and a.filename = m.filename
        join rules r on r.project = m.project and r.tool = m.tool and r.language = m.language and r.rule_id = m.pattern_id""",
    spotted_results=f"""
        select project, tool || chr(1) || language as run_key, json,
               case when is_security then '0' else '1' end || chr(1) || filename || chr(1) || lpad(cast(start_line as varchar), 10, '0')
               || chr(1) || rule_id || chr(1) || md5(json) as spot
        from (select *, {_RESULT_JSON} as json from flat_results) x""",
    sarif_runs="""
        select *, run_key = min(run_key) over (partition by project) as is_first
        from (select project, tool, tool || chr(1) || language as run_key from good_report_runs) x""",
    issue_report_runs="""
        select *, run_key = min(run_key) over (partition by project) as is_first
        from (select project, tool, language, success, error, tool || chr(1) || language as run_key from report_runs where kind = 'issues') x""",
    report_heads="""
        select project, tool, language, tool || chr(1) || language as run_key, filename,
               filename = min(filename) over (partition by project, tool, language) as is_first
        from report_run_files join good_report_runs using (project, tool, language)""",
    report_items="""
        select *, json = min(json) over (partition by project, tool, language, filename) as is_first
        from (select project, tool, language, tool || chr(1) || language as run_key, filename, json
              from result_json join good_report_runs using (project, tool, language) where json is not null) x""",
)
_INVOCATION = '{"executionSuccessful":true,"workingDirectory":{"uri":"file:///"}}'
_SCHEMA_LINE = '{"$schema":"https://docs.oasis-open.org/sarif/sarif/v2.1.0/cos02/schemas/sarif-schema-2.1.0.json","version":"2.1.0","runs":['
_RUN_KEY = "tool || chr(1) || language"
_FAILURE_JSON = "cast(to_json({'Failure': {'message': error}}) as varchar)"
_LEAD = _COMMA.format("is_first") + """'{"tool":"' || tool || '","issues":{' || """


@query(
    "sarif_document",
    " union all ".join(
        [
            _sql_line(0, "''", 0, "''", f"'{_SCHEMA_LINE}'", "projects"),
            _sql_line(
                1, "run_key", 0, "''",
                _COMMA.format("is_first") + f"""'{{"tool":{{"driver":{{' || substr({_TOOL_JSON}, 2, length({_TOOL_JSON}) - 2) || ',"rules":['""",
                "sarif_runs",
            ),
            _sql_line(1, _RUN_KEY, 1, "lpad(cast(rule_index + 1 as varchar), 12, '0')", _COMMA.format("rule_index = 0") + _RULE_JSON, "rules"),
            _sql_line(1, "run_key", 2, "''", """']}},"results":['""", "sarif_runs"),
            _sql_line(
                1, "run_key", 3, "spot",
                _COMMA.format("spot = min(spot) over (partition by project, run_key)") + "json", "spotted_results",
            ),
            _sql_line(1, "run_key", 4, "''", f"""'],"invocations":[{_INVOCATION}],"artifacts":['""", "sarif_runs"),
            _sql_line(
                1, _RUN_KEY, 5, "lpad(cast(artifact_index as varchar), 12, '0')",
                _COMMA.format("artifact_index = 0") + "cast(to_json({'location': {'uri': filename}}) as varchar)", "artifacts",
            ),
            _sql_line(1, "run_key", 6, "''", "']}'", "sarif_runs"),
            _sql_line(9, "''", 0, "''", "']}'", "projects"),
        ]
    ),
)
def sarif_document(fx: Fixtures) -> DataFrame:
    """The SARIF documents as ordered lines."""
    found = stage(moved_issues(fx), "issues")
    tools = issue_tools(fx)
    sorted_out = report.split_security(found, tools, fx.patterns)
    rules = report.sarif_rules(sorted_out, fx.patterns)
    flat = report.sarif_results(found, tools, fx.patterns, fx.files)
    return report.sarif_document(
        fx.projects, fx.report_runs, tools, rules, report.indexed_artifacts(found), flat, name_suffix=" (reported)"
    )


# ---------------------------------------------------------------- text and JSON


@query(
    "clone_files_grouped",
    """
    select project, clone_id, filename, string_agg(start_line || ' - ' || end_line, ',' order by start_line) as ranges
    from wide_occurrences group by 1, 2, 3""",
)
def clone_files_grouped(fx: Fixtures) -> DataFrame:
    grouped = report.clone_files_grouped(occurrences(fx))
    return grouped.withColumn("ranges", F.array_join("ranges", ","))


@query("render_text", "select project, line from shown_text")
def render_text(fx: Fixtures) -> DataFrame:
    """The plain report of issues, file errors, metrics and clones."""
    return report.render_text(results(fx), metrics(fx), own_occurrences(fx)).select("project", "line")


@query(
    "render_clones",
    """
    select 'Found [Clone] ' || nr_lines || ' duplicated lines with ' || nr_tokens || ' tokens:' as line
    from (select distinct clone_id, nr_lines, nr_tokens from wide_occurrences) c
    union all
    select '  ' || filename || chr(10) || string_agg('    l. ' || start_line || ' - ' || end_line, chr(10) order by start_line)
    from wide_occurrences group by clone_id, filename""",
)
def render_clones(fx: Fixtures) -> DataFrame:
    return report.clone_text_lines(occurrences(fx)).select("line")


@query("render_json", "select project, shown as line from shown_json")
def render_json(fx: Fixtures) -> DataFrame:
    return json_records(fx).select("project", "line")


@query(
    "write_text",
    """
    select project, unnest(string_split(line, chr(10))) as line from shown_text
    union all select project, 'Starting analysis ...' from projects
    union all select project, 'Analysis complete' from projects""",
)
def write_text(fx: Fixtures) -> DataFrame:
    """The plain report, written and read back line by line."""
    body = report.render_text(results(fx), metrics(fx), own_occurrences(fx))
    path = scratch_path(fx.spark, "text-report")
    documents.write_document(report.text_document(fx.projects, body), path)
    return documents.read_document(fx.spark, path)


@query(
    "write_json",
    """
    select project, case when (s1 <> 3 or s3 = 0) and row_number() over (partition by project order by s1, s2, s3, s4) > 1
                         then ',' else '' end || shown as line from shown_json
    union all select project, '[' from projects union all select project, ']' from projects""",
)
def write_json(fx: Fixtures) -> DataFrame:
    """The JSON report, written and read back, with its separating commas."""
    path = scratch_path(fx.spark, "json-report")
    documents.write_document(report.json_document(fx.projects, json_records(fx)), path)
    return documents.read_document(fx.spark, path)


_RESULTS_SQL = """
    select 'Issue' as kind, filename, pattern_id, message, level, category, line, case when line % 3 = 0 then line + 1 end as col,
           null as complexity, null as loc, null as start_line, null as end_line, null as nr_lines, null as nr_tokens from report_issues
    union all select 'FileError', filename, null, message, null, null, null, null, null, null, null, null, null, null from report_errors
    union all select 'FileMetrics', filename, null, null, null, null, null, null, complexity, loc, null, null, null, null from report_metrics
    union all select 'DuplicationClone', filename, null, null, null, null, null, null, null, null, start_line, end_line, nr_lines, nr_tokens
        from own_occurrences"""


def taken_apart(decoded: DataFrame) -> DataFrame:
    """Decoded results of all kinds as flat rows."""
    found = documents.issues(decoded).withColumnRenamed("column", "col").withColumn("kind", F.lit("Issue"))
    errors = documents.file_errors(decoded).withColumn("kind", F.lit("FileError"))
    measured = documents.metrics(decoded).select(F.lit("FileMetrics").alias("kind"), "filename", "complexity", "loc")
    copied = documents.clone_occurrences(decoded).drop("clone_id").withColumn("kind", F.lit("DuplicationClone"))
    both = found.unionByName(errors, allowMissingColumns=True).unionByName(measured, allowMissingColumns=True)
    return both.unionByName(copied, allowMissingColumns=True)


def with_columns(found: DataFrame) -> DataFrame:
    return found.withColumn("column", F.when(F.col("line") % 3 == 0, F.col("line") + 1))


@query(
    "read_results",
    _RESULTS_SQL,
)
def read_results(fx: Fixtures) -> DataFrame:
    """Tagged JSON results of all kinds, written one per line, decoded and taken apart."""
    path = scratch_path(fx.spark, "results")
    report.render_json(with_columns(results(fx)), metrics(fx)).select("line").union(clone_objects(fx)).write.text(path)
    # Four kinds are taken from the decoded results, which are decoded once.
    return taken_apart(stage(documents.read_results(fx.spark, path, lines=True), "decoded"))


@query(
    "read_result_arrays",
    _RESULTS_SQL + """
    union all select 'broken', null, null, '{"FileError":{"filena', null, null, null, null, null, null, null, null, null, null from report_errors""",
)
def read_result_arrays(fx: Fixtures) -> DataFrame:
    """The JSON documents of all projects, with a record that breaks off after each file error, read by many tasks."""
    path = scratch_path(fx.spark, "result-arrays")
    records = stage(json_records(fx, with_columns(results(fx))), "records")
    broken = records.filter(F.col("line").startswith('{"FileError"')).withColumn("line", F.substring("line", 1, 21)).withColumn("s3", F.lit(1))
    documents.write_document(report.json_document(fx.projects, records.unionByName(broken)), path)
    read = stage(documents.read_results(fx.spark, path, bad_records=True), "decoded")
    bad = read.filter("broken is not null").select(F.lit("broken").alias("kind"), F.ltrim("broken", F.lit(",")).alias("message"))
    return taken_apart(read.filter("broken is null")).unionByName(bad, allowMissingColumns=True)


# ---------------------------------------------------------------- export


@query(
    "issues_report",
    "select project, tool, language, filename, json from result_json",
)
def issues_report(fx: Fixtures) -> DataFrame:
    """The rows of the nested report: every file with each of its results."""
    return export.result_rows_json(run_files(fx), results(fx))


@query(
    "issues_report_document",
    " union all ".join(
        [
            _sql_line(0, "''", 0, "''", "'['", "projects"),
            _sql_line(1, "run_key", 0, "''", _LEAD + """'"Success":{"results":['""", "issue_report_runs where success"),
            _sql_line(
                1, "run_key", 0, "''", _LEAD + f"substr({_FAILURE_JSON}, 2) || '}}'", "issue_report_runs where not success",
            ),
            _sql_line(
                1, "run_key", 1, "filename || chr(1) || '0'",
                _COMMA.format("is_first") + """'{"filename":"' || filename || '","results":['""", "report_heads",
            ),
            _sql_line(1, "run_key", 1, "filename || chr(1) || '1' || json", _COMMA.format("is_first") + "json", "report_items"),
            _sql_line(1, "run_key", 1, "filename || chr(1) || '2'", "']}'", "report_heads"),
            _sql_line(1, "run_key", 2, "''", "']}}}'", "issue_report_runs where success"),
            _sql_line(9, "''", 0, "''", "']'", "projects"),
        ]
    ),
)
def issues_report_document(fx: Fixtures) -> DataFrame:
    """The nested report as ordered lines."""
    return export.issues_report(fx.report_runs, run_files(fx), results(fx))


@query("upload_batches", f"select {_RUN}, filename, n_results, batch from recursive_batches")
def upload_batches(fx: Fixtures) -> DataFrame:
    counts = merge.count_results_by_file(run_files(fx), results(fx))
    return export.upload_batches(stage(counts, "result-counts"), BATCH_SIZE)


@query("upload_batches_default", f"select {_RUN}, filename, n_results, batch from recursive_defaults")
def upload_batches_default(fx: Fixtures) -> DataFrame:
    """Batches of the default size, of files with thousands of different numbers of results."""
    price = F.floor("o_totalprice").cast("bigint") % 60000
    counts = fx.view("orders").select(
        F.concat(F.lit("p"), (F.col("o_custkey") % 40).cast("string")).alias("project"), F.lit("lint-a").alias("tool"),
        F.lit("any").alias("language"), F.col("o_orderkey").cast("string").alias("filename"), price.alias("n_results"),
    )
    return export.upload_batches(counts)


@query("count_results_by_file", f"select {_RUN}, filename, n_results from file_counts")
def count_results_by_file(fx: Fixtures) -> DataFrame:
    return merge.count_results_by_file(run_files(fx), results(fx))


@query(
    "write_batches",
    f"""
    select project, kind, tool, language, batch, filename, cast(payload as varchar) as payload from (
    select b.project, 'issues' as kind, b.tool, b.language, b.batch, b.filename, j.json as payload
    from recursive_batches b join result_json j using ({_RUN}, filename) join good_report_runs using ({_RUN})
    union all
    select project, 'metrics', 'metrics', 'any', 0, filename,
           case when complexity is null then to_json({{'file': filename, 'metrics': {{'lineComplexities': []}}}})
                else to_json({{'file': filename, 'metrics': {{'complexity': complexity, 'loc': loc, 'lineComplexities': []}}}}) end
    from report_metrics
    union all
    select project, kind, tool, language, 0, null, to_json({{'Failure': {{'message': error}}}}) from report_runs where not success
    union all
    select 'all', 'duplication', 'duplication', 'any', 0, filename,
           to_json({{'cloneId': clone_id, 'filePath': filename, 'startLine': start_line, 'endLine': end_line}})
    from wide_occurrences
    union all
    select 'all', 'duplication', 'duplication', 'any', 0, null,
           to_json({{'cloneId': clone_id, 'cloneLines': clone_lines, 'nrTokens': nr_tokens, 'nrLines': nr_lines}})
    from wide_clones
    union all
    select 'all', 'duplication', 'duplication', 'any', 0, filename, to_json({{'analysedFile': filename}}) from all_lang_files) p""",
)
def write_batches(fx: Fixtures) -> DataFrame:
    """Upload payloads of all kinds, written and read back."""
    found = stage(results(fx), "results")
    counts = stage(merge.count_results_by_file(run_files(fx), found), "result-counts")
    measured = metrics(fx).withColumn("language", F.lit("any"))
    searched = _wide_files(fx)
    places = occurrences(fx)
    payloads = (
        export.issue_payloads(fx.report_runs, run_files(fx), found, counts, BATCH_SIZE)
        .unionByName(export.metrics_payloads(fx.report_runs, measured))
        .unionByName(export.duplication_payloads(fx.report_runs, places, analysers.clones(places, searched), searched))
    )
    path = scratch_path(fx.spark, "batches")
    documents.write_batches(payloads, path)
    schema = "filename string, payload string, project string, kind string, tool string, language string, batch int"
    return fx.spark.read.schema(schema).json(path).select("filename", "payload", "project", "kind", "tool", "language", "batch")


