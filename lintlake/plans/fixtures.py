"""Inputs of the registered queries, derived from the given tables.

Documents stand in for source files, parts and line items for tool and pattern catalogs, orders for
lookups. The view texts run unchanged in Spark SQL and in the SQL oracle.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from lintlake.functions.scale import stage
from lintlake.operators.analysers import MetricRule
from lintlake.sources.tables import read_table

_DIGIT = "cast(right(project, 1) as int)"

# Name -> SQL; ``{name}`` refers to another view or a given table.
VIEWS: dict[str, str] = {
    "files": """
        select source as project,
               concat(case doc_id % 7 when 0 then 'test/' when 1 then 'vendor/lib/' when 2 then 'src/main/'
                                      when 3 then '' else 'src/' end,
                      'doc_', cast(doc_id as string),
                      case when doc_id % 13 = 0 then '.unknown' when doc_id % 11 = 0 then '.js-tmpl'
                           when lang = 'en' then '.js' when lang = 'fr' then '.py'
                           when lang = 'de' then '.rb' else '.css' end) as filename,
               doc_id % 17 <> 0 as is_readable, doc_id, text
        from {documents}""",
    "projects": "select distinct source as project from {documents}",
    "manifest": """
        select project, concat('/data/', project) as root,
               concat('/data/', project, '/', case when doc_id % 19 = 0 then '.git/' when doc_id % 23 = 0 then '.github/'
                                                  else '' end, filename) as path,
               doc_id % 31 <> 0 as is_regular, case when doc_id % 17 = 0 then 416 else 420 end as mode
        from {files}
        union all
        select 'web', '/data/web', concat('/data/web/pages/p', cast(page_id as string), '.html'), true, 420 from {pages}""",
    "listing": """
        select project, filename, is_readable, doc_id from {files}
        union all
        select project, concat('d', cast(doc_id as string), case when doc_id % 58 = 0 then '/main/lint.yml'
                                                                 else '/xlint.yml' end),
               doc_id % 3 <> 0, doc_id
        from {files} where doc_id % 29 = 0""",
    "custom_extensions": f"select project, 'Ruby' as language, '.js-tmpl' as suffix from {{projects}} where {_DIGIT} % 2 = 0",
    "local_extensions": f"""
        select project, 'Ruby' as language, '.js-tmpl' as suffix from {{projects}} where {_DIGIT} % 2 = 0
        union all select project, 'Python', '.unknown' from {{projects}} where {_DIGIT} < 3""",
    "remote_extensions": f"""
        select project, 'Ruby' as language, '.js-tmpl' as suffix from {{projects}} where {_DIGIT} % 3 = 0
        union all select project, 'CSS', '.theme' from {{projects}}""",
    "local_config": f"select project from {{projects}} where {_DIGIT} < 5",
    "exclusion_rules": f"""
        select project, 'global' as scope, cast(null as string) as tool, 'glob' as kind, '**/doc_1*.js' as value from {{projects}}
        union all select project, 'global', null, 'glob', 'vendor/**' from {{projects}}
        union all select project, 'global', null, 'glob', 'doc_*' from {{projects}} where {_DIGIT} % 2 = 1
        union all select project, 'global', null, 'path', 'test' from {{projects}}
        union all select project, 'global', null, 'path', 'src/main' from {{projects}} where {_DIGIT} % 2 = 0
        union all select project, 'global', null, 'regex', 'src/doc_[0-9]*5[.].*' from {{projects}}
        union all select project, 'tool', 'lint-b', 'glob', 'src/*.rb' from {{projects}}
        union all select project, 'tool', 'metrics', 'glob', 'src/doc_2*' from {{projects}}""",
    "flawed_rules": f"""
        select * from {{exclusion_rules}}
        union all select project, 'global', cast(null as string), 'regex', '(?<n>src)/doc_[0-9]*7[.].*' from {{projects}}
        union all select project, 'global', null, 'regex', '(?<n>src)/doc_[0-9]*9[.].*' from {{projects}}
        union all select project, 'global', null, 'regex', 'src/(doc' from {{projects}} where {_DIGIT} % 3 = 0
        union all select project, 'global', null, 'glob', 'src/[z-a]*' from {{projects}} where {_DIGIT} % 4 = 0
        union all select source, 'global', null, 'path', concat('src/doc_', cast(doc_id as string), '.py') from {{documents}}""",
    "tools_csv": """
        select * from (values
            ('uuid-lint-a', 'issues', 'lint-a', 'v1.2.0', 'A_', 'Javascript,Python', '', false),
            ('uuid-lint-b', 'issues', 'lint-b', '2.0', '', 'Ruby,CSS', 'lint.yml,main/lint.yml', false),
            ('uuid-lint-s', 'issues', 'lint-s', '3', '', 'Javascript', '', true),
            ('uuid-metrics-1', 'metrics', 'metrics-1', '1', '', 'Javascript,Python,Ruby,CSS', '', false),
            ('uuid-metrics-1', 'metrics', 'metrics-1', '1', '', 'Javascript,Python,Ruby,CSS', '', false),
            ('uuid-metrics-2', 'metrics', 'metrics-2', '1', '', 'Javascript', '', false),
            ('uuid-clones-1', 'duplication', 'clones-1', '1', '', 'Javascript,Python,Ruby', '', false)
        ) as t(tool_uuid, kind, tool, version, prefix, languages_csv, config_csv, standalone)""",
    "patterns": """
        select *, concat(title, ' found') as message from (values
            ('lint-a', 'uuid-lint-a', 'phone', 'A_phone', '[0-9]{{3}}-[0-9]{{4}}', 'Error', 'Security', 'Phone number', 'A phone number.', 'Remove *it*.', true),
            ('lint-a', 'uuid-lint-a', 'handle', 'A_handle', '@[a-z]+', 'High', 'Security', 'Handle', null, null, true),
            ('lint-a', 'uuid-lint-a', 'license', 'A_license', '(?i)license', 'Warning', 'CodeStyle', 'License', 'A license line.', null, true),
            ('lint-a', 'uuid-lint-a', 'secret', 'A_secret', 'key|secret|token', 'Error', 'Security', 'Secret', 'A secret.', null, true),
            ('lint-b', 'uuid-lint-b', 'commas', 'commas', ',.*,.*,', 'Info', 'CodeStyle', 'Commas', 'Many commas.', null, true),
            ('lint-b', 'uuid-lint-b', 'digit', 'digit', '[0-9]', 'Info', 'ErrorProne', 'Digit', 'A digit.', null, false),
            ('lint-b', 'uuid-lint-b', 'long', 'long', '.{{400,}}', 'Warning', 'CodeStyle', 'Long line', 'A long line.', null, true)
        ) as t(tool, tool_uuid, id, pattern_id, regex, level, category, title, description, explanation, enabled)""",
    "tool_config_csv": f"""
        select project, case when {_DIGIT} % 4 = 0 then 'uuid-lint-a' else 'UUID-LINT-A' end as tool_uuid,
               true as enabled, false as not_edited, 'A_phone,license,A_gone' as pattern_csv
        from {{projects}} where {_DIGIT} % 2 = 0
        union all select project, 'uuid-lint-b', {_DIGIT} % 3 = 0, true, '' from {{projects}} where {_DIGIT} <> 9
        union all select project, 'uuid-unknown', true, false, '' from {{projects}} where {_DIGIT} % 5 = 0""",
    "engine_config": f"""
        select project, 'lint-a' as tool, 'src' as base_sub_dir, '{{{{"depth":1}}}}' as extra from {{projects}} where {_DIGIT} % 3 = 1
        union all select project, 'lint-b', null, '{{{{"depth":2}}}}' from {{projects}} where {_DIGIT} % 3 = 2""",
    "failures": f"""
        select project, 'metrics-2' as tool, 'metrics-2 crashed' as error from {{projects}} where {_DIGIT} = 3
        union all select project, 'lint-b', 'lint-b crashed' from {{projects}} where {_DIGIT} = 7
        union all select project, 'clones-1', 'clones-1 crashed' from {{projects}} where {_DIGIT} = 8""",
    "metric_failures": f"""
        select * from {{failures}}
        union all select project, 'metrics-1', 'metrics-1 crashed' from {{projects}} where {_DIGIT} in (3, 6)""",
    "limits": f"select project, 50 as max_allowed, {_DIGIT} % 2 = 1 as fail_if_incomplete from {{projects}}",
    "partial_metrics": """
        select project, 'Any' as language, 'A' as tool, 1 as run_order, filename, cast(length(text) % 50 as int) as complexity,
               cast(null as int) as loc, cast(doc_id % 9 as int) as nr_methods from {files} where doc_id % 2 = 0
        union all
        select project, 'Any', 'B', 2, filename, cast(doc_id % 50 as int), cast(length(text) as int), cast(null as int)
        from {files} where doc_id % 3 = 0""",
    "metrics_runs": f"""
        select project, 'Javascript' as language, 1 as run_order, true as success, cast(null as string) as error from {{projects}}
        union all select project, 'Javascript', 2, false, 'out of memory' from {{projects}}
        union all select project, 'Javascript', 3, false, 'timeout' from {{projects}} where {_DIGIT} % 2 = 0
        union all select project, 'Ruby', 4, false, 'no result' from {{projects}}""",
    "metrics_run_files": """
        select project, 'Javascript' as language, 1 as run_order, filename from {files} where filename like '%.js'
        union all select project, 'Javascript', 2, filename from {files} where filename like '%.js'
        union all select project, 'Javascript', 3, filename from {files} where filename like '%.js' and doc_id % 5 <> 0
        union all select project, 'Ruby', 4, filename from {files} where filename like '%.rb'""",
    "reported_clones": """
        select project, concat('c', cast(cast(floor(doc_id / 100) as int) as string)) as clone_id,
               cast(cast(floor(doc_id / 100) as int) % 9 as int) as nr_lines, 40 as nr_tokens, filename,
               cast(doc_id % 50 + 1 as int) as start_line,
               cast(doc_id % 50 + cast(floor(doc_id / 100) as int) % 9 as int) as end_line
        from {files}""",
    "report_runs": f"""
        select project, 'issues' as kind, 'lint-a' as tool, 'any' as language, 1 as run_order, true as success,
               cast(null as string) as error
        from {{projects}}
        union all select project, 'issues', 'lint-b', 'any', 2, {_DIGIT} <> 7, case when {_DIGIT} = 7 then 'lint-b crashed' end
        from {{projects}}
        union all select project, 'metrics', 'metrics', 'any', 3, true, null from {{projects}}
        union all select project, 'metrics', 'metrics', 'other', 4, false, 'metrics crashed' from {{projects}} where {_DIGIT} = 3
        union all select project, 'duplication', 'duplication', 'any', 5, {_DIGIT} <> 8, case when {_DIGIT} = 8 then 'no memory' end
        from {{projects}}""",
    "raw_tools_csv": """
        select md5(concat('tool-', cast(p_partkey as string))) as uuid, cast(p_partkey as int) as position, p_name as name,
               concat('Tool-', cast(p_partkey as string)) as short_name,
               concat(case when p_size % 2 = 0 then 'v' else '' end, cast(p_size as string), '.0') as version,
               case p_partkey % 3 when 0 then cast(null as string) when 1 then '' else concat(p_brand, '_') end as prefix,
               case p_size % 5 when 0 then 'Python,Ruby' when 1 then 'Javascript' when 2 then 'Klingon,CSS' when 3 then 'Klingon'
                               else 'Java,Scala,Kotlin' end as languages_csv,
               case p_size % 4 when 0 then '' when 1 then '.lintrc' else 'lint.yml,conf/lint.yml' end as config_csv,
               p_size % 10 = 0 as standalone
        from {part}""",
    "raw_patterns_csv": """
        select md5(concat('tool-', cast(l_partkey as string))) as uuid,
               concat(case when l_linenumber % 3 > 0 and l_partkey % 3 = 2 then concat(p_brand, '_') else '' end, 'P',
                      cast(l_orderkey as string), '_', cast(l_linenumber as string)) as id,
               case l_linenumber % 5 when 0 then 'Info' when 1 then 'Warning' when 2 then 'High' when 3 then 'Error'
                                     else 'Fatal' end as level,
               case l_returnflag when 'A' then 'Security' when 'N' then 'CodeStyle' else 'Taste' end as category,
               case when l_returnflag = 'A' then case when l_linenumber = 2 then 'Magic' else 'XSS' end end as sub_category,
               case when l_orderkey % 4 > 0 then concat('Title ', cast(l_orderkey as string)) end as title,
               case when l_orderkey % 3 > 0 then concat('About ', cast(l_linenumber as string)) end as description,
               l_linenumber % 2 = 0 as enabled,
               case when l_orderkey % 5 = 0 then cast(null as int) else cast(l_linenumber * 5 as int) end as time_to_fix,
               case when l_linenumber % 4 > 0 then 'Python,Klingon' end as languages_csv,
               cast(cast(l_quantity as int) as string) as max_default
        from {lineitem} join {part} on l_partkey = p_partkey""",
    "saved_tools": """
        select uuid, position, name, short_name, '0.9' as version from {raw_tools_csv} where position % 2 = 0""",
    "fetched_tools": """
        select uuid, position, name, short_name, version from {raw_tools_csv} where position % 3 <> 0""",
    "saved_patterns": """
        select p.uuid, t.version, p.id, 'saved' as origin from {raw_patterns_csv} p join {raw_tools_csv} t on p.uuid = t.uuid
        where t.position % 3 = 0""",
    "fetched_patterns": """
        select p.uuid, t.version, p.id, 'fetched' as origin from {raw_patterns_csv} p join {raw_tools_csv} t on p.uuid = t.uuid
        where t.position % 2 = 0""",
    "requests": """
        select o_orderkey as request_id,
               case o_orderkey % 5 when 0 then concat('TOOL-', cast(o_custkey as string))
                                   when 1 then concat('tool-', cast(o_custkey as string))
                                   when 2 then upper(md5(concat('tool-', cast(o_custkey as string))))
                                   when 3 then 'no-such-tool' else 'Tool-1' end as query
        from {orders}""",
    "error_rows": """
        select cast(o_custkey as string) as project,
               case o_orderkey % 9 when 0 then 'CommitUuidsDoNotMatch' when 1 then 'UncommittedChanges' when 2 then 'NonExistingTool'
                    when 3 then 'StandaloneTool' when 4 then 'UploadError' when 5 then 'MissingUploadRequisites'
                    when 6 then 'InvalidConfiguration' when 7 then 'FilesAccessError' end as error_kind
        from {orders}""",
}

# Rules that hit the prose of the given documents.
METRIC_RULES = {
    "Javascript": MetricRule(comment="^[A-M]", method="[.]$", type_="^[N-Z].*,", branch="the|and"),
    "Python": MetricRule(comment="^[A-M]", method="[.]$", type_="^[N-Z].*,", branch="les|une"),
    "Ruby": MetricRule(comment="^[A-L]", method="[.]$", type_="^[M-Z].*,", branch="der|und"),
}

# Given tables with the column that tells their rows apart.
GIVEN = {"documents": "doc_id", "pages": "page_id", "part": "p_partkey", "lineitem": "l_orderkey", "orders": "o_orderkey"}


#: Tables of tools, as many as there are parts: joins of the views merge them instead of going by the size of their files.
MERGED = {"part", "raw_tools_csv"}


def references(sql: str) -> list[str]:
    """Names a view text refers to."""
    return sorted(set(re.findall(r"(?<!\{)\{([a-z_]+)\}(?!\})", sql)))


class Fixtures:
    """The views over one data folder, built when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._views: dict[str, DataFrame] = {}

    def view(self, name: str) -> DataFrame:
        if name not in self._views:
            if name in GIVEN:
                self._views[name] = read_table(self.spark, f"{self.sf_dir}/{name}.parquet")
            else:
                sql = VIEWS[name]
                inputs = {ref: self.view(ref).hint("merge") if ref in MERGED else self.view(ref) for ref in references(sql)}
                frame = self.spark.sql(sql, **inputs) if inputs else self.spark.sql(sql.format())
                # The project list is a small table of its own that many configuration views start from.
                self._views[name] = stage(frame, name) if name == "projects" else frame
        return self._views[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.view(name)
        raise AttributeError(name)

    @staticmethod
    def _list(column: str):
        return F.filter(F.split(column, ","), lambda x: x != "")

    @cached_property
    def tools(self) -> DataFrame:
        csv = self.view("tools_csv")
        return csv.select(
            "tool_uuid", "kind", "tool", F.col("tool").alias("name"), "version", "prefix", "standalone",
            self._list("languages_csv").alias("languages"), self._list("config_csv").alias("config_filenames"),
            (F.col("config_csv") != "").alias("has_config_file"),
        )

    @cached_property
    def rules_table(self) -> DataFrame:
        return self.view("patterns").withColumn("languages", F.array().cast("array<string>"))

    @cached_property
    def tool_config(self) -> DataFrame:
        """Configured patterns; the first one has a parameter."""
        csv = self.view("tool_config_csv")
        parameter = F.array(F.struct(F.lit("max").alias("name"), F.lit("3").alias("value")))
        patterns = F.transform(
            self._list("pattern_csv"),
            lambda p: F.struct(
                p.alias("id"), F.when(p == "A_phone", parameter).otherwise(F.slice(parameter, 1, 0)).alias("parameters")
            ),
        )
        return csv.select("project", "tool_uuid", "enabled", "not_edited", patterns.alias("patterns"))

    @cached_property
    def raw_tools(self) -> DataFrame:
        csv = self.view("raw_tools_csv")
        lists = [self._list("languages_csv").alias("languages"), self._list("config_csv").alias("config_filenames")]
        return csv.select(*[c for c in csv.columns if not c.endswith("_csv")], *lists)

    @cached_property
    def raw_patterns(self) -> DataFrame:
        csv = self.view("raw_patterns_csv")
        maximum = F.struct(
            F.lit("max").alias("name"), F.col("max_default").alias("default"), F.lit("Upper limit").alias("description")
        )
        minimum = F.struct(
            F.lit("min").alias("name"), F.lit("0").alias("default"), F.lit(None).cast("string").alias("description")
        )
        return csv.select(
            *[c for c in csv.columns if c not in ("languages_csv", "max_default")],
            F.lit(None).cast("string").alias("explanation"),
            self._list("languages_csv").alias("languages"),
            F.array(maximum, minimum).alias("parameters"),
        )
