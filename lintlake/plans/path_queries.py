"""Listing, exclusion, languages: registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lintlake.operators import paths
from lintlake.plans.fixtures import Fixtures
from lintlake.plans.registry import ctes, query

# The oracles state the fixture's rules by hand instead of compiling them.
_DIGIT = "cast(right(project, 1) as int)"
_GLOBS = (
    "(regexp_matches(filename, '^.*/doc_1[^/]*[.]js$') or starts_with(filename, 'vendor/')"
    f" or ({_DIGIT} % 2 = 1 and regexp_matches(filename, '^doc_[^/]*$')))"
)
_PATHS = f"(starts_with(filename, 'test/') or ({_DIGIT} % 2 = 0 and starts_with(filename, 'src/main/')))"
_REGEX = "regexp_full_match(filename, 'src/doc_[0-9]*5[.].*')"

ctes(
    readable="select project, filename, doc_id, text from files where is_readable",
    kept=f"""
        select * from readable
        where not {_GLOBS} and not {_PATHS} and not ({_DIGIT} >= 5 and {_REGEX})""",
    detected=f"""
        select * from (
            select project, filename, doc_id, text,
                   case when {_DIGIT} % 2 = 0 and ends_with(filename, '.js-tmpl') then 'Ruby'
                        when ends_with(filename, '.js') then 'Javascript' when ends_with(filename, '.py') then 'Python'
                        when ends_with(filename, '.rb') then 'Ruby' when ends_with(filename, '.css') then 'CSS' end as language
            from kept) d
        where language is not null""",
    project_languages="select distinct project, language from detected",
)


def _names(files: DataFrame) -> DataFrame:
    return files.select("project", "filename")


def _readable(fx: Fixtures) -> DataFrame:
    return fx.files.filter("is_readable").select("project", "filename")


def kept(fx: Fixtures) -> DataFrame:
    rules = paths.effective_rules(fx.exclusion_rules, fx.local_config)
    return paths.filter_global(fx.files.filter("is_readable"), rules)


def detected(fx: Fixtures) -> DataFrame:
    return paths.detect_languages(kept(fx), fx.custom_extensions)


def project_languages(fx: Fixtures) -> DataFrame:
    return paths.project_languages(detected(fx))


@query(
    "list_files",
    """
    select project, substr(path, length(root) + 2) as filename, mode from manifest
    where is_regular and not starts_with(substr(path, length(root) + 2), '.git/')""",
)
def list_files(fx: Fixtures) -> DataFrame:
    return paths.list_files(fx.manifest)


@query(
    "split_readable",
    "select project, path, is_regular and (mode & 4) <> 0 as is_readable from manifest",
)
def split_readable(fx: Fixtures) -> DataFrame:
    return paths.split_readable(fx.manifest).select("project", "path", "is_readable")


@query("exclude_globs", f"select project, filename from readable where not {_GLOBS}")
def exclude_globs(fx: Fixtures) -> DataFrame:
    return paths.exclude_globs(_readable(fx), fx.exclusion_rules)


@query("exclude_paths", f"select project, filename from readable where not {_PATHS}")
def exclude_paths(fx: Fixtures) -> DataFrame:
    return paths.exclude_paths(_readable(fx), fx.exclusion_rules)


@query("exclude_regex", f"select project, filename from readable where not {_REGEX}")
def exclude_regex(fx: Fixtures) -> DataFrame:
    return paths.exclude_regex(_readable(fx), fx.exclusion_rules)


@query(
    "exclude_flawed",
    f"""
    select project, filename from readable where not {_GLOBS} and not {_PATHS} and not {_REGEX}
        and not regexp_full_match(filename, 'src/doc_[0-9]*[79][.].*') and not regexp_full_match(filename, 'src/doc_[0-9]+[.]py')""",
)
def exclude_flawed(fx: Fixtures) -> DataFrame:
    """Broken rules, rules with equal group names and a path rule per file: the usable ones hold."""
    return paths.filter_global(_readable(fx), fx.flawed_rules)


@query(
    "broken_rules",
    """
    select project, scope, tool, kind, value, 'Broken ' || kind || ' ' || value as error from flawed_rules
    where value in ('src/(doc', 'src/[z-a]*')""",
)
def broken_rules(fx: Fixtures) -> DataFrame:
    return paths.broken_rules(fx.flawed_rules)


@query("filter_global", "select project, filename from kept")
def filter_global(fx: Fixtures) -> DataFrame:
    return _names(kept(fx))


@query(
    "filter_language",
    f"""
    select project, filename from kept
    where ends_with(filename, '.rb') or ({_DIGIT} % 2 = 0 and ends_with(filename, '.js-tmpl'))""",
)
def filter_language(fx: Fixtures) -> DataFrame:
    return paths.filter_language(_names(kept(fx)), fx.custom_extensions, "Ruby")


@query(
    "ignores_precedence",
    """
    select project, scope, kind, value from exclusion_rules
    where kind <> 'regex' or project not in (select project from local_config)""",
)
def ignores_precedence(fx: Fixtures) -> DataFrame:
    return paths.effective_rules(fx.exclusion_rules, fx.local_config).select("project", "scope", "kind", "value")


@query(
    "except_files",
    f"""
    select project, filename from files where is_readable
    except all select project, filename from files where is_readable and {_PATHS}""",
)
def except_files(fx: Fixtures) -> DataFrame:
    """Readable files minus those below an ignored path."""
    readable = _readable(fx)
    ignored = readable.exceptAll(paths.exclude_paths(readable, fx.exclusion_rules))
    return paths.except_files(readable, ignored)


@query("detect_languages", "select project, filename, language from detected")
def detect_languages(fx: Fixtures) -> DataFrame:
    return detected(fx).select("project", "filename", "language")


@query("project_languages", "select project, language from project_languages")
def project_languages_query(fx: Fixtures) -> DataFrame:
    return project_languages(fx)


@query(
    "merge_extensions",
    "select project, language, suffix from local_extensions union select project, language, suffix from remote_extensions",
)
def merge_extensions(fx: Fixtures) -> DataFrame:
    return paths.merge_extensions(fx.local_extensions, fx.remote_extensions)


@query(
    "has_config_files",
    """
    select p.project, t.tool, coalesce(bool_or(l.filename is not null), false) as has_config_files
    from projects p cross join (select 'lint-a' as tool union all select 'lint-b') t
    left join listing l on l.project = p.project and l.is_readable and t.tool = 'lint-b'
        and regexp_matches(l.filename, '(^|/)lint[.]yml$')
    group by p.project, t.tool""",
)
def has_config_files(fx: Fixtures) -> DataFrame:
    tools = fx.tools.filter("kind = 'issues' and not standalone")
    names = F.explode(F.array(F.lit("lint-a"), F.lit("lint-b"))).alias("tool")
    return paths.has_config_files(fx.listing, tools, fx.projects.select("project", names))
