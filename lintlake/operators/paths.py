"""Listing, exclusion rules, language detection.

``files`` has at least ``project, filename``; other columns (``text``) pass through untouched. Rules
are a table ``(project, scope, tool, kind, value)`` with ``scope`` global or tool and ``kind`` glob,
path or regex. They become an index by what a file must have in common with a rule, a directory, an extension or the
project alone, and files meet it in anti joins: a file row is never multiplied, no row holds all rules of a project, and
texts are not shuffled while the index fits a broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lintlake.functions import globs, languages as lang, paths, regexes
from lintlake.functions.scale import lookup_join, salt_count, stage

OTHERS_READ = 0o004
VCS_DIRECTORY = ".git"


# ---------------------------------------------------------------- listing


def list_files(manifest: DataFrame) -> DataFrame:
    """Regular files of a manifest ``(project, root, path, is_regular, mode)`` as relative paths."""
    relative = F.substr("path", F.length("root") + 2)
    return (
        manifest.filter("is_regular")
        .withColumn("filename", relative)
        .filter(paths.first_component(F.col("filename")) != VCS_DIRECTORY)
        .drop("root", "path", "is_regular")
    )


def split_readable(listing: DataFrame) -> DataFrame:
    """Flag regular files that everybody may read; the others are reported, not analysed."""
    readable = F.col("is_regular") & (F.col("mode").bitwiseAND(OTHERS_READ) != 0)
    return listing.withColumn("is_readable", readable)


# ---------------------------------------------------------------- exclusion rules


def effective_rules(rules: DataFrame, local_config: DataFrame) -> DataFrame:
    """Default-ignore regexes hold only for projects without a local configuration."""
    regexes = rules.filter("kind = 'regex'").join(local_config.select("project").distinct(), "project", "left_anti")
    return rules.filter("kind <> 'regex'").unionByName(regexes)


def _values(kind: str, value: Column | None = None) -> Column:
    value = F.col("value") if value is None else value
    return F.collect_set(F.when(F.col("kind") == kind, value))


#: Regexes that are tried together, as one alternation.
CHUNK = 64
#: Rules of a depth that are broadcast: the bytes of their strings and of their rows.
BROADCAST_BYTES = 8 << 20
ROW_BYTES = 64
_EXTENSION, _ANY = 0, -1
_INDEX = ["project", "kind", "depth", "key", "regex"]
# Back references, quotations, named groups and comments mean something else, or nothing, beside other regexes.
_ALONE = r"\\[1-9kQE]|\(\?<[A-Za-z]|\(\?[a-z-]*x"


def _rule_regexes(rules: DataFrame) -> DataFrame:
    """Global and tool rules with their ``regex``, null for paths, and whether it is ``usable``."""
    regex = F.when(F.col("kind") == "glob", globs.glob_to_regex(F.col("value"))).when(F.col("kind") == "regex", F.col("value"))
    usable = regexes.is_usable(globs.whole(F.col("regex")))
    return rules.withColumn("regex", regex).withColumn("usable", (F.col("kind") == "path") | usable)


def broken_rules(rules: DataFrame) -> DataFrame:
    """(project, scope, tool, kind, value, error) of the rules that can't be used; all others hold without them."""
    error = F.concat(F.lit("Broken "), "kind", F.lit(" "), F.coalesce("value", F.lit("")))
    broken = _rule_regexes(rules).filter(~F.col("usable"))
    return broken.select("project", "scope", "tool", "kind", "value", error.alias("error"))


def rule_index(rules: DataFrame) -> DataFrame:
    """Global rules by what a file must share with them: ``(project, kind, depth, key, regex)``.

    ``depth`` components of a file's path are ``key``: an ignored path, without regex, or the directory in front of a
    glob's first special character. At depth 0 the key is the extension a glob ends with, at -1 there is none. Up to
    about ``CHUNK`` regexes of a key are tried together; those that can't stand beside others are rows of their own, and
    broken ones are left out, see :func:`broken_rules`.

    Every function that takes ``rules`` also takes this index, so that it can be staged and reused; the
    same holds for :func:`tool_rule_profile` and :func:`extension_profile`.
    """
    if "depth" in rules.columns:
        return rules
    usable = _rule_regexes(rules.filter("scope = 'global'")).filter("usable").select("project", "kind", "value", "regex").distinct()
    value, is_glob = F.col("value"), F.col("kind") == "glob"
    directory = F.when(is_glob, F.regexp_extract("value", r"^([^*?\[\]{}\\]+)/", 1)).otherwise("")
    extension = F.when(is_glob, F.regexp_extract("value", r"\.([A-Za-z0-9_]+)$", 1)).otherwise("")
    key = F.when(F.col("kind") == "path", value).when(directory != "", directory).otherwise(extension)
    is_dir = (F.col("kind") == "path") | (directory != "")
    components = F.length("key") - F.length(F.replace("key", F.lit("/"), F.lit(""))) + 1
    keyed = usable.withColumn("key", key).withColumn(
        "depth", F.when(is_dir, components).when(F.col("key") != "", _EXTENSION).otherwise(_ANY).cast("int")
    )
    places = ["project", "kind", "depth", "key"]
    alone = keyed.withColumn("_alone", value.rlike(_ALONE) & ~is_glob)
    sizes = alone.filter("not _alone").groupBy(*places).agg(F.ceil(F.count("*") / CHUNK).alias("_chunks"))
    chunk = F.when(~F.col("_alone"), F.pmod(F.xxhash64("regex"), F.col("_chunks")))
    chunked = alone.join(sizes, places, "left").withColumn("_own", F.when(F.col("_alone"), F.col("regex"))).withColumn("_chunk", chunk)
    return chunked.groupBy(*places, "_chunk", "_own").agg(globs.any_of(F.collect_set("regex")).alias("regex")).select(*_INDEX)


def _without(files: DataFrame, rules: DataFrame, *kinds: str) -> DataFrame:
    """Files that no rule of these kinds hits: one anti join per depth at which there are rules.

    Depths come to the driver with their sizes; there are no more of them than components in the longest rule. Rules of a
    depth are broadcast once if they are measured to be small, else merged with the files, in copies that spread hot keys.
    """
    index = rules if "depth" in rules.columns else stage(rule_index(rules.filter(F.col("kind").isin(*kinds))), "rule-index")
    index = index.filter(F.col("kind").isin(*kinds))
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in ("project", "key", "regex")), F.lit(ROW_BYTES))
    depths = sorted(map(tuple, index.groupBy("depth").agg(F.sum(size)).collect()))
    filename = files["filename"]
    for depth, n_bytes in depths:
        salts = 1 if n_bytes <= BROADCAST_BYTES else salt_count(files.sparkSession)
        here = index.filter(F.col("depth") == depth).select(
            F.col("project").alias("_project"), F.col("key").alias("_key"), F.col("regex").alias("_regex"),
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"),
        ).hint("broadcast" if n_bytes <= BROADCAST_BYTES else "merge")
        hit = (files["project"] == F.col("_project")) & (F.pmod(F.xxhash64(filename), F.lit(salts)) == F.col("_salt"))
        if depth != _ANY:
            part = F.substring_index(filename, ".", -1) if depth == _EXTENSION else F.substring_index(filename, "/", depth)
            hit = hit & (part == F.col("_key"))
        files = files.join(here, hit & (F.col("_regex").isNull() | globs.matches(filename, F.col("_regex"))), "left_anti")
        filename = files["filename"]
    return files


def exclude_globs(files: DataFrame, rules: DataFrame) -> DataFrame:
    return _without(files, rules, "glob")


def exclude_paths(files: DataFrame, rules: DataFrame) -> DataFrame:
    """Drop files equal to or below an ignored path, compared by whole components."""
    return _without(files, rules, "path")


def exclude_regex(files: DataFrame, rules: DataFrame) -> DataFrame:
    """Drop files whose whole path matches a default-ignore regex."""
    return _without(files, rules, "regex")


def filter_global(files: DataFrame, rules: DataFrame) -> DataFrame:
    """All three kinds of global rules."""
    return _without(files, rules, "glob", "path", "regex")


def except_files(files: DataFrame, excluded: DataFrame) -> DataFrame:
    return files.join(excluded.select("project", "filename"), ["project", "filename"], "left_anti")


# ---------------------------------------------------------------- languages


def merge_extensions(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Union of two ``(project, language, suffix)`` tables."""
    return local.unionByName(remote).distinct()


def extension_profile(extensions: DataFrame) -> DataFrame:
    """Custom suffixes, one row per project."""
    if "_custom" in extensions.columns:
        return extensions
    return extensions.groupBy("project").agg(F.collect_set(F.struct("suffix", "language")).alias("_custom"))


def detect_languages(
    files: DataFrame, extensions: DataFrame, builtin: Mapping[str, Sequence[str]] = lang.LANGUAGE_SUFFIXES
) -> DataFrame:
    """Adds ``language``: custom suffixes first, then the built-in ones; files without language drop out."""
    filename = F.col("filename")
    profiled = lookup_join(files, extension_profile(extensions), ["project"], spread=["filename"])
    language = F.coalesce(lang.custom_language(filename, F.col("_custom")), lang.builtin_language(filename, builtin))
    return profiled.withColumn("language", language).filter("language is not null").drop("_custom")


def project_languages(detected: DataFrame) -> DataFrame:
    return detected.select("project", "language").distinct()


def with_languages(
    files: DataFrame, extensions: DataFrame, builtin: Mapping[str, Sequence[str]] = lang.LANGUAGE_SUFFIXES
) -> DataFrame:
    """Adds ``languages``: every language one of whose suffixes ends the path (a file can have several)."""
    filename = F.col("filename")
    profiled = lookup_join(files, extension_profile(extensions), ["project"], spread=["filename"])
    both = F.array_union(lang.custom_languages(filename, F.col("_custom")), lang.builtin_languages(filename, builtin))
    return profiled.withColumn("languages", both).drop("_custom")


def filter_language(
    files: DataFrame,
    extensions: DataFrame,
    language: str,
    builtin: Mapping[str, Sequence[str]] = lang.LANGUAGE_SUFFIXES,
) -> DataFrame:
    return (
        with_languages(files, extensions, builtin)
        .filter(F.array_contains("languages", language))
        .select(*files.columns)
    )


# ---------------------------------------------------------------- files of a tool run


def tool_rule_profile(rules: DataFrame) -> DataFrame:
    """Per-tool globs, one row per (project, rule_tool)."""
    if "_tool_globs" in rules.columns:
        return rules
    usable = _rule_regexes(rules.filter("scope = 'tool' and kind = 'glob'")).filter("usable")
    return usable.groupBy("project", F.col("tool").alias("rule_tool")).agg(globs.any_of(F.collect_set("regex")).alias("_tool_globs"))


def filter_tool(
    runs: DataFrame,
    files: DataFrame,
    rules: DataFrame,
    extensions: DataFrame,
    builtin: Mapping[str, Sequence[str]] = lang.LANGUAGE_SUFFIXES,
) -> DataFrame:
    """Files of each run: of its language and not excluded for its tool.

    Per-tool rules name issue tools by tool, the others by kind (``metrics``, ``duplication``).
    """
    spoken = with_languages(files, extensions, builtin).withColumn("language", F.explode("languages")).drop("languages")
    planned = lookup_join(spoken, runs, ["project", "language"], spread=["filename"], how="inner")
    named = planned.withColumn("rule_tool", F.when(F.col("kind") == "issues", F.col("tool")).otherwise(F.col("kind")))
    ruled = lookup_join(named, tool_rule_profile(rules), ["project", "rule_tool"], spread=["filename"])
    kept = ruled.filter(~globs.matches(F.col("filename"), F.col("_tool_globs")))
    return kept.select(*runs.columns, *[c for c in files.columns if c not in runs.columns])


def has_config_files(files: DataFrame, tools: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per (project, tool) of ``pairs``: is a configuration file of the tool among the readable files.

    ``files`` is the listing before any exclusion. Files meet configuration names on their last
    component, so each file stays one row.
    """
    wanted = (
        tools.filter("has_config_file")
        .select("tool", F.explode("config_filenames").alias("_config"))
        .distinct()
        .withColumn("_base", paths.basename(F.col("_config")))
    )
    based = (
        files.filter("is_readable").select("project", "filename").withColumn("_base", paths.basename(F.col("filename")))
    )
    found = (
        lookup_join(based, wanted, ["_base"], spread=["project", "filename"], how="inner")
        .filter(paths.ends_with_path(F.col("filename"), F.col("_config")))
        .select("project", "tool")
        .distinct()
        .withColumn("_found", F.lit(True))
    )
    keyed = pairs.select("project", "tool").distinct()
    return keyed.join(found, ["project", "tool"], "left").select(
        "project", "tool", F.coalesce("_found", F.lit(False)).alias("has_config_files")
    )
