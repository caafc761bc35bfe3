"""Tool and pattern catalogs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lintlake.functions import languages as lang, text
from lintlake.functions.scale import catalog_join

# Severity levels, categories and sub-categories a pattern may carry.
LEVELS = ["Info", "Warning", "High", "Error"]
CATEGORIES = [
    "BestPractice", "CodeStyle", "Compatibility", "Complexity", "Comprehensibility", "Documentation",
    "Duplication", "ErrorProne", "Performance", "Security", "UnusedCode",
]
SUBCATEGORIES = [
    "Android", "Auth", "CommandInjection", "Cookies", "Cryptography", "CSRF", "DoS", "FileAccess", "FirefoxOS",
    "HTTP", "InputValidation", "InsecureModulesLibraries", "InsecureStorage", "MaliciousCode", "MassAssignment",
    "Other", "Regex", "Routes", "SQLInjection", "SSL", "UnexpectedBehaviour", "Visibility", "XSS",
]


def prefer(first: DataFrame, second: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows of ``first``, and those of ``second`` whose key ``first`` does not have."""
    rest = catalog_join(second, first.select(*key).distinct(), key, how="left_anti")
    return first.unionByName(rest.select(*second.columns))


def tools_with_fallback(fetched: DataFrame, saved: DataFrame) -> DataFrame:
    """Freshly fetched tools, falling back to the saved ones."""
    return prefer(fetched, saved, ["uuid"])


def patterns_with_fallback(fetched: DataFrame, saved: DataFrame) -> DataFrame:
    """Saved patterns of a tool version, falling back to the fetched ones."""
    return prefer(saved, fetched, ["uuid", "version"])


def normalize_tools(raw: DataFrame, vocabulary: Sequence[str] = tuple(lang.LANGUAGE_SUFFIXES)) -> DataFrame:
    return (
        raw.withColumn("languages", lang.known_languages(F.col("languages"), vocabulary))
        .withColumn("prefix", F.coalesce("prefix", F.lit("")))
        .withColumn("has_config_file", F.size("config_filenames") > 0)
    )


def normalize_patterns(
    raw: DataFrame, tools: DataFrame, vocabulary: Sequence[str] = tuple(lang.LANGUAGE_SUFFIXES)
) -> DataFrame:
    """Strip the tool prefix from ids; a missing title becomes the id as delivered."""
    prefixes = tools.select("uuid", F.col("prefix").alias("_prefix"))
    joined = catalog_join(raw, prefixes, ["uuid"], how="inner")
    return joined.select(
        *[c for c in raw.columns if c not in ("id", "title", "languages")],
        text.strip_prefix(F.col("id"), F.col("_prefix")).alias("id"),
        F.coalesce("title", "id").alias("title"),
        lang.known_languages(F.coalesce("languages", F.array().cast("array<string>")), vocabulary).alias("languages"),
    )


def supported_tools(tools: DataFrame) -> DataFrame:
    return tools.filter(~F.col("standalone"))


def find_tool(requests: DataFrame, tools: DataFrame) -> DataFrame:
    """Tool by short name or uuid, ignoring case; the earliest catalog row wins.

    ``requests (request_id, query)`` gain ``uuid`` and ``status`` found, unknown or standalone.
    """
    names = F.array_distinct(F.array(F.lower("short_name"), F.lower("uuid")))
    keyed = tools.select(F.explode(names).alias("_key"), "position", "uuid", "standalone")
    earliest = keyed.groupBy("_key").agg(F.min_by(F.struct("uuid", "standalone"), "position").alias("_tool"))
    asked = requests.withColumn("_key", F.lower("query"))
    joined = catalog_join(asked, earliest, ["_key"])
    status = (
        F.when(F.col("_tool").isNull(), F.lit("unknown"))
        .when(F.col("_tool.standalone"), F.lit("standalone"))
        .otherwise(F.lit("found"))
    )
    found = joined.withColumn("status", status)
    return found.select("request_id", "query", F.when(F.col("status") == "found", F.col("_tool.uuid")).alias("uuid"), "status")


def tool_patterns(tools: DataFrame, patterns: DataFrame) -> DataFrame:
    """Every tool with its patterns (none: one row without pattern)."""
    own = patterns.drop("version").withColumnRenamed("languages", "pattern_languages")
    known = catalog_join(own, tools, ["uuid"], how="inner")
    bare = catalog_join(tools, patterns.select("uuid").distinct(), ["uuid"], how="left_anti")
    return known.unionByName(bare, allowMissingColumns=True)


def pattern_specifications(patterns: DataFrame) -> DataFrame:
    """What a tool needs to run its patterns."""
    defaults = F.transform("parameters", lambda p: F.struct(p["name"].alias("name"), p["default"].alias("default")))
    return patterns.select(
        "uuid", "id", "level", "category", "sub_category", defaults.alias("parameters"), "languages", "enabled"
    )


def pattern_descriptions(patterns: DataFrame) -> DataFrame:
    """What a reader needs to understand the patterns; only described parameters are listed."""
    described = F.filter("parameters", lambda p: p["description"].isNotNull())
    return patterns.select(
        "uuid", "id", "title", "description", "explanation", "time_to_fix",
        F.transform(described, lambda p: F.struct(p["name"].alias("name"), p["description"].alias("description"))).alias("parameters"),
    )


def parameter_map(parameters: Column, value: str = "default") -> Column:
    return F.map_from_entries(F.transform(parameters, lambda p: F.struct(p["name"], p[value])))


def check_vocabulary(patterns: DataFrame, strict: bool = False) -> DataFrame:
    """Patterns whose level, category or sub-category is not a known name, one row per violation."""

    def check(field: str, known: Sequence[str]) -> Column:
        bad = F.col(field).isNotNull() & ~F.col(field).isin(*known)
        if field != "sub_category":
            bad = bad | F.col(field).isNull()
        return F.when(bad, F.struct(F.lit(field).alias("field"), F.col(field).alias("value")))

    checks = F.array(check("level", LEVELS), check("category", CATEGORIES), check("sub_category", SUBCATEGORIES))
    found = patterns.select("uuid", "id", F.explode(F.array_compact(checks)).alias("_v"))
    if strict:
        message = F.concat(F.lit("unknown "), F.col("_v.field"), F.lit(": "), F.coalesce("_v.value", F.lit("null")))
        return found.select("uuid", "id", F.raise_error(message).alias("error"))
    return found.select("uuid", "id", "_v.field", "_v.value")
