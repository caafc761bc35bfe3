"""File globs as regular expressions, compiled by Spark expressions over a rules table.

Semantics: ``*`` and ``?`` stay within one path component, ``**`` crosses components, ``{a,b}`` is a
choice, ``[...]`` a class that never matches ``/``, a backslash takes the next character literally.
``**/x`` needs at least one directory and a pattern ending in ``/`` matches no file.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_GLOB_TOKEN = r"(?s)\\.|\*\*|\*|\?|\[[^\]]+\]|\{[^{}]*\}|."
_CHOICE_TOKEN = r"(?s)\\.|\*\*|\*|\?|\[[^\]]+\]|."
_REGEX_META = r"([.^$|+*?(){}\[\]\\])"


def _char_class(token: Column) -> Column:
    inner = F.substr(token, F.lit(2), F.length(token) - 2)
    negated = F.startswith(inner, F.lit("!"))
    members = F.regexp_replace(F.when(negated, F.substr(inner, F.lit(2))).otherwise(inner), r"[\\\[^&]", r"\\$0")
    return F.concat(F.when(negated, F.lit("(?!/)[^")).otherwise(F.lit("(?!/)[")), members, F.lit("]"))


def _simple_token(token: Column) -> Column:
    escaped = F.when(F.startswith(token, F.lit("\\")) & (F.length(token) == 2), F.substr(token, F.lit(2))).otherwise(token)
    return (
        F.when(token == "**", F.lit(".*"))
        .when(token == "*", F.lit("[^/]*"))
        .when(token == "?", F.lit("[^/]"))
        .when(F.startswith(token, F.lit("[")) & (F.length(token) > 1), _char_class(token))
        .otherwise(F.regexp_replace(escaped, _REGEX_META, r"\\$1"))
    )


def _choice(token: Column) -> Column:
    inner = F.substr(token, F.lit(2), F.length(token) - 2)
    parts = F.transform(
        F.regexp_extract_all(inner, F.lit(_CHOICE_TOKEN), F.lit(0)),
        lambda t: F.when(t == ",", F.lit("|")).otherwise(_simple_token(t)),
    )
    return F.concat(F.lit("(?:"), F.array_join(parts, ""), F.lit(")"))


def glob_to_regex(glob: Column) -> Column:
    """Regular expression equivalent to a glob, without anchors."""
    parts = F.transform(
        F.regexp_extract_all(glob, F.lit(_GLOB_TOKEN), F.lit(0)),
        lambda t: F.when(F.startswith(t, F.lit("{")) & (F.length(t) > 1), _choice(t)).otherwise(_simple_token(t)),
    )
    return F.array_join(parts, "")


def whole(regex: Column) -> Column:
    """A regex that has to match a whole value, as :func:`any_of` writes it for one regex."""
    return F.concat(F.lit("^(?:(?:"), regex, F.lit(r"))\z"))


def any_of(regexes: Column) -> Column:
    """One anchored alternation for an array of regexes; null for an empty array."""
    wrapped = F.transform(regexes, lambda r: F.concat(F.lit("(?:"), r, F.lit(")")))
    return F.when(F.size(regexes) > 0, F.concat(F.lit("^(?:"), F.array_join(F.array_sort(wrapped), "|"), F.lit(r")\z")))


def matches(value: Column, pattern: Column) -> Column:
    """Whether a pattern held in a column is found; false for a null pattern.

    ``rlike`` compiles a non-literal pattern for every row. ``regexp_instr`` keeps the compiled pattern
    until the value changes, which here is once per project.
    """
    return F.coalesce(F.regexp_instr(value, pattern) > 0, F.lit(False))
