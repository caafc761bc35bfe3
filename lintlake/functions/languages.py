"""Language vocabulary and detection by file name suffix."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Languages with their file suffixes and special file names. A suffix is compared as plain
# text at the end of the path, also for whole file names.
LANGUAGE_SUFFIXES: dict[str, list[str]] = {
    "Apex": [".cls", ".trigger"],
    "C": [".c", ".h"],
    "CPP": [".cpp", ".hpp", ".cc", ".cxx", ".hxx"],
    "CSS": [".css"],
    "CSharp": [".cs"],
    "CoffeeScript": [".coffee"],
    "Crystal": [".cr"],
    "Dart": [".dart"],
    "Dockerfile": ["Dockerfile", ".dockerfile"],
    "Elixir": [".ex", ".exs"],
    "Go": [".go"],
    "Groovy": [".groovy"],
    "HTML": [".html", ".htm"],
    "JSON": [".json"],
    "JSP": [".jsp"],
    "Java": [".java"],
    "Javascript": [".js", ".jsx", ".mjs", ".vue"],
    "Julia": [".jl"],
    "Kotlin": [".kt", ".kts"],
    "LESS": [".less"],
    "Lua": [".lua"],
    "Markdown": [".md", ".markdown"],
    "ObjectiveC": [".m"],
    "PHP": [".php"],
    "PLSQL": [".trg", ".prc", ".fnc", ".pld", ".pls", ".plh", ".plb", ".pck", ".pks", ".pkh", ".pkb"],
    "Perl": [".pl", ".pm"],
    "Powershell": [".ps1", ".psc1", ".psd1", ".psm1"],
    "Python": [".py"],
    "Ruby": [".rb", ".gemspec", ".podspec", ".jbuilder", ".rake", ".opal", "Gemfile", "Rakefile"],
    "Rust": [".rs", ".rlib"],
    "SASS": [".scss", ".sass"],
    "SQL": [".sql"],
    "Scala": [".scala"],
    "Shell": [".sh", ".bash"],
    "Swift": [".swift"],
    "TypeScript": [".ts", ".tsx"],
    "VisualForce": [".component", ".page"],
    "VisualBasic": [".vb"],
    "XML": [".xml", ".xsl", ".wsdl", ".pom"],
    "YAML": [".yaml", ".yml"],
}


def known_languages(languages: Column, vocabulary: Sequence[str] = tuple(LANGUAGE_SUFFIXES)) -> Column:
    """Drop names outside the vocabulary (and repeats)."""
    return F.array_intersect(languages, F.expr(f"array({', '.join(map(_quoted, vocabulary))})"))


def _simple(suffix: str) -> bool:
    """A dot and a word: ends a path exactly if it is what follows the path's last dot."""
    return suffix.startswith(".") and "." not in suffix[1:] and "/" not in suffix


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _literal_map(entries: Mapping[str, str]) -> Column:
    """A constant map from strings to SQL expressions, parsed in one go."""
    return F.expr("map(" + ", ".join(f"{_quoted(key)}, {value}" for key, value in entries.items()) + ")")


def _after_last_dot(path: Column) -> Column:
    return F.concat(F.lit("."), F.substring_index(path, ".", -1))


def _others(suffixes: Mapping[str, Sequence[str]]) -> list[tuple[str, str]]:
    return [(s, name) for name, ss in sorted(suffixes.items()) for s in ss if not _simple(s)]


def builtin_language(path: Column, suffixes: Mapping[str, Sequence[str]] = LANGUAGE_SUFFIXES) -> Column:
    """The language with the longest matching suffix, ties by language name; null if none matches.

    Plain extensions are one lookup in a constant map, only the other suffixes are tested one by one.
    """

    def rank(suffix: str, name: str) -> Column:
        return F.struct(F.lit(-len(suffix)).alias("n"), F.lit(name).alias("language"))

    by_extension: dict[str, str] = {}
    for name, ss in sorted(suffixes.items(), reverse=True):
        by_extension.update({s: f"struct({-len(s)} as n, {_quoted(name)} as language)" for s in ss if _simple(s)})
    hits = [F.when(F.endswith(path, F.lit(s)), rank(s, name)) for s, name in _others(suffixes)]
    if by_extension:
        hits.append(F.when(F.contains(path, F.lit(".")), F.try_element_at(_literal_map(by_extension), _after_last_dot(path))))
    return F.array_min(F.array(*hits))["language"]


def builtin_languages(path: Column, suffixes: Mapping[str, Sequence[str]] = LANGUAGE_SUFFIXES) -> Column:
    """Every language with a matching suffix."""
    by_extension: dict[str, list[str]] = {}
    for name, ss in sorted(suffixes.items()):
        for s in filter(_simple, ss):
            by_extension.setdefault(s, []).append(name)
    others = [F.when(F.endswith(path, F.lit(s)), F.lit(name)) for s, name in _others(suffixes)]
    found = F.array_compact(F.array(*others)) if others else F.array().cast("array<string>")
    if not by_extension:
        return F.array_distinct(found)
    lists = _literal_map({s: f"array({', '.join(map(_quoted, names))})" for s, names in by_extension.items()})
    extended = F.when(F.contains(path, F.lit(".")), F.try_element_at(lists, _after_last_dot(path)))
    return F.array_union(F.coalesce(extended, F.array().cast("array<string>")), found)


def custom_language(path: Column, custom: Column) -> Column:
    """Like :func:`builtin_language` for an array of (suffix, language) structs."""
    hits = F.filter(custom, lambda c: F.endswith(path, c["suffix"]))
    ranked = F.array_sort(F.transform(hits, lambda c: F.struct((-F.length(c["suffix"])).alias("n"), c["language"].alias("language"))))
    return F.get(ranked, F.lit(0))["language"]


def custom_languages(path: Column, custom: Column) -> Column:
    hits = F.filter(custom, lambda c: F.endswith(path, c["suffix"]))
    return F.coalesce(F.transform(hits, lambda c: c["language"]), F.array().cast("array<string>"))
