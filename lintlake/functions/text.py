"""String expressions. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
DEFAULT_ERROR_MESSAGE = "Failed to analyze file."
UNKNOWN_VERSION = "0.0.0-unknown"

# A line counts when it has at least three UTF-16 units after trimming all characters up to U+0020. Each
# alternative spans from the first to the last visible character of one line, so a counted line matches
# exactly once. The last two are lines of two characters, one of them outside the basic plane (two units).
_LOC_LINE = (
    r"[^\x00-\x20][^\r\n]+[^\x00-\x20]"
    r"|[\x{10000}-\x{10FFFF}][^\x00-\x20]"
    r"|[^\x00-\x20][\x{10000}-\x{10FFFF}]"
)


def unix_newlines(text: Column) -> Column:
    """The text with ``\\n`` as only line terminator and none at the end."""
    plain = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.when(F.endswith(plain, F.lit("\n")), F.substr(plain, F.lit(1), F.length(plain) - 1)).otherwise(plain)


def split_lines(text: Column) -> Column:
    """Lines of a text; a final line terminator does not open another line.

    Splitting on one plain character takes a path without regex.
    """
    return F.split(unix_newlines(text), "\n", -1)


# White space within a line that collapsing changes: anything but a single space.
_RUNS = r"[\x00-\x09\x0b-\x20](?:[\x00-\x09\x0b-\x20]+|(?<! ))"


def normalize_lines(text: Column) -> Column:
    """The text with every line trimmed and its white space collapsed, so re-indented copies compare equal."""
    collapsed = F.regexp_replace(unix_newlines(text), _RUNS, " ")
    left = F.replace(collapsed, F.lit(" \n"), F.lit("\n"))
    return F.trim(F.replace(left, F.lit("\n "), F.lit("\n")))


def count_loc(text: Column) -> Column:
    """Lines of at least three characters after trimming; null text (unreadable file) gives null."""
    return F.regexp_count(text, F.lit(_LOC_LINE))


def strip_prefix(col: Column, prefix: Column) -> Column:
    """Remove a literal prefix once, if present; a null prefix leaves the value alone."""
    return F.when(F.startswith(col, prefix), F.substr(col, F.length(prefix) + 1)).otherwise(col)


def append_sub_directory(sub_directory: Column, filename: Column) -> Column:
    return F.when(sub_directory.isNull(), filename).otherwise(F.concat(sub_directory, F.lit("/"), filename))


def remove_sub_directory(sub_directory: Column, filename: Column) -> Column:
    inner = strip_prefix(strip_prefix(filename, sub_directory), F.lit("/"))
    return F.when(sub_directory.isNull(), filename).otherwise(inner)


def fingerprint(filename: Column, pattern_id: Column, line_text: Column) -> Column:
    """MD5 of file, pattern and the line without white space, as a number in base 16 (no leading zeros)."""
    squeezed = F.regexp_replace(line_text, r"\s", "")
    return F.regexp_replace(F.md5(F.concat(filename, pattern_id, squeezed)), "^0+(?=.)", "")


def location_text(line: Column, column: Column) -> Column:
    return F.concat_ws(":", line.cast("string"), column.cast("string"))


def capitalize(col: Column) -> Column:
    """Upper-case the first character only (``initcap`` would lower-case the others)."""
    return F.concat(F.upper(F.substr(col, F.lit(1), F.lit(1))), F.substr(col, F.lit(2)))


def tool_label(name: Column, suffix: str = "") -> Column:
    return F.concat(capitalize(name), F.lit(suffix))


def tool_version(version: Column) -> Column:
    return F.coalesce(F.regexp_replace(version, "^v", ""), F.lit(UNKNOWN_VERSION))


def error_message(message: Column) -> Column:
    return F.coalesce(message, F.lit(DEFAULT_ERROR_MESSAGE))
