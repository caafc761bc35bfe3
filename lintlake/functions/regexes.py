"""What can be told about a regular expression without running it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_ESCAPED = set("tnrfaedDsSwWbBAzZGhHvVR")


def is_usable(regex: Column) -> Column:
    """Whether the regex compiles; false for null. The engine that will run it decides, row by row."""
    return F.call_function("try_reflect", F.lit("java.util.regex.Pattern"), F.lit("compile"), regex).isNotNull()


class _Unknown(Exception):
    """The syntax is beyond the reader: nothing is known about the regex."""


class _Reader:
    """Reads alternatives and sequences; of each sequence it keeps the longest run of characters that must occur.

    An alternative is known by a set of strings one of which must occur, None if there may be none.
    """

    def __init__(self, regex: str) -> None:
        self.regex, self.at = regex, 0

    def peek(self) -> str:
        return self.regex[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.regex[self.at - 1 : self.at]

    def alternatives(self) -> list[str] | None:
        found: list[str] | None = []
        while True:
            branch = self.sequence()
            found = None if found is None or branch is None else found + branch
            if self.peek() != "|":
                return found
            self.take()

    def sequence(self) -> list[str] | None:
        choices: list[list[str]] = []  # each a set of strings one of which must occur
        run = ""
        while self.peek() not in ("", "|", ")"):
            char, group = self.atom()
            least = self.quantifier()
            if char is not None and least is None:
                run += char
                continue
            if char is not None and least:  # once at least, and nothing is known about what follows it
                run += char
            choices.append([run])
            run = ""
            if group is not None and least != 0:
                choices.append(group)
        choices.append([run])
        usable = [c for c in choices if all(c)]
        return max(usable, key=lambda c: (min(map(len, c)), -len(c))) if usable else None

    def quantifier(self) -> int | None:
        """The least number of repetitions, None without a quantifier."""
        least = None
        if self.peek() in ("?", "*"):
            least = 0
        elif self.peek() == "+":
            least = 1
        elif self.peek() == "{":
            end = self.regex.find("}", self.at)
            number = self.regex[self.at + 1 : end].split(",")[0].strip()
            if end < 0 or not number.isdigit():
                raise _Unknown
            least, self.at = min(int(number), 1), end
        if least is not None:
            self.take()
            if self.peek() in ("?", "+"):
                self.take()
            if self.peek() in ("?", "*", "+", "{"):
                raise _Unknown
        return least

    def atom(self) -> tuple[str | None, list[str] | None]:
        """A character that must occur here, or what is known of a group; neither for anything else."""
        char = self.take()
        if char == "(":
            return None, self.group()
        if char == "[":
            self.skip_class()
            return None, None
        if char == "\\":
            escaped = self.take()
            if escaped.isalnum():
                if escaped not in _ESCAPED:
                    raise _Unknown
                return None, None
            char = escaped
        elif char in ".^$":
            return None, None
        if not char or not char.isascii():
            return None, None
        return char.lower(), None

    def skip_class(self) -> None:
        if self.peek() == "^":
            self.take()
        if self.peek() == "]":
            raise _Unknown
        while (char := self.take()) != "]":
            if char in ("", "[") or (char == "&" and self.peek() == "&"):
                raise _Unknown
            if char == "\\":
                escaped = self.take()
                if escaped.isalnum() and escaped not in _ESCAPED or not escaped:
                    raise _Unknown

    def group(self) -> list[str] | None:
        known = True
        if self.peek() == "?":
            self.take()
            kind = self.take()
            if kind == "<" and self.peek() not in ("=", "!"):
                while self.take() not in (">", ""):
                    pass
            elif kind in ("=", "!", "<"):
                known = False
                if kind == "<":
                    self.take()
            elif kind and kind in "imsd":
                while self.peek() and self.peek() in "imsd":
                    self.take()
                if self.peek() == ")":
                    self.take()
                    return None
                if self.take() != ":":
                    raise _Unknown
            elif kind not in (":", ">"):
                raise _Unknown
        found = self.alternatives()
        if self.take() != ")":
            raise _Unknown
        return found if known else None


def required_literals(regex: str | None) -> list[str]:
    """ASCII strings in lower case, one of which every match contains, whatever the case.

    Empty if nothing is known: also for all syntax that the reader does not know.
    """
    reader = _Reader(regex or "")
    try:
        found = reader.alternatives()
    except (_Unknown, RecursionError):
        return []
    return list(dict.fromkeys(found or [])) if reader.at >= len(reader.regex) else []
