"""Path patterns as regular expressions that Spark's rlike can run."""

from __future__ import annotations

import re

from pyspark.sql import Column


def glob_to_regex(glob: str) -> str:
    """A regular expression that matches whole paths as the glob does.

    `*` and `?` match any characters, slashes included; `{a,b}` alternatives, which may be
    nested; `[...]` one character of a set, `[!...]` or `[^...]` one outside of it; a
    backslash takes the next character literally. An unclosed bracket or brace, or a
    trailing backslash, is an error.
    """
    out, braces, i = [], 0, 0
    while i < len(glob):
        c = glob[i]
        i += 1
        if c == "\\":
            if i == len(glob):
                raise ValueError(f"glob ends with a backslash: {glob!r}")
            out.append(re.escape(glob[i]))
            i += 1
        elif c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "{":
            out.append("(?:")
            braces += 1
        elif c == "}" and braces:
            out.append(")")
            braces -= 1
        elif c == "," and braces:
            out.append("|")
        elif c == "[":
            members, i = _set(glob, i)
            out.append(members)
        else:
            out.append(re.escape(c))
    if braces:
        raise ValueError(f"glob has an unclosed brace: {glob!r}")
    return rf"(?s)\A(?:{''.join(out)})\z"


def _set(glob: str, i: int) -> tuple[str, int]:
    start, members = i, []
    negated = i < len(glob) and glob[i] in "!^"
    i += negated
    while i < len(glob) and (glob[i] != "]" or not members):
        if glob[i] == "\\" and i + 1 < len(glob):
            members.append(re.escape(glob[i + 1]))
            i += 2
        else:
            members.append("-" if glob[i] == "-" else re.escape(glob[i]))
            i += 1
    if i >= len(glob):
        raise ValueError(f"glob has an unclosed set at {start - 1}: {glob!r}")
    return f"[{'^' if negated else ''}{''.join(members)}]", i + 1


def matches_glob(path: Column, glob: str) -> Column:
    return path.rlike(glob_to_regex(glob))
