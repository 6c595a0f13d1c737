"""Shell-style exclusion rules.

A rule is matched against the *basename* of a path and must match it whole.
Rules are configuration: a short list turned on the driver into one regular
expression that both the JVM (``rlike``) and RE2 (DuckDB) understand.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from .paths import basename

# The default rule list a new user starts with, in the order given there.
DEFAULT_RULES = [
    "*.ipch",
    "*.pdb",
    "*.ilk",
    "*.tlog",
    "*.vc.db",
    "*.pyc",
    "*.lnk",
    "Thumbs.db",
    "*.vs",
    "__pycache__",
    "~$*",
]

_ESCAPE = set(string.punctuation) - {"_"}


def _escape(ch: str) -> str:
    return "\\" + ch if ch in _ESCAPE else ch


def glob_to_regex(glob: str) -> str:
    """Translate one shell glob to an unanchored regex body.

    ``*`` any run (separators included, as for a basename), ``?`` one char,
    ``[abc]`` / ``[!abc]`` a class; everything else is literal. An unclosed
    ``[`` is a literal bracket.
    """
    out: list[str] = []
    i, n = 0, len(glob)
    while i < n:
        ch = glob[i]
        i += 1
        if ch == "*":
            while i < n and glob[i] == "*":
                i += 1
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[":
            j = i
            if j < n and glob[j] == "!":
                j += 1
            if j < n and glob[j] == "]":
                j += 1
            while j < n and glob[j] != "]":
                j += 1
            if j >= n:
                out.append("\\[")
                continue
            body = glob[i:j]
            i = j + 1
            negate = body.startswith("!")
            if negate:
                body = body[1:]
            members = []
            k = 0
            while k < len(body):
                if k + 2 < len(body) and body[k + 1] == "-":
                    members.append(_escape(body[k]) + "-" + _escape(body[k + 2]))
                    k += 3
                else:
                    members.append(_escape(body[k]))
                    k += 1
            out.append("[" + ("^" if negate else "") + "".join(members) + "]")
        else:
            out.append(_escape(ch))
    return "(?s:" + "".join(out) + ")"


def rules_regex(rules) -> str | None:
    """One anchored pattern for a list of globs; ``None`` when the list is empty.

    ``\\A`` / ``\\z`` anchor the whole string: ``\\Z`` or ``$`` would let a
    trailing newline through.
    """
    rules = [r.strip() for r in rules if r and r.strip()]
    if not rules:
        return None
    return "\\A(?:" + "|".join(glob_to_regex(r) for r in rules) + ")\\z"


def match_rules(path_col, rules) -> Column:
    """True when the basename of ``path_col`` fully matches any rule."""
    pattern = rules_regex(rules)
    if pattern is None:
        return F.lit(False)
    return basename(path_col).rlike(pattern)


def name_matches(name_col, rules) -> Column:
    """Like :func:`match_rules` for a column that already holds a basename."""
    pattern = rules_regex(rules)
    if pattern is None:
        return F.lit(False)
    c = F.col(name_col) if isinstance(name_col, str) else name_col
    return c.rlike(pattern)
