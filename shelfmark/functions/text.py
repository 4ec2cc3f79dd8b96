"""Text expressions (F1-F9, F15), as SQL text.

Every function takes the SQL text of an expression and returns SQL text; an
operator hands the finished texts to ``selectExpr``. Building a column call by
call costs a round trip to the JVM per call, which a micro-batch pays each time.
"""

from __future__ import annotations

from shelfmark.schema import MISSING

# Every character that counts as blank at the ends of a text, not only U+0020.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def lit(text: str) -> str:
    """A text as an SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


_BLANKS = lit(WHITESPACE)
_SPACES = lit(" " * len(WHITESPACE))


def strip(c: str) -> str:
    """Remove blanks of any kind at both ends (F1)."""
    return f"btrim({c}, {_BLANKS})"


def blank_to_null(c: str) -> str:
    """Empty text counts as not given."""
    return f"nullif({c}, '')"


def or_missing(*choices: str) -> str:
    """The first choice that is neither null nor empty, else MISSING."""
    return f"coalesce({', '.join(map(blank_to_null, choices))}, {lit(MISSING)})"


def given(c: str) -> str:
    """MISSING where the value is null; an empty text stays."""
    return f"coalesce({c}, {lit(MISSING)})"


def remove(c: str, *parts: str) -> str:
    """Remove literal parts, one after the other in the order given."""
    for part in parts:
        c = f"replace({c}, {lit(part)}, '')"
    return c


def _spaced(c: str) -> str:
    """Stripped text with every blank inside made a plain space."""
    return f"translate({strip(c)}, {_BLANKS}, {_SPACES})"


def first_token(c: str) -> str:
    """First blank-separated token; null for blank text."""
    return blank_to_null(f"substring_index({_spaced(c)}, ' ', 1)")


def last_token(c: str) -> str:
    """Last blank-separated token; null for blank text."""
    return blank_to_null(f"substring_index({_spaced(c)}, ' ', -1)")


def after_last(c: str, mark: str) -> str:
    """Text after the last ``mark``, or the whole text without one."""
    return f"substring_index({c}, {lit(mark)}, -1)"


def before_first(c: str, mark: str) -> str:
    """Text before the first ``mark``, or the whole text without one."""
    return f"substring_index({c}, {lit(mark)}, 1)"


def money(c: str) -> str:
    """A price text without currency sign and thousands commas."""
    return strip(f"translate({c}, '₫,', '')")


def reasons(rules: list[tuple[str, str]]) -> str:
    """Array of the names whose condition holds, in the order given."""
    if not rules:
        return "CAST(array() AS array<string>)"
    named = [f"CASE WHEN {test} THEN {lit(name)} END" for name, test in rules]
    return f"array_compact(array({', '.join(named)}))"
