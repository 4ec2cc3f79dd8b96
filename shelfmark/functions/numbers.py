"""Text to number without ever raising (F10-F13), as SQL text.

ANSI mode stays on. ``loose_*`` read what Spark's pre-ANSI cast read and give
null for the rest; ``strict_*`` accept the texts a strict parser would accept.
"""

from __future__ import annotations

from shelfmark.functions.text import lit, remove, strip

_B = r"[\x00-\x20\x7f]*"  # blanks and control characters a cast ignores
_DECIMAL = lit(rf"^{_B}([+-]?)([0-9]*)[.][0-9]*{_B}$")
_DOUBLE = lit(
    rf"(?i)^{_B}[+-]?(nan|inf(inity)?|([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?[df]?"
    rf"|0x[0-9a-f]*[.]?[0-9a-f]*p[+-]?[0-9]+[df]?){_B}$"
)
_STRICT_INT = lit(r"^[+-]?[0-9]+(_[0-9]+)*$")
_STRICT_FLOAT = lit(r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$")


def loose_int(c: str) -> str:
    """Cut the fraction off; null for exponents, blanks, overflow and words.

    A text with a point is rewritten to its whole part, with a zero in front
    for texts that have none.
    """
    return f"try_cast(regexp_replace({c}, {_DECIMAL}, '$10$2') AS INT)"


def loose_double(c: str) -> str:
    """Null for anything that is not a number.

    The pattern lets through all that the cast reads. A failing cast costs an
    exception per row, so words are kept away from it.
    """
    return f"CASE WHEN {c} RLIKE {_DOUBLE} THEN try_cast({c} AS DOUBLE) END"


def strict_int(c: str) -> str:
    """Whole numbers only; a null here rejects the row."""
    t = strip(c)
    return f"CASE WHEN {t} RLIKE {_STRICT_INT} THEN try_cast({remove(t, '_')} AS INT) END"


def strict_double(c: str) -> str:
    """Plain or scientific numbers only, no type suffix; a null rejects the row."""
    t = strip(c)
    return f"CASE WHEN {t} RLIKE {_STRICT_FLOAT} THEN try_cast({t} AS DOUBLE) END"


def is_digits(c: str) -> str:
    """Whole text is decimal digits."""
    return f"{c} RLIKE '^[0-9]+$'"


def zero_if_absent(c: str, value: str) -> str:
    """0 where the text itself is null."""
    return f"CASE WHEN {c} IS NULL THEN 0 ELSE {value} END"
