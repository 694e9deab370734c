"""Text helpers with Python ``str`` semantics, as JVM-side column expressions.

Everything here is a ``Column -> Column`` built from regexp_replace / initcap /
lower, so it stays inside whole-stage codegen; no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters for which Python's str.isspace() is true (what str.strip() and
# the regex class \s remove in Python 3). Java's \s differs, so spell it out.
PY_SPACE = (
    "[\\t\\n\\x0b\\x0c\\r\\x1c\\x1d\\x1e\\x1f \\x85\\xa0\\u1680"
    "\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
)
# Python's "cased" characters: upper, lower and title case letters, and signs
# that have the upper- or lower-case property without being such letters.
_CASED = "\\p{Lu}\\p{Ll}\\p{Lt}\\p{IsUppercase}\\p{IsLowercase}"
# initcap() only starts a word after a blank, so a blank is planted after every
# uncased character, initcap runs, and the planted blanks are taken out again.
# The marker (a control character that never occurs in business text) tells
# planted blanks from real ones; inputs that contain it take the exact
# per-character path instead.
_MARK = "\u0001"


def py_strip(c: Column) -> Column:
    """``str.strip()``: remove leading and trailing Python whitespace."""
    return F.regexp_replace(c, f"^{PY_SPACE}+|{PY_SPACE}+$", "")


def collapse_spaces(c: Column) -> Column:
    """``re.sub(r'\\s+', ' ', s)``."""
    return F.regexp_replace(c, f"{PY_SPACE}+", " ")


def _title_by_chars(c: Column) -> Column:
    chars = F.split(c, "")
    return F.array_join(
        F.transform(
            chars,
            lambda ch, i: F.when(
                (i == 0) | ~chars[i - 1].rlike(f"[{_CASED}]"),
                F.initcap(ch),
            ).otherwise(F.lower(ch)),
        ),
        "",
    )


def py_title(c: Column) -> Column:
    """``str.title()``: a cased letter is upper case when the character before
    it is not cased (start, digit, blank, apostrophe, hyphen...), else lower
    case. ``5th`` gives ``5Th`` and ``o'brien`` gives ``O'Brien``."""
    planted = F.regexp_replace(c, f"([^{_CASED}])", f"$1{_MARK} ")
    fast = F.regexp_replace(F.initcap(planted), f"{_MARK} ", "")
    return F.when(F.instr(c, _MARK) > 0, _title_by_chars(c)).otherwise(fast)


def initcap_lower(c: Column) -> Column:
    """``initcap(lower(s))``: upper-case the first letter after each blank."""
    return F.initcap(F.lower(c))
