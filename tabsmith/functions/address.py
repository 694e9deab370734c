"""Free-text address cleansers (street line, city, state, ZIP)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabsmith.functions import fixed
from tabsmith.functions.text import collapse_spaces, py_strip, py_title


def expand_abbreviations(c: Column) -> Column:
    """Whole-word abbreviations (with an optional trailing dot) replaced by
    the full word, in the fixed order. ``(?U)`` makes word boundaries Unicode
    aware on every JVM version, like Python's ``\\b``."""
    for short, full in fixed.ADDRESS_ABBREVIATIONS:
        c = F.regexp_replace(c, f"(?U)\\b{short}\\b\\.?", full)
    return c


def clean_address(c: Column) -> Column:
    """strip, lower, expand abbreviations, collapse blanks, title case.
    ``St. Louis`` becomes ``Street Louis`` (the rule is word based)."""
    return py_title(collapse_spaces(expand_abbreviations(F.lower(py_strip(c)))))


def clean_city(c: Column) -> Column:
    return py_title(py_strip(c))


def clean_state(c: Column) -> Column:
    """Known two-letter codes to the state name, anything else title-cased."""
    s = F.lower(py_strip(c))
    out = py_title(s)
    for code, name in reversed(fixed.STATE_NAMES):
        out = F.when(s == code, F.lit(name)).otherwise(out)
    return out


def clean_zip(c: Column) -> Column:
    """Five digits are kept; a longer value with a ``-`` keeps the part
    before the first ``-``; anything else is null."""
    z = py_strip(c.cast("string"))
    return (
        F.when((F.length(z) == fixed.ZIP_LENGTH) & z.rlike("(?U)^\\d+$"), z)
        .when((F.length(z) > fixed.ZIP_LENGTH) & (F.instr(z, "-") > 0), F.substring_index(z, "-", 1))
    )
