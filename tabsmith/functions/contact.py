"""Contact data cleansers: phone, extension, e-mail, country, address label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabsmith.functions import fixed
from tabsmith.functions.text import initcap_lower


def phone_digits(raw: Column) -> Column:
    """All digits of a phone number, in order."""
    return F.regexp_replace(raw, "[^0-9]", "")


def _is_international(raw: Column) -> Column:
    # Prefix test: "+..." or "00..." (the pattern is anchored at the start only).
    return raw.rlike(fixed.INTERNATIONAL_PREFIX)


def _without_trunk_one(digits: Column) -> Column:
    return F.when(F.substr(digits, F.lit(1), F.lit(1)) == "1", F.substr(digits, F.lit(2))).otherwise(digits)


def phone(raw: Column, digits: Column | None = None) -> Column:
    """International numbers keep every digit. Otherwise a number with more
    than ten digits loses one leading ``1`` and keeps the first ten digits;
    ten or fewer digits are kept as they are (the length is tested before the
    ``1`` is dropped). Pass ``digits`` when it is already a column."""
    d = phone_digits(raw) if digits is None else digits
    return (
        F.when(_is_international(raw), d)
        .when(F.length(d) > 10, F.substr(_without_trunk_one(d), F.lit(1), F.lit(10)))
        .otherwise(d)
    )


def phone_extension(raw: Column, digits: Column | None = None, empty_as_null: bool = False) -> Column:
    """Digits after the tenth (after dropping a leading ``1``) of a domestic
    number longer than ten digits; null otherwise. An 11-digit ``1...`` number
    yields ``''`` unless ``empty_as_null``."""
    d = phone_digits(raw) if digits is None else digits
    ext = F.substr(_without_trunk_one(d), F.lit(11))
    if empty_as_null:
        ext = F.nullif(ext, F.lit(""))
    return F.when(~_is_international(raw) & (F.length(d) > 10), ext)


def email(raw: Column) -> Column:
    """Lower-case address; ``Name <a@b>`` gives the part inside the angle
    brackets; no ``@`` or a ``www.`` gives null. A ``>`` before the ``<``
    gives ``''``."""
    low = F.lower(raw)
    at = F.locate("@", low)
    www = F.locate("www.", low)
    lt = F.locate("<", low)
    gt = F.locate(">", low)
    return (
        F.when((at > 0) & (www == 0) & (lt > 0) & (gt > 0), low.substr(lt + 1, gt - lt - 1))
        .when((at == 0) | (www > 0), F.lit(None).cast("string"))
        .otherwise(low)
    )


def country(raw: Column) -> Column:
    """``initcap(lower())`` with the US aliases folded into ``United States``."""
    c = initcap_lower(raw)
    return F.when(c.isin(*fixed.US_ALIASES), F.lit(fixed.US_NAME)).otherwise(c)


def address_label(addr1: Column, city: Column, state: Column, country_name: Column) -> Column:
    """``addr1, city, state, country``; null when any part is null."""
    return F.concat(addr1, F.lit(", "), city, F.lit(", "), state, F.lit(", "), country_name)


def prefixed_id(prefix: str, key: Column) -> Column:
    """External id such as ``B17``: a letter and the numeric key."""
    return F.concat(F.lit(prefix), key.cast("string"))
