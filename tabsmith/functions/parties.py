"""Customer and vendor field rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabsmith.functions import fixed
from tabsmith.functions.text import initcap_lower


def flag_text(cond: Column, yes: str = "TRUE", no: str = "FALSE") -> Column:
    """Template boolean spelled as text; a null condition gives ``no``."""
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


def credit_hold(status: Column) -> Column:
    return F.when(status == fixed.CREDIT_HOLD_STATUS, F.lit(fixed.HOLD_ON)).otherwise(F.lit(fixed.HOLD_AUTO))


def on_hold_since(status: Column, status_date: Column) -> Column:
    return F.when(status == fixed.CREDIT_HOLD_STATUS, F.to_date(status_date))


def taxable(tax_exempt_num: Column) -> Column:
    return flag_text(tax_exempt_num.isNotNull(), "FALSE", "TRUE")


def market_industry(channel_segment: Column, industry: Column) -> Column:
    return F.when(channel_segment.isin(*fixed.DEALER_SEGMENTS), F.lit(None).cast("string")).otherwise(industry)


def vendor_number(vendorno: Column) -> Column:
    """``initcap(lower(vendorno))`` as text (the intermediate vendor id)."""
    return initcap_lower(vendorno).cast("string")


def vendor_id(vendor_number_text: Column) -> Column:
    """Numbers starting with ``5`` stay; others are left-padded with zeros to
    ten characters (longer ones are cut to ten, as lpad does)."""
    return F.when(
        F.substr(vendor_number_text, F.lit(1), F.lit(1)) == fixed.VENDOR_KEEP_PREFIX, vendor_number_text
    ).otherwise(F.lpad(vendor_number_text, fixed.VENDOR_ID_WIDTH, "0"))


def vendor_category(cuser2: Column) -> Column:
    out = F.lit(None).cast("string")
    for src, dst in reversed(fixed.VENDOR_CATEGORIES):
        out = F.when(cuser2 == src, F.lit(dst)).otherwise(out)
    return out


def individual_flag(company: Column, employee_full_name: Column) -> Column:
    """A vendor whose company name is an employee's full name is a person."""
    return flag_text(company == employee_full_name)


def include_1099_code(code: Column) -> Column:
    """Source code with the ``N`` default (kept as text)."""
    return F.coalesce(code, F.lit("N"))


def include_1099(code_with_default: Column) -> Column:
    """``N`` is false, anything else (including an unmatched vendor) true."""
    return F.when(code_with_default == "N", F.lit(False)).otherwise(F.lit(True))
