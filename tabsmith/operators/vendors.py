"""Vendor operators: vendor x remit-to rows and curated reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith import functions as T
from tabsmith.functions import fixed


def vendor_remit_pairs(po: DataFrame, vendor_ids=None) -> DataFrame:
    """Distinct (vendor, remit-to) pairs of the purchase-order headers. Only
    these two columns reach the vendor rows, so the headers are reduced to
    them before any join (no PO fan-out). ``vendor_ids`` keeps only the POs
    of the listed vendors (the source's optional vendor restriction)."""
    if vendor_ids is not None:
        po = po.filter(F.col("vendor_id").isin(*vendor_ids))
    return po.select("vendor_id", "remit_to_id").distinct()


# The source groups vendor rows by these columns (vendor, employee match,
# vendor state name, remit-to address incl. id and third line, terms, account).
GROUP_COLUMNS = (
    "v_id", "v_vendorno", "v_company", "employee_full_name", "v_cuser2", "v_e_mail_addr", "v_phone_number",
    "v_web_site_url", "v_fax_number", "v_addr1", "v_city", "v_state_name", "v_zip", "v_country",
    "r_id", "r_attn", "r_phone_number", "r_addr1", "r_addr2", "r_addr3", "r_city", "r_state_name", "r_zip",
    "r_country", "terms_description", "v_fed_tax_id", "v_include_in_1099", "acct",
)


def _prefixed(df: DataFrame, prefix: str, cols) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in cols])


def vendor_rows(vendor: DataFrame, po: DataFrame, remit_to: DataFrame, terms: DataFrame, states: DataFrame,
                employees: DataFrame, glacct: DataFrame, with_po_only: bool = False, vendor_ids=None) -> DataFrame:
    """The vendor x remit-to grid before formatting: one row per distinct
    combination of ``GROUP_COLUMNS``. Lookups (terms, states twice, employee
    names, accounts) are left joins; states is joined twice in two roles.
    ``with_po_only`` keeps only vendors with a purchase order (the source's
    disabled ``having count(po) > 0``)."""
    v = _prefixed(vendor, "v_", vendor.columns)
    r = _prefixed(remit_to, "r_", ["id", "attn", "phone_number", "addr1", "addr2", "addr3", "city", "state",
                                   "zip", "country"])
    pairs = vendor_remit_pairs(po, vendor_ids)
    s1 = states.select(F.col("state_code").alias("s1_code"), F.col("name").alias("v_state_name"))
    s2 = states.select(F.col("state_code").alias("s2_code"), F.col("name").alias("r_state_name"))
    emp = employees.select("employee_full_name").distinct()
    t = terms.select(F.col("id").alias("t_id"), F.col("description").alias("terms_description"))
    g = glacct.select(F.col("id").alias("g_id"), "acct")
    how = "inner" if with_po_only else "left"
    rows = (v.join(pairs, F.col("v_id") == F.col("vendor_id"), how)
            .join(r, F.col("remit_to_id") == F.col("r_id"), "left")
            .join(t, F.col("v_terms_id") == F.col("t_id"), "left")
            .join(s1, F.col("v_state") == F.col("s1_code"), "left")
            .join(s2, F.col("r_state") == F.col("s2_code"), "left")
            .join(emp, F.col("v_company") == F.col("employee_full_name"), "left")
            .join(g, F.col("v_glacct_id_exp") == F.col("g_id"), "left"))
    return rows.select(*GROUP_COLUMNS).distinct()


def format_vendor_rows(rows: DataFrame) -> DataFrame:
    """Template columns of the vendor grid (before the curated list)."""
    c = F.col
    null = F.lit(None).cast("string")
    v_digits = T.phone_digits(c("v_phone_number"))
    r_digits = T.phone_digits(c("r_phone_number"))
    return rows.select(
        c("v_id").alias("external_id"),
        T.vendor_number(c("v_vendorno")).alias("vendor_id"),
        T.initcap_lower(c("v_company")).alias("vendor_name"),
        null.alias("primary_subsidiary_external_id"),
        T.individual_flag(c("v_company"), c("employee_full_name")).alias("individual"),
        T.vendor_category(c("v_cuser2")).alias("category"),
        c("v_e_mail_addr").alias("email"),
        T.phone(c("v_phone_number"), v_digits).alias("phone"),
        T.phone_extension(c("v_phone_number"), v_digits).alias("extension"),
        c("v_web_site_url").alias("web_address"),
        T.phone(c("v_fax_number")).alias("fax"),
        null.alias("address_1_external_id"),
        null.alias("address_1_addressee"),
        T.phone(c("v_phone_number"), v_digits).alias("address_1_phone"),
        T.phone_extension(c("v_phone_number"), v_digits).alias("address_1_phone_extension"),
        T.initcap_lower(c("v_addr1")).alias("address_1_address_1"),
        null.alias("address_1_address_2"),
        T.initcap_lower(c("v_city")).alias("address_1_city"),
        T.initcap_lower(c("v_state_name")).alias("address_1_state"),
        T.initcap_lower(c("v_zip")).alias("address_1_zip"),
        T.country(c("v_country")).alias("address_1_country"),
        null.alias("address_1_default_shipping"),
        null.alias("address_1_default_billing"),
        null.alias("address_2_external_id"),
        T.initcap_lower(c("r_attn")).alias("address_2_addressee"),
        T.phone(c("r_phone_number"), r_digits).alias("address_2_phone"),
        T.phone_extension(c("r_phone_number"), r_digits).alias("address_2_phone_extension"),
        T.initcap_lower(c("r_addr1")).alias("address_2_address_1"),
        T.initcap_lower(c("r_addr2")).alias("address_2_address_2"),
        T.initcap_lower(c("r_city")).alias("address_2_city"),
        T.initcap_lower(c("r_state_name")).alias("address_2_state"),
        c("r_zip").alias("address_2_zip"),
        T.country(c("r_country")).alias("address_2_country"),
        null.alias("address_2_default_shipping"),
        null.alias("address_2_default_billing"),
        F.lit(fixed.CURRENCY).alias("currency"),
        T.initcap_lower(c("terms_description")).alias("terms"),
        null.alias("incoterm"),
        c("v_fed_tax_id").alias("tax_id"),
        T.include_1099_code(c("v_include_in_1099")).alias("include_in_1099"),
        c("acct").alias("account"),
        null.alias("inactive"),
        c("r_id").alias("remit_to_id"),
    )


# Curated columns that also exist in the computed grid get this suffix.
CURATED_SUFFIX = "_curated"


def reconcile(curated: DataFrame, vendors: DataFrame) -> DataFrame:
    """The curated vendor list drives; each curated vendor is joined to its
    computed rows (one per remit-to) and both versions of a field are kept,
    the curated one suffixed ``_curated``. An unknown curated vendor keeps
    one row of nulls with 1099 = true and address 1 as default billing."""
    a = vendors.alias("a")
    k = curated.alias("k")
    j = k.join(a, F.col("k.external_id") == F.col("a.external_id"), "left")

    def both(name: str):
        return [F.col(f"a.{name}").alias(name), F.col(f"k.{name}").alias(name + CURATED_SUFFIX)]

    def cur(name: str):
        return F.col(f"k.{name}").alias(name + CURATED_SUFFIX)

    av = F.col
    return j.select(
        av("a.external_id").alias("external_id"),
        T.vendor_id(av("a.vendor_id")).alias("vendor_id"),
        av("a.vendor_name"), av("a.primary_subsidiary_external_id"), av("a.individual"), av("a.category"),
        *both("email"),
        av("a.phone"), av("a.extension"),
        *both("web_address"),
        cur("fax"), cur("address_1_external_id"),
        av("a.address_1_addressee"), av("a.address_1_phone"), av("a.address_1_phone_extension"),
        av("a.address_1_address_1"), av("a.address_1_address_2"),
        *both("address_1_city"), *both("address_1_state"), *both("address_1_zip"), *both("address_1_country"),
        F.lit("True").alias("address_1_default_shipping"),
        F.col("a.address_2_addressee").isNull().alias("address_1_default_billing"),
        cur("address_2_external_id"),
        av("a.address_2_addressee"), av("a.address_2_phone"), av("a.address_2_phone_extension"),
        *both("address_2_address_1"), *both("address_2_address_2"), *both("address_2_city"),
        *both("address_2_state"), *both("address_2_zip"), *both("address_2_country"),
        F.lit("False").alias("address_2_default_shipping"),
        F.col("a.address_2_addressee").isNotNull().alias("address_2_default_billing"),
        av("a.currency"), av("a.terms"), av("a.incoterm"),
        T.include_1099(av("a.include_in_1099")).alias("include_in_1099"),
        av("a.tax_id"), av("a.account"), av("a.inactive"),
    )
