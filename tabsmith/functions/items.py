"""Item master cleansers: units of measure, item class, prices, planning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabsmith.functions import fixed


def _first_match(value: Column, rules, otherwise: Column | None = None) -> Column:
    """``CASE WHEN value IN (...) THEN out ... ELSE otherwise END``."""
    out = otherwise if otherwise is not None else F.lit(None).cast("string")
    for keys, result in reversed(rules):
        keys = (keys,) if isinstance(keys, str) else keys
        out = F.when(value.isin(*keys), F.lit(result).cast("string")).otherwise(out)
    return out


def stock_unit(unit: Column) -> Column:
    """YARD->YD, EACH->EA, PAIR->PR, GAL->Gallon, anything else unchanged."""
    return _first_match(unit, fixed.STOCK_UNIT_MAP, unit)


def purchase_unit(po_unit: Column, unit: Column) -> Column:
    """From the latest purchase-order unit (also UNIT->EA, ROLL->IN); any
    other or no PO unit falls back to the stock-unit map of the item unit."""
    return _first_match(po_unit, fixed.PURCHASE_UNIT_MAP, stock_unit(unit))


def units_type(unit: Column) -> Column:
    return _first_match(unit, fixed.UNITS_TYPE_MAP)


def item_class(product_group: Column, product_model: Column) -> Column:
    """Target class name: parts groups first, then the ordered model rules."""
    by_model = _first_match(product_model, fixed.MODEL_CLASS_RULES)
    return F.when(product_group.isin(*fixed.PARTS_GROUPS), F.lit(fixed.PARTS_CLASS)).otherwise(by_model)


def unit_price(quan: Column, qprice: Column) -> Column:
    """Price per unit of a price break; the break price itself when the
    quantity is zero or unknown."""
    return F.when(quan != 0, qprice / quan).otherwise(qprice)


def preferred_flag(is_default: Column, yes: str = "TRUE", no: str = "FALSE") -> Column:
    return F.when(F.coalesce(is_default, F.lit("N")) == "Y", F.lit(yes)).otherwise(F.lit(no))


def zero_to_null(x: Column) -> Column:
    """A zero lead time or safety stock means "not set"."""
    return F.when(x == 0, F.lit(None)).otherwise(x)


def lot_sizing(unit: Column) -> Column:
    """``Minimum Order Quantity`` unless the unit is EACH or unknown."""
    return F.when(~unit.isin(*fixed.LOT_FOR_LOT_UNITS), F.lit(fixed.MINIMUM_ORDER_QUANTITY)).otherwise(
        F.lit(fixed.LOT_FOR_LOT))
