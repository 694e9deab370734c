"""Column-level rules (Column -> Column), all built-in Spark expressions."""

from tabsmith.functions.address import clean_address, clean_city, clean_state, clean_zip  # noqa: F401
from tabsmith.functions.contact import (  # noqa: F401
    address_label, country, email, phone, phone_digits, phone_extension, prefixed_id,
)
from tabsmith.functions.items import (  # noqa: F401
    item_class, lot_sizing, preferred_flag, purchase_unit, stock_unit, unit_price, units_type, zero_to_null,
)
from tabsmith.functions.mfg import (  # noqa: F401
    bom_external_id, operation_sequence, revision_external_id, routing_external_id, work_center,
)
from tabsmith.functions.parties import (  # noqa: F401
    credit_hold, flag_text, include_1099, include_1099_code, individual_flag, market_industry,
    on_hold_since, taxable, vendor_category, vendor_id, vendor_number,
)
from tabsmith.functions.text import collapse_spaces, initcap_lower, py_strip, py_title  # noqa: F401
