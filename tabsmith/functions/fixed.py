"""Fixed values.

FIXED VALUES: these must equal the source ERP templates for the results to be
right. They are listed plainly and in their natural order; rules are evaluated
top to bottom, first match wins.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------- FIXED VALUES
# Template constants written into every tab.
SUBSIDIARY = "Wesley International LLC"
LOCATION = "Georgia HQ"
CURRENCY = "US Dollar"
ASSET_ACCOUNT = "12010 Inventory : Raw Materials"
INCOME_ACCOUNT = "40000 Gross Sales"
COGS_ACCOUNT = "50000 Cost of Goods Sold"
TAX_SCHEDULE = "Taxable"
REPLENISHMENT = "Material Requirements Planning"
COUNT_INTERVAL = "120"
COMPONENT_YIELD = "100"
ITEM_SOURCE = "STOCK"
REVISION_START = "05/04/1900"
WEIGHT_UOM = "lb"
# Null columns that the location templates carry without a name.
UNNAMED_LOCATION_COLUMNS = ("unnamed_1", "unnamed_2", "unnamed_3", "unnamed_4", "unnamed_5")
PURCHASED_COST_CATEGORY = "Raw Material"
ASSEMBLY_COST_CATEGORY = "Sub-Assembly"
PURCHASED_SUPPLY_TYPE = "Purchase"
ASSEMBLY_SUPPLY_TYPE = "Build"
LOT_FOR_LOT = "Lot For Lot"
MINIMUM_ORDER_QUANTITY = "Minimum Order Quantity"

# Phone numbers: an international number starts with "+" or "00".
INTERNATIONAL_PREFIX = r"^(\+|00)"
# Country spellings folded into one name (compared after initcap(lower())).
US_ALIASES = ("United States Of America", "282")
US_NAME = "United States"

# Credit hold.
CREDIT_HOLD_STATUS = "Cr Hold"
HOLD_ON = "On"
HOLD_AUTO = "Auto"
# Channel segment that never gets a market industry.
DEALER_SEGMENTS = ("DEALER",)
# CRM rows that describe a customer.
CRM_CUSTOMER_SOURCE = "ARCUSTO"
CRM_CUSTOMER_ACTIVITY_TYPE = "4"

# Vendor buyer category.
VENDOR_CATEGORIES = (
    ("Strategic Buyer", "Strategic"),
    ("Tactical Buyer", "Tactical"),
)
# Vendor numbers starting with this digit are kept as they are; others are
# left-padded with zeros to this width.
VENDOR_KEEP_PREFIX = "5"
VENDOR_ID_WIDTH = 10

# Units of measure.
STOCK_UNIT_MAP = (
    ("YARD", "YD"),
    ("EACH", "EA"),
    ("PAIR", "PR"),
    ("GAL", "Gallon"),
)
PURCHASE_UNIT_MAP = (
    (("YARD",), "YD"),
    (("EACH", "UNIT"), "EA"),
    (("PAIR",), "PR"),
    (("GAL",), "Gallon"),
    (("ROLL",), "IN"),
)
UNITS_TYPE_MAP = (
    (("EACH", "PAIR"), "1"),
    (("YARD", "IN", "FT", "ROLL"), "3"),
    (("GAL",), "4"),
)
LOT_FOR_LOT_UNITS = ("EACH",)

# Item class: the product group wins, then the model rules in order.
PARTS_GROUPS = (
    "Pallet Jacks - Parts",
    "Electric Vehicles - Parts",
    "Trailers - Parts",
)
PARTS_CLASS = "Parts"
MODEL_CLASS_RULES = (
    (("BC-520 NXG Series", "BC-520 Series",
      "BC-620 NXG Series", "BC-620 Series",
      "BCG-6200 Series", "BCT-9000 NXG Series",
      "BCT-9000 Series", "BC-625 Series"), "Burden Carrier"),
    (("Mall Train", "SC-775 NXG Series",
      "SC-775 Series", "SC-850 NXG Series",
      "SC-850 Series", "SC-750 Series",
      "SCT-8500 NXG Series"), "Stock Chaser"),
    (("PC-300 NXG Series", "PC-300 Series",
      "PC-320 NXG Series", "PC-320 Series",
      "PC-325 NXG Series", "PC-325 Series",
      "PC-640 NXG Series", "PC-640 Series",
      "PCT-3500 NXG Series", "PCT-3500 Series",
      "PC-310 NXG Series", "Sprinter NXG Series"), "Personnel Carrier"),
    (("PCT-3500 NXG Series", "PCT-3500 Series",
      "PMT-4500 NXG Series", "PMT-4500 Series",
      "PMT-5000 NXG Series", "PMT-5000 Series",
      "PMT-6000 Series"), "Tugger"),
    (("Double Fork Pallet Jack",), "PJ Double Fork"),
    (("High Capacity Pallet Jack",), "PJ High Capacity"),
    (("Reel Truck Pallet Jack", "Towable Pallet Jack"), "PJ Roll/Reel Truck"),
    (("Single Fork Pallet Jack", "Narrow Fork Pallet Jack"), "PJ Single Fork"),
    (("Skid Truck Pallet Jack",), "PJ Skid Truck"),
    (("Shipboard Pallet Jack",), "Navy Shipboard"),
    (("DC-1000 Towable Cart", "DC-2000 Towable Cart",
      "DC-3/4000 Towable Cart"), "Delivery Cart"),
    (("FedEx Towable Cart", "Modular Cart"), "Cargo Cart"),
    (("TOP-1500 Towable Cart",), "TOP Cart"),
    (("DP-3/4000 Towable Cart",), "Double Pallet"),
    (("Not a Finished Good", "Unknown Model"), None),
    (("SP-1000 Towable Cart", "SP-1500 Towable Cart",
      "SP-2500 Towable Cart", "SP-3/4000 Towable Cart"), "Single Pallet"),
    (("Coke Pallet Jack",), "Coke Pallet Jack"),
)

# Purchased items: product groups kept and item ids always left out.
PURCHASED_GROUPS = (
    "Electric Vehicles - Parts", "Pallet Jacks - Parts",
    "Trailers - Parts", "Trailers - F&H",
    "Pallet Jacks - F&H", "Electric Vehicles - F&H",
)
EXCLUDED_ITEM_IDS = (206081, 206079, 206100, 206099, 206085)

# Transaction types.
NEW_ITEM = "NEW ITEM"
USE_TRANSACTIONS = ("PROCESS WIP", "PACKING SLIP")
NEVER_USED = "1900-01-01"
# Inactive purchased items: created before CREATED_BEFORE with at most
# MAX_TRANSACTIONS transactions, or last moved before LAST_MOVED_BEFORE with
# nothing on hand.
CREATED_BEFORE = _dt.date(2024, 1, 1)
MAX_TRANSACTIONS = 1
LAST_MOVED_BEFORE = _dt.date(2021, 1, 1)
# Stale assemblies: created and last used before this date.
STALE_BEFORE = _dt.date(2021, 1, 1)
ECO_MARK = "%ECO%"
# Assemblies: description and class exclusions.
TEST_MARK = "%TEST%"
FINISHED_GOOD_MARK = "%FG%"
# Quote lines that come from the sales configurator.
SALES_CONFIG = "SALES_CONFIG"

# Bills of materials whose number contains one of these (case-folded) are
# never candidates.
BOM_EXCLUDED_MARKS = ("%SUB%", "%TEST%", "%ECO%", "%REWORK%")
BOM_DEFAULT = "Default"
BOM_SUFFIX = "-BOM"
REVISION_SUFFIX = "_Rev_00"
ROUTING_SUFFIX = "_Default"
OPERATION_STEP = 10

# Work centers by center type.
WORK_CENTERS = (
    (("FINAL ASSY", "WORK_CELL", "ASSY"), "CL - EV Work Cell"),
    (("SHIPPING",), "CL - Palletization"),
    (("KITTING",), "CL - Parts Picking"),
    (("FINAL ASSEMBLY-PJ", "PRE PAINT ASSY"), "CL - PJ Work Cell"),
    (("QUALITY", "INSPECTION TRAILER", "INSPECTION EV", "INSPECTION PJ", "INSPECTION"), "CL - Quality Control"),
    (("TRAILER ASSEMBLY",), "CL - TR Work Cell"),
    (("FOAM FILLING",), "SD - Bench Work Cell"),
    (("PAINT",), "SD - Paint"),
    (("SAW", "DRILL", "MACHINING"), "SD - Saw-Drill"),
    (("WELD",), "SD - Weld"),
)

# Address cleaning: abbreviations expanded in this order.
ADDRESS_ABBREVIATIONS = (
    ("st", "street"),
    ("rd", "road"),
    ("ave", "avenue"),
    ("dr", "drive"),
    ("ln", "lane"),
    ("pkwy", "parkway"),
    ("blvd", "boulevard"),
)
STATE_NAMES = (
    ("ga", "Georgia"),
    ("fl", "Florida"),
    ("al", "Alabama"),
    ("tn", "Tennessee"),
)
ZIP_LENGTH = 5
# ------------------------------------------------------------ END FIXED VALUES

# Legacy template spellings of output columns (corrected spelling -> legacy).
LEGACY_COLUMN_NAMES = {
    "address_1_default_billing": "addrees_1_default_billing",
    "address_1_default_shipping": "addrees_1_default_shipping",
    "address_1_addressee": "address_1_adressee",
    "address_2_addressee": "address_2_adressee",
}
