"""Literal lookup tables of the test-table adapter, as SQL text any engine reads."""

from __future__ import annotations

# Lookup rows; the last column marks the current version.
LOOKUPS = {
    "servicetype": (
        "id, name, adh_active_flag",
        "(1, 'GAS', 1), (2, 'ELECTRICITY', 1), (2, 'POWER', 0)",
    ),
    "journalaccountsegment": (
        "id, name, adh_active_flag",
        "(1, 'AUTOMOBILE', 1), (2, 'BUILDING', 1), (3, 'FURNITURE', 1), (4, 'HOUSEHOLD', 1), (5, 'MACHINERY', 1)",
    ),
    "eventtype": (
        "id, status_group_id, adh_active_flag",
        "(1, 10, 1), (2, 20, 1), (3, 10, 1)",
    ),
    "statusgroup": (
        "id, name, adh_active_flag",
        "(10, 'Active', 1), (20, 'Pending Closure', 1)",
    ),
    "lineitemcategory": (
        "id, name, description, adh_active_flag",
        "(1, 'CHARGE', 'Standard charge', 1), (2, 'ADJ', 'Adjusted charge', 1), (3, 'MISC', 'Other entry', 1)",
    ),
    "planitemtype": (
        "id, name, adh_active_flag",
        "(2, 'RETAIL_USAGE', 1), (4, 'DAILY_RETAIL', 1), (5, 'DEMAND_RETAIL', 1), "
        "(35, 'CONTRIBUTION', 1), (36, 'OTHER_RETAIL', 1), (2, 'USAGE', 0)",
    ),
    "timeclass": (
        "id, name, display_grouping_override, adh_active_flag",
        "(1, 'PEAK', NULL, 1), (2, 'SHOULDER', NULL, 1), (3, 'ANYTIME', NULL, 1), (4, 'OFFPEAK', NULL, 1), "
        "(5, 'SUMMER', 'CONTROLLED', 1), (6, 'WINTER', 'CONTROLLED', 1), (7, 'EXPORT', 'SOLAR', 1), "
        "(8, 'CL1', 'CONTROLLED', 1), (9, 'CL2', 'CONTROLLED LOAD 2', 1), (4, 'NIGHT', NULL, 0)",
    ),
    "adjustmenttype": (
        "id, adjustment_group_id, includes_gst, name, adh_active_flag",
        "(1, 1, 1, 'USAGE_DISC', 1), (2, 1, 1, 'USAGE_DISCCR', 1), (3, 1, 0, 'GD', 1), "
        "(4, 1, 0, 'GD_REV', 1), (5, 2, 0, 'LATE_FEE', 1), (6, 2, 0, 'GOODWILL', 1)",
    ),
    "adjustmentgroup": (
        "id, name, adh_active_flag",
        "(1, 'DISCOUNTS', 1), (2, 'FEES', 1)",
    ),
    "adjustment": (
        "id, invoice_desc, adh_active_flag",
        "(1, 'DISCOUNT PAY ON TIME', 1), (2, 'DISCOUNT DIRECT DEBIT', 1), (3, 'CREDIT', 1), (4, 'REFUND', 1)",
    ),
}

# Charge texts by line number and variant, with plan item and time class.
CHARGE_TEMPLATES = (
    "line_number, variant, description, plan_id, class_id",
    "(1, 0, 'SUPPLY CHARGE', 4, NULL), "
    "(1, 1, 'daily supply charge - second meter', 4, NULL), "
    "(1, 2, 'Supply Charge (Network)', 4, 3), "
    "(2, 0, 'PEAK USAGE', 2, 1), "
    "(2, 1, 'Peak Usage (Block 1)', 2, 1), "
    "(2, 2, 'Shoulder Usage', 2, 2), "
    "(3, 0, 'OFF PEAK - NIGHT', 2, 4), "
    "(3, 1, 'Off Peak Usage', 2, 4), "
    "(3, 2, 'Night Saver', 2, 4), "
    "(4, 0, 'any time usage', 2, 3), "
    "(4, 1, 'Import Any Time Usage', 2, 2), "
    "(4, 2, 'General Usage', 2, 3), "
    "(5, 0, 'Solar Feed-in Rebate', 35, 7), "
    "(5, 1, 'SOLAR REBATE (NET)', 2, 7), "
    "(5, 2, 'Retailer Contribution', 35, 7), "
    "(6, 0, 'Controlled Load Usage - Tariff 31', 2, 8), "
    "(6, 1, 'CONTROLLED LOAD (2)', 2, 9), "
    "(6, 2, 'Climate Saver', 2, 5), "
    "(7, 0, 'Capacity Charge', 5, NULL), "
    "(7, 1, 'PEAK DEMAND WINDOW', 2, 1), "
    "(7, 2, 'Account adjustment', 2, NULL)",
)


def values_sql(table: tuple[str, str]) -> str:
    columns, rows = table
    return f"SELECT * FROM (VALUES {rows}) AS t({columns})"
