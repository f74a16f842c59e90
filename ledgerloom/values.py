"""Texts that appear in the written tables and files."""

from __future__ import annotations

# The rules by id.
RULE_DESCRIPTIONS = {
    "VEN-001": "Missing Tax ID",
    "VEN-002": "Invalid currency code",
    "VEN-003": "Missing or invalid AP email",
    "VEN-004": "Non-standard payment terms",
    "VEN-005": "Duplicate vendor (same Tax ID)",
    "VEN-006": "Possible duplicate (same name, different Tax ID)",
}
HIGH, MEDIUM, LOW = "High", "Medium", "Low"
VENDOR_ENTITY = "Vendor"

# Issue statuses (the last two go before the new terms and the survivor's code), and the value that a
# possible duplicate shows.
OPEN = "Open"
AUTO_FIXED = "Auto-fixed -> "
MERGED_INTO = "Merged into "
NAME_AND_FIRST = "%s (matches %s)"

# Migration statuses and kinds of cross-reference.
READY, EXCEPTION = "Ready", "Exception"
SELF, MERGED = "Self", "Merged by Tax ID"

# The Unknown members.
UNKNOWN = "UNKNOWN"
UNKNOWN_VENDOR_NAME = "** Vendor not in master **"
UNKNOWN_ITEM_DESCRIPTION = "** Item not in master **"

# Match statuses, the first that applies counts.
DUPLICATE = "Duplicate invoice"
UNKNOWN_VENDOR = "Unknown vendor"
NO_RECEIPT = "No receipt"
QTY_VARIANCE = "Qty variance"
PRICE_VARIANCE = "Price variance"
MATCHED = "Matched"
