"""Fixed values.

These values must equal the ones the original workload uses, or its results
change; they are stated here once, in natural order, and imported where used.
"""

# Line status descriptions kept by the status-interval steps.
STATUS_CREATED = "Created"
STATUS_ALLOCATED = "Allocated"
STATUS_SENT = "Sent for fulfillment"

# Work-order hold type, its statuses, and the status of a paid order.
HOLD_TYPE = "WOConfHold"
HOLD_CREATED = "1100"
HOLD_ACKNOWLEDGED = "1300"
PAID = "FULLY_PAID"

# Event types and outcomes of automatic recoveries.
DEVIATION = "Deviation"
AUTO_RECOVERY = "Auto-recovery"
RECOVERED_CASES = ["Case 1", "Case 2", "Case 3", "Case 4"]
FAILED_CASES = ["Case 5+6"]

# Order stages.
STAGE_ORDER_PROCESSING = "ORDER PROCESSING"
STAGE_FULFILMENT = "FULFILMENT"

# Provenance labels of the imputed stock z-score, in fallback order.
Z_OBSERVED = "OBSERVED"
Z_ITEM_MEDIAN = "IMPUTED_ITEM_MEDIAN"
Z_UNIT_MEDIAN = "IMPUTED_BU_MEDIAN"
Z_NEUTRAL = "IMPUTED_NEUTRAL"

# Weekday names as the operating calendar spells them.
WEEKDAYS = ["MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY"]

# Shift text of a closed day; closing time read as end of day.
CLOSED_SHIFT = "00:00:00-00:00:00"
LATE_CLOSE_SECS = 23 * 3600 + 59 * 60          # 23:59:00
END_OF_DAY_SECS = 23 * 3600 + 59 * 60 + 59     # 23:59:59

# Date given to items whose service level never changed.
NO_CHANGE_DATE = "2024-07-01"

# Local time zone of the operating calendars.
CALENDAR_ZONE = "Europe/Paris"

# Label of grouped rare categories.
OTHER = "OTHER"

# Text of a missing category; size tiers, the largest first.
UNKNOWN = "Unknown"
TIERS = ["LARGE", "MEDIUM", "SMALL"]
