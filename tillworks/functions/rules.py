"""Business rules that decide results: labels, thresholds, statuses."""

# Stock-code prefix -> product category, first match wins, case-sensitive.
CATEGORY_BY_PREFIX = [
    ("DISC", "Discount"),
    ("M", "Manual"),
    ("POST", "Postage"),
    ("C2", "Carriage"),
    ("BANK", "Bank Charges"),
    ("TEST", "Test"),
    ("PADS", "Pads"),
]
DEFAULT_CATEGORY = "General"

# Lifetime value at or above -> customer segment.
SEGMENT_FLOORS = [
    (10000, "VIP"),
    (5000, "High Value"),
    (1000, "Medium Value"),
    (100, "Low Value"),
]
LOWEST_SEGMENT = "Very Low Value"
SEGMENTS = [label for _, label in SEGMENT_FLOORS] + [LOWEST_SEGMENT]

# Days since last purchase, at most -> customer recency.
CUSTOMER_RECENCY_CEILINGS = [
    (30, "Active (0-30 days)"),
    (90, "Recent (31-90 days)"),
    (180, "At Risk (91-180 days)"),
]
CUSTOMER_RECENCY_BEYOND = "Churned (180+ days)"

# Days since last purchase, at most -> product recency.
PRODUCT_RECENCY_CEILINGS = [(30, "Recent"), (90, "Moderate")]
PRODUCT_RECENCY_BEYOND = "Old"

# Revenue in the month at or above -> spending level.
SPENDING_FLOORS = [
    (1000, "High Spender"),
    (500, "Medium Spender"),
    (100, "Regular Spender"),
]
LOWEST_SPENDING = "Occasional Spender"

# Affinity of a customer to a product; ranks and shares are inclusive.
AFFINITY_TOP3_RANK, AFFINITY_TOP3 = 3, "Top 3 Product"
AFFINITY_TOP10_RANK, AFFINITY_TOP10 = 10, "Top 10 Product"
AFFINITY_MAJOR_SHARE_PCT, AFFINITY_MAJOR = 25, "Major Product (25%+ spend)"
AFFINITY_FREQUENT_TIMES, AFFINITY_FREQUENT = 10, "Frequently Bought"
AFFINITY_OTHER = "Occasional Purchase"

# Customer id that stands for "unknown" from silver on.
UNKNOWN_CUSTOMER = -1

# Cleaning defaults and price limits.
STRICT_DESCRIPTION, LENIENT_DESCRIPTION = "Unknown", "UNKNOWN"
MIN_PRICE, MAX_PRICE = 0, 10000

# Share of the expected rows that must arrive.
INGEST_TOLERANCE = 0.95

# Run states a ledger row may hold.
IN_PROGRESS, COMPLETED, FAILED = "in_progress", "completed", "failed"
LEDGER_STATUSES = [IN_PROGRESS, COMPLETED, FAILED]

# Hours after which data counts as stale.
FRESHNESS_WARN_HOURS, FRESHNESS_ERROR_HOURS = 24, 48
