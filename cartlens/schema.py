"""Entity schemas and the fixed values the operators must reproduce.

Everything in the FIXED VALUES block is data, not logic: token lists, value
domains, thresholds and patterns whose exact content decides results.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES
# ---------------------------------------------------------------------------

# Strings read as missing by the typed CSV scan. "NA" is deliberately absent:
# it stays a real value.
NA_TOKENS = [
    "", " ", '""',
    "#N/A", "#N/A N/A", "#NA", "N/A", "<NA>", "n/a",
    "-1.#IND", "1.#IND",
    "-1.#QNAN", "-NaN", "-nan", "-NAN", "1.#QNAN", "NaN", "nan", "NAN",
    "NULL", "Null", "null",
    "NONE", "None", "none",
]

# Boolean tokens accepted by the boolean parser; anything else is an error.
TRUE_TOKENS = ["True", "TRUE", "true", "1", "1.0"]
FALSE_TOKENS = ["False", "FALSE", "false", "0", "0.0"]

# Valid card statuses and order-item statuses (after lower-case cleaning).
CARD_STATUSES = ["error", "not-assigned", "pending", "warning", "valid", "rejected", "membership"]
ITEM_STATUSES = ["ok", "fulfilled", "on-hold", "cancelled", "transfer", "processing"]
CARD_NOT_ASSIGNED = "not-assigned"
FULFILLED = "fulfilled"

# Sex canonicalisation (tokens compared after strip + upper).
SEX_MALE_TOKENS = ["M", "MASCHIO", "UOMO"]
SEX_FEMALE_TOKENS = ["F", "FEMMINA", "DONNA"]

# Unicode whitespace as Python's str.isspace() defines it. Written once so the
# Java (Spark) and RE2 (DuckDB oracle) patterns are the same text.
WS_CODEPOINTS = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
                 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009,
                 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WS_CHARS = "".join(chr(c) for c in WS_CODEPOINTS)
WS_CLASS = (r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS = f"[{WS_CLASS}]"

# Review cleaning patterns, applied in this order.
URL_PATTERN = r"http\S+|www\S+"
TAG_PATTERN = r"<.*?>"
REVIEW_KEEP_CLASS = r"a-z0-9.,!?;:'\"()"
REPEATED_PUNCT = "!?.,"

# RFM segment rules, first match wins: (name, R range, F range, M range).
RFM_SEGMENTS = [
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal", (3, 5), (3, 5), (1, 5)),
    ("New Customers", (4, 5), (1, 2), (1, 5)),
    ("At Risk", (1, 2), (3, 5), (1, 5)),
    ("Lost", (1, 2), (1, 2), (1, 2)),
]
RFM_OTHER = "Others"
RFM_QUINTILES = [0.2, 0.4, 0.6, 0.8]

# Churn and campaign parameters.
CHURN_PERIOD_DAYS = 90
RECENT_WINDOW_DAYS = 30
CHURN_PROB_THRESHOLD = 0.65
VALUE_PERCENTILE = 0.5
CHURN_NUMERIC = ["freq_total", "monetary_total", "tenure_days", "avg_order_value", "orders_last_30d"]
CHURN_CATEGORICAL = ["source", "language", "sex", "level", "main_city"]
MISSING_LEVEL = "Missing"
CAMPAIGN_EXPORT = ["user_uid", "churn_proba", "monetary_total", "freq_total", "tenure_days",
                   "orders_last_30d", "main_city", "sex", "level", "source"]

# Source-column discovery keywords (first column whose lower name contains one).
SOURCE_KEYWORDS = ["source", "channel", "platform", "origin"]
# Order-date discovery candidates, first present wins.
ORDER_DATE_CANDIDATES = ["createdAt", "createdAtTime", "order_date", "created_at"]

# Sentiment labels and text-model settings.
TOKEN_PATTERN = r"\b\w\w+\b"
MIN_DF = 2
MAX_DF_FRACTION = 0.95
MIN_REVIEW_LENGTH = 3

# Age histogram bins and density grid size.
AGE_BINS = 30
DENSITY_GRID = 200

# Splits and seeds.
SEED = 42
CHURN_TEST_FRACTION = 0.3
SENTIMENT_TEST_FRACTION = 0.2

# ---------------------------------------------------------------------------
# Ingest schemas: every CSV column is read as a string, then converted.
# (source header, Spark name, target type)
# ---------------------------------------------------------------------------

ENTITY_COLUMNS: dict[str, list[tuple[str, str, str]]] = {
    "users": [
        ("user.uid", "user_uid", "string"), ("createdAt", "created_at", "ts_strict"),
        ("source", "source", "string"), ("isAnonymous", "is_anonymous", "boolean"),
        ("referralsCount", "referrals_count", "integer"), ("city", "city", "string"),
        ("language", "language", "string"), ("googleId", "google_id", "boolean"),
        ("appleId", "apple_id", "boolean"), ("facebookId", "facebook_id", "boolean"),
        ("referral.medium", "referral_medium", "string"),
        ("referral.source", "referral_source", "string"),
        ("referral.type", "referral_type", "integer"),
        ("favouriteZones", "favourite_zones", "string"),
    ],
    "profiles": [
        ("user.uid", "user_uid", "string"), ("profile.uid", "profile_uid", "string"),
        ("birthday", "birthday", "ts_strict"), ("sex", "sex", "string"),
        ("city", "city", "string"), ("height", "height", "double"),
        ("weight", "weight", "double"), ("skibootsSize", "skiboots_size", "double"),
        ("level", "level", "string"), ("types", "types", "string"),
    ],
    "cards": [
        ("card.uid", "card_uid", "string"), ("assignedAt", "assigned_at", "ts_coerce"),
        ("birthday", "birthday", "ts_coerce"), ("status", "status", "string"),
        ("user.uid", "user_uid", "string"),
    ],
    "orders": [
        ("order.uid", "order_uid", "string"), ("user.uid", "user_uid", "string"),
        ("createdAt", "created_at", "ts_coerce"), ("createdAtTime", "created_at_time", "ts_coerce"),
        ("paymentGateway", "payment_gateway", "string"), ("paymentBrand", "payment_brand", "string"),
        ("pickup", "pickup", "boolean"), ("pickupComplete", "pickup_complete", "boolean"),
        ("source", "source", "string"), ("tenant", "tenant", "string"),
        ("paymentAttempts", "payment_attempts", "integer"),
        ("timeZone", "time_zone", "string"), ("clientInfo", "client_info", "string"),
    ],
    "order_details": [
        ("item.uid", "item_uid", "string"), ("order.uid", "order_uid", "string"),
        ("item.status", "item_status", "string"), ("item.date", "item_date", "ts_coerce"),
        ("product.uid", "product_uid", "string"),
        ("product.dynamicPricing", "product_dynamic_pricing", "boolean"),
        ("item.amount", "item_amount", "double"), ("item.discount", "item_discount", "boolean"),
        ("product.type", "product_type", "string"), ("item.zoneName", "item_zone_name", "string"),
        ("product.durationHours", "product_duration_hours", "double"),
        ("item.profiles", "item_profiles", "string"), ("item.variantName", "item_variant_name", "string"),
        ("item.slotName", "item_slot_name", "string"),
    ],
    "reviews": [
        ("review.uid", "review_uid", "string"), ("user.uid", "user_uid", "string"),
        ("text", "text", "string"),
    ],
    "reviews_labelled": [
        ("labelled_review.uid", "labelled_review_uid", "string"), ("text", "text", "string"),
        ("sentiment_label", "sentiment_label", "string"),
    ],
}


# Columns known by a pattern of their header: (entity, header pattern, Spark name, target type).
PATTERN_COLUMNS = [("order_details", r"item\..*cardNumber", "item_card_number", "string")]

# Entities with free text, whose quoted fields may hold line breaks.
FREE_TEXT_ENTITIES = ["reviews", "reviews_labelled"]

