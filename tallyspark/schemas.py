"""Table schemas, label domains and fixed orders."""

from pyspark.sql import types as T

_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()
_B, _D = T.BooleanType(), T.DoubleType()


def _struct(*fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# ---------------------------------------------------------------------------
# Base tables
# ---------------------------------------------------------------------------
USER_PROFILES = _struct(
    ("user_id", _S),
    ("city", _S),
    ("age_group", _S),
    ("gender", _S),
    ("account_tenure", _S),
    ("customer_tier", _S),
    ("spending_persona", _S),
    ("preferred_method", _S),
)

TRANSACTIONS = _struct(
    ("transaction_id", _S),
    ("user_id", _S),
    ("transaction_datetime", T.TimestampNTZType()),
    ("payment_method", _S),
    ("category", _S),
    ("merchant", _S),
    ("amount", T.DecimalType(12, 2)),
    ("status", _S),
    ("failure_reason", _S),
    ("platform", _S),
    ("device_type", _S),
    ("city", _S),
    ("processing_time_sec", T.DecimalType(5, 2)),
    ("is_weekend", _I),
    ("cashback_earned", T.DecimalType(10, 2)),
    ("discount_applied", T.DecimalType(10, 2)),
    ("is_flagged", _B),
    ("fraud_reason", _S),
    ("is_refunded", _B),
    ("refund_amount", T.DecimalType(12, 2)),
)

# Columns that may not be NULL; the rest (the two reasons) may.
TRANSACTION_REQUIRED = [
    f.name for f in TRANSACTIONS if f.name not in ("failure_reason", "fraud_reason")
]
PROFILE_ATTRIBUTES = [f.name for f in USER_PROFILES if f.name not in ("user_id", "city")]

# ---------------------------------------------------------------------------
# Label domains
# ---------------------------------------------------------------------------
STATUSES = ["Success", "Failed", "Pending"]
PAYMENT_METHODS = ["UPI", "Credit Card", "Debit Card", "Net Banking", "Mobile Wallet"]
CATEGORIES = [
    "Food & Dining", "Shopping", "Bills & Utilities", "Travel", "Entertainment",
    "Health", "Education", "Transfers", "Groceries", "Investments",
]
PLATFORMS = ["Mobile App", "Web Browser", "POS Terminal", "QR Code"]
FAILURE_REASONS = {
    "UPI": ["Server Timeout", "Insufficient Balance", "Invalid UPI ID",
            "Bank Server Down", "Transaction Limit Exceeded"],
    "Credit Card": ["Card Declined", "Insufficient Limit", "CVV Mismatch",
                    "Card Expired", "3D Auth Failed"],
    "Debit Card": ["Insufficient Balance", "Card Blocked", "PIN Incorrect",
                   "Daily Limit Exceeded", "Bank Server Down"],
    "Net Banking": ["Session Expired", "OTP Failed", "Bank Server Down",
                    "Authentication Failed", "Timeout"],
    "Mobile Wallet": ["Insufficient Balance", "Wallet Limit Exceeded", "KYC Pending",
                      "Server Error", "Invalid PIN"],
}
HIGH_AMOUNT_THRESHOLDS = {
    "Food & Dining": 2000, "Shopping": 12000, "Bills & Utilities": 4000,
    "Travel": 10000, "Entertainment": 1200, "Health": 6000, "Education": 15000,
    "Transfers": 40000, "Groceries": 3000, "Investments": 80000,
}
DEFAULT_HIGH_AMOUNT = 50000
LATE_NIGHT_AMOUNT = 5000
HIGH_AMOUNT_REASON = "Unusually High Amount"
LATE_NIGHT_REASON = "Suspicious Late Night Transaction"

# Ordinal levels, lowest first
AGE_GROUPS = ["18-24", "25-34", "35-44", "45-54", "55+"]
GENDERS = ["Male", "Female", "Other"]
TENURES = ["0-6 months", "6-12 months", "1-2 years", "2-5 years", "5+ years"]
TIERS = ["New", "Regular", "Premium", "VIP"]
PERSONAS = ["Budget", "Moderate", "High Spender", "Impulse"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
TIME_BUCKETS = ["Morning", "Afternoon", "Evening", "Night"]
SPEEDS = ["Instant", "Fast", "Normal", "Slow", "Very Slow"]
SEGMENTS = ["Power User (20+)", "Regular User (10-19)", "Occasional User (5-9)",
            "Rare User (1-4)"]

# Small dimensions
PAYMENT_METHOD_ROWS = [
    ("UPI", "Digital Wallet", 0.06),
    ("Credit Card", "Card", 0.04),
    ("Debit Card", "Card", 0.08),
    ("Net Banking", "Banking", 0.10),
    ("Mobile Wallet", "Digital Wallet", 0.05),
]
CATEGORY_ROWS = [
    ("Food & Dining", "Lifestyle"),
    ("Shopping", "Lifestyle"),
    ("Groceries", "Lifestyle"),
    ("Entertainment", "Lifestyle"),
    ("Travel", "Travel & Utilities"),
    ("Bills & Utilities", "Travel & Utilities"),
    ("Health", "Health & Education"),
    ("Education", "Health & Education"),
    ("Transfers", "Financial"),
    ("Investments", "Financial"),
]
PLATFORM_ROWS = [
    ("Mobile App", "Mobile"),
    ("QR Code", "Mobile"),
    ("Web Browser", "Web"),
    ("POS Terminal", "Physical"),
]

# ---------------------------------------------------------------------------
# Enriched table: 52 columns in their published order
# ---------------------------------------------------------------------------
ENRICHED_COLUMNS = [
    "transaction_id", "user_id",
    "transaction_datetime", "date", "year", "month", "month_name", "quarter",
    "quarter_label", "day", "day_of_week", "day_name", "hour", "time_bucket",
    "week_number", "is_weekend", "is_month_start", "is_month_end", "is_festival_season",
    "payment_method", "category", "merchant", "platform", "device_type", "city",
    "amount", "amount_bucket", "discount_applied", "cashback_earned", "total_savings",
    "savings_pct", "net_amount",
    "status", "failure_reason", "processing_time_sec", "processing_speed",
    "is_flagged", "fraud_reason", "is_refunded", "refund_amount",
    "age_group", "gender", "account_tenure", "customer_tier", "spending_persona",
    "preferred_method", "user_home_city",
    "user_total_txns", "user_total_spend", "user_avg_txn_amount",
    "user_failure_rate_pct", "user_spending_tier",
]

# ---------------------------------------------------------------------------
# Star schema as exchanged in CSV
# ---------------------------------------------------------------------------
FACT_TRANSACTIONS = _struct(
    ("transaction_id", _S), ("user_id", _S), ("date_key", _L),
    ("transaction_datetime", T.TimestampNTZType()), ("hour", _L), ("time_bucket", _S),
    ("payment_method", _S), ("category", _S), ("merchant", _S), ("platform", _S),
    ("device_type", _S), ("city", _S),
    ("amount", _D), ("amount_bucket", _S), ("net_amount", _D), ("cashback_earned", _D),
    ("discount_applied", _D), ("total_savings", _D), ("savings_pct", _D),
    ("status", _S), ("is_success", _L), ("is_failed", _L), ("is_pending", _L),
    ("failure_reason", _S), ("processing_time_sec", _D), ("processing_speed", _S),
    ("is_flagged", _B), ("is_flagged_int", _L), ("fraud_reason", _S),
    ("is_refunded", _B), ("is_refunded_int", _L), ("refund_amount", _D),
)
DIM_DATE = _struct(
    ("date_key", _L), ("date", T.TimestampNTZType()), ("year", _L), ("month", _L),
    ("month_name", _S), ("month_year", _S), ("quarter", _L), ("quarter_label", _S),
    ("day", _L), ("day_of_week", _L), ("day_name", _S), ("week_number", _L),
    ("is_weekend", _L), ("is_month_start", _L), ("is_month_end", _L),
    ("is_festival_season", _L),
)
DIM_USERS = _struct(
    ("user_id", _S), ("age_group", _S), ("gender", _S), ("account_tenure", _S),
    ("customer_tier", _S), ("spending_persona", _S), ("preferred_method", _S),
    ("user_home_city", _S), ("user_total_txns", _L), ("user_total_spend", _D),
    ("user_avg_txn_amount", _D), ("user_failure_rate_pct", _D), ("user_spending_tier", _S),
)
DIM_PAYMENT_METHOD = _struct(
    ("payment_method", _S), ("payment_type", _S), ("base_failure_rate", _D)
)
DIM_CATEGORY = _struct(("category", _S), ("category_group", _S))
DIM_PLATFORM = _struct(("platform", _S), ("channel", _S))

STAR_TABLES = {
    "fact_transactions": FACT_TRANSACTIONS,
    "dim_date": DIM_DATE,
    "dim_users": DIM_USERS,
    "dim_payment_method": DIM_PAYMENT_METHOD,
    "dim_category": DIM_CATEGORY,
    "dim_platform": DIM_PLATFORM,
}
FACT_COLUMNS = FACT_TRANSACTIONS.fieldNames()
