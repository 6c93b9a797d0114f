"""DuckDB SQL for every registered query."""

from oracles.tables import with_tables
from oracles.text import BAD, OK, PENDING, avg, avg2, half_up, money, n, pct, share

SQL = {}
HOUR = "CAST(hour(transaction_datetime) AS INT)"
MONTH = "strftime(transaction_datetime, '%Y-%m')"
TS = "strftime(transaction_datetime, '%Y-%m-%d %H:%M:%S') AS transaction_datetime"
USERS = "count(DISTINCT user_id)"
N = "count(*)"
SR = pct(OK)
FR = pct(BAD)
PT = avg2("processing_time_sec")
CASH = money("cashback_earned")
SEASON = """CASE WHEN month(transaction_datetime) IN (10, 11) THEN 'Festival Season'
  WHEN month(transaction_datetime) IN (1, 8, 12) THEN 'Sale Season' ELSE 'Normal' END"""
DAY_TYPE = "CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END"
MOBILE = "device_type IN ('Android', 'iOS')"
SEGMENT = """CASE WHEN txn_count >= 20 THEN 'Power User (20+)'
  WHEN txn_count >= 10 THEN 'Regular User (10-19)'
  WHEN txn_count >= 5 THEN 'Occasional User (5-9)' ELSE 'Rare User (1-4)' END"""


def group(table, keys, columns, where=None, tail="", not_null=()):
    """``SELECT keys, columns FROM table GROUP BY ALL``; columns as {alias: sql}."""
    keys = [keys] if isinstance(keys, str) else keys
    shown = [*keys, *[f"{sql} AS {name}" for name, sql in columns.items()]]
    conditions = [*([f"({where})"] if where else []), *[f"{k} IS NOT NULL" for k in not_null]]
    where = f" WHERE {' AND '.join(conditions)}" if conditions else ""
    by = " GROUP BY ALL" if keys else ""
    return f"SELECT {', '.join(shown)} FROM {table}{where}{by} {tail}"


def doubles(table, columns, extra=""):
    """Row-level columns with decimals, dates and timestamps in comparable form."""
    forms = {"amount", "refund_amount", "cashback_earned", "discount_applied",
             "processing_time_sec", "net_amount", "total_savings"}
    out = []
    for c in columns:
        if c in forms:
            out.append(f"CAST({c} AS DOUBLE) AS {c}")
        elif c == "transaction_datetime":
            out.append(TS)
        elif c in ("date", "txn_date"):
            out.append(f"CAST({c} AS VARCHAR) AS {c}")
        elif c == "savings_pct":
            out.append("savings_bp::DOUBLE / 100 AS savings_pct")
        else:
            out.append(c)
    return f"SELECT {', '.join(out)}{extra} FROM {table}"


BASE = ["transaction_id", "user_id", "transaction_datetime", "payment_method", "category",
        "merchant", "amount", "status", "failure_reason", "platform", "device_type", "city",
        "processing_time_sec", "is_weekend", "cashback_earned", "discount_applied", "is_flagged",
        "fraud_reason", "is_refunded", "refund_amount"]
PROFILE = ["age_group", "gender", "account_tenure", "customer_tier", "spending_persona",
           "preferred_method"]
ENRICHED = [
    "transaction_id", "user_id", "transaction_datetime", "date", "year", "month", "month_name",
    "quarter", "quarter_label", "day", "day_of_week", "day_name", "hour", "time_bucket",
    "week_number", "is_weekend", "is_month_start", "is_month_end", "is_festival_season",
    "payment_method", "category", "merchant", "platform", "device_type", "city", "amount",
    "amount_bucket", "discount_applied", "cashback_earned", "total_savings", "savings_pct",
    "net_amount", "status", "failure_reason", "processing_time_sec", "processing_speed",
    "is_flagged", "fraud_reason", "is_refunded", "refund_amount", *PROFILE, "user_home_city",
    "user_total_txns", "user_total_spend", "user_avg_txn_amount", "user_failure_rate_pct",
    "user_spending_tier",
]
E_FROM = "(SELECT tu.*, ub.* EXCLUDE (user_id) FROM tu LEFT JOIN ub ON tu.user_id = ub.user_id)"

# --------------------------------------------------------------------------- sources and sinks
SQL["src_1_users_csv"] = """SELECT CAST(user_id AS VARCHAR) AS user_id, city, age_group, gender,
  account_tenure, customer_tier, spending_persona, preferred_method FROM user_profiles"""
SQL["src_2_transactions_csv"] = doubles(
    "ct", [c for c in BASE if c not in ("transaction_id", "user_id")],
    ", CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id")
SQL["src_3_raw_pair_methods_by_tier"] = group("tu", ["customer_tier", "payment_method"], {"n": N})
SQL["src_4_enriched_csv_reread"] = f"""SELECT CAST(transaction_id AS VARCHAR) AS transaction_id,
  CAST(date AS VARCHAR) AS date, failure_reason, fraud_reason,
  CAST(net_amount AS DOUBLE) AS net_amount, savings_bp::DOUBLE / 100 AS savings_pct, is_flagged,
  user_total_spend, user_failure_rate_pct,
  strftime(transaction_datetime, '%Y %b') AS year_month_label FROM {E_FROM}"""
CHANNEL = """CASE platform WHEN 'Mobile App' THEN 'Mobile' WHEN 'QR Code' THEN 'Mobile'
  WHEN 'Web Browser' THEN 'Web' WHEN 'POS Terminal' THEN 'Physical' END"""
SQL["src_5_star_csv_load"] = group("ft", f"{CHANNEL} AS channel", {"total_transactions": N})
SQL["snk_1_enriched_parquet"] = doubles(E_FROM, ENRICHED)
SQL["snk_2_star_parquet"] = """SELECT 'fact_transactions' AS table_name, count(*) AS row_count FROM ft
  UNION ALL SELECT 'dim_date', count(DISTINCT date) FROM ft
  UNION ALL SELECT 'dim_users', count(DISTINCT user_id) FROM ft
  UNION ALL SELECT 'dim_payment_method', 5 UNION ALL SELECT 'dim_category', 10
  UNION ALL SELECT 'dim_platform', 4"""
SQL["snk_4_raw_export"] = """SELECT transaction_id AS "Transaction ID", user_id AS "User ID",
  strftime(transaction_datetime, '%Y-%m-%d %H:%M:%S') AS "DateTime",
  payment_method AS "Payment Method", category AS "Category", merchant AS "Merchant",
  CAST(amount AS DOUBLE) AS "Amount (₹)", status AS "Status",
  coalesce(failure_reason, '') AS "Failure Reason", platform AS "Platform", city AS "City",
  CAST(processing_time_sec AS DOUBLE) AS "Processing Time (s)" FROM transactions"""

# --------------------------------------------------------------------------- cleaning
SQL["cln_1_3_typing"] = f"""SELECT transaction_id, {TS},
  CASE WHEN failure_reason = 'Server Timeout' THEN NULL ELSE CAST(amount AS DOUBLE) END AS amount,
  CAST(processing_time_sec AS DOUBLE) AS processing_time_sec,
  CAST(cashback_earned AS DOUBLE) AS cashback_earned,
  CAST(discount_applied AS DOUBLE) AS discount_applied,
  CAST(refund_amount AS DOUBLE) AS refund_amount, is_flagged, is_refunded, is_weekend
  FROM (SELECT * REPLACE (CAST(transaction_id AS VARCHAR) AS transaction_id) FROM transactions)"""
SQL["cln_4_reasons_filled"] = """SELECT transaction_id,
  coalesce(failure_reason, 'None') AS failure_reason, coalesce(fraud_reason, 'None') AS fraud_reason
  FROM transactions"""
SQL["cln_5_strip_white_space"] = """SELECT transaction_id, trim(category) AS category, merchant,
  status, city FROM transactions"""
SQL["cln_6_missing_reason_unknown"] = """SELECT transaction_id, status, 'Unknown' AS failure_reason
  FROM transactions WHERE status = 'Failed' AND failure_reason IS NULL"""
SQL["cln_7_success_reason_cleared"] = """SELECT transaction_id,
  CAST(NULL AS VARCHAR) AS failure_reason FROM transactions WHERE status = 'Success'"""
SQL["cln_8_fraud_reason_cleared"] = """SELECT transaction_id, is_flagged,
  CASE WHEN is_flagged THEN fraud_reason END AS fraud_reason FROM transactions"""
SQL["cln_9_refund_withdrawn"] = """SELECT transaction_id, false AS is_refunded,
  CAST(0 AS DOUBLE) AS refund_amount FROM transactions WHERE status <> 'Success'"""
SQL["cln_10_refund_capped"] = """SELECT transaction_id, CAST(amount AS DOUBLE) AS amount,
  CAST(least(refund_amount, amount) AS DOUBLE) AS refund_amount
  FROM transactions WHERE is_refunded AND status = 'Success'"""
SQL["cln_11_trim_transactions"] = """SELECT transaction_id, payment_method, category, merchant, city,
  platform, device_type, failure_reason, fraud_reason FROM ct"""
SQL["cln_12_trim_profiles"] = "SELECT * FROM user_profiles"
SQL["cln_all_cleaned_rows"] = doubles("ct", BASE)

# --------------------------------------------------------------------------- derived columns
SQL["drv_1_date_parts"] = f"""SELECT transaction_id,
  strftime(transaction_datetime, '%Y-%m-%d') AS txn_date, {HOUR} AS txn_hour,
  dayname(transaction_datetime) AS txn_day_of_week, {MONTH} AS txn_month,
  CAST(quarter(transaction_datetime) AS INT) AS txn_quarter FROM transactions"""
SQL["drv_2_amount_bucket"] = "SELECT transaction_id, amount_bucket FROM ft"
SQL["drv_2w_amount_bucket_workbook"] = """SELECT transaction_id, CASE WHEN amount <= 0 THEN NULL
  WHEN amount <= 500 THEN 'Micro (<500)' WHEN amount <= 2000 THEN 'Small (500-2K)'
  WHEN amount <= 5000 THEN 'Medium (2K-5K)' WHEN amount <= 10000 THEN 'Large (5K-10K)'
  WHEN amount <= 50000 THEN 'High Value (10K+)' END AS amount_bucket FROM transactions"""
FRAUD5 = """CASE WHEN h <= 4 THEN 'Late Night (12-5 AM)' WHEN h <= 11 THEN 'Morning (5 AM-12 PM)'
  WHEN h <= 16 THEN 'Afternoon (12-5 PM)' WHEN h <= 21 THEN 'Evening (5-10 PM)'
  ELSE 'Night (10 PM-12 AM)' END"""
SLOT_SQL = """CASE WHEN h >= 5 AND h <= 11 THEN 'Morning' WHEN h >= 12 AND h <= 16 THEN 'Afternoon'
  WHEN h >= 17 AND h <= 21 THEN 'Evening' ELSE 'Night' END"""
SLOT_WB = """CASE WHEN h <= 5 THEN 'Night' WHEN h <= 11 THEN 'Morning' WHEN h <= 16 THEN 'Afternoon'
  WHEN h <= 21 THEN 'Evening' ELSE 'Night' END"""
SQL["drv_3_time_slots"] = f"""SELECT transaction_id, {SLOT_SQL} AS slot_sql,
  CASE WHEN h = 21 THEN 'Night' ELSE {SLOT_SQL} END AS slot_pipeline,
  {SLOT_WB} AS slot_workbook, {FRAUD5} AS slot_fraud5
  FROM (SELECT transaction_id, hour(transaction_datetime) AS h FROM transactions)"""
SQL["drv_4_net_amount"] = """SELECT transaction_id,
  CAST(greatest(amount - discount_applied - cashback_earned, 0) AS DOUBLE) AS net_amount FROM dirty"""
SQL["drv_5_total_savings"] = """SELECT transaction_id,
  CAST(cashback_earned + discount_applied AS DOUBLE) AS total_savings FROM transactions"""
SQL["drv_6_festival_season"] = "SELECT transaction_id, is_festival_season FROM ft"
SQL["drv_7_processing_speed"] = "SELECT transaction_id, processing_speed FROM ft"
SQL["drv_8_9_calendar"] = doubles("ft", ["transaction_id", "date", "year", "month", "month_name",
                                         "day", "day_of_week", "day_name", "hour", "week_number",
                                         "quarter", "quarter_label"])
SQL["drv_10_month_edges"] = "SELECT transaction_id, is_month_end, is_month_start FROM ft"
SQL["drv_11_savings_pct"] = doubles("ft", ["transaction_id", "savings_pct"])
SQL["drv_12_season_type"] = f"SELECT transaction_id, {SEASON} AS season_type FROM transactions"
TIER = """CASE WHEN cashback_earned + discount_applied = 0 THEN 'No Promotion'
  WHEN cashback_earned + discount_applied < 200 THEN 'Low Savings (<₹200)'
  WHEN cashback_earned + discount_applied < 500 THEN 'Medium Savings (₹200-500)'
  ELSE 'High Savings (₹500+)' END"""
SQL["drv_13_savings_tier"] = f"SELECT transaction_id, {TIER} AS savings_tier FROM transactions"
SQL["drv_14_user_segment"] = f"""SELECT user_id, txn_count, {SEGMENT} AS user_segment
  FROM (SELECT user_id, count(*) AS txn_count FROM transactions GROUP BY user_id)"""
SQL["drv_15_user_spending_tier"] = "SELECT user_id, user_total_spend, user_spending_tier FROM ub"
SQL["drv_16_day_type"] = f"SELECT transaction_id, {DAY_TYPE} AS day_type FROM transactions"
SQL["drv_17_date_key"] = """SELECT transaction_id,
  CAST(strftime(transaction_datetime, '%Y%m%d') AS INT) AS date_key,
  strftime(transaction_datetime, '%b %Y') AS month_year FROM transactions"""
SQL["drv_18_status_flags"] = """SELECT transaction_id, CAST(status = 'Success' AS INT) AS is_success,
  CAST(status = 'Failed' AS INT) AS is_failed, CAST(status = 'Pending' AS INT) AS is_pending,
  CAST(is_flagged AS INT) AS is_flagged_int, CAST(is_refunded AS INT) AS is_refunded_int
  FROM transactions"""
SQL["drv_19_year_month_label"] = """SELECT transaction_id,
  strftime(transaction_datetime, '%Y %b') AS year_month_label FROM transactions"""
SQL["drv_20_refund_type"] = """SELECT transaction_id, CASE WHEN refund_amount >= amount * 0.99
  THEN 'Full Refund' ELSE 'Partial Refund' END AS refund_type,
  refund_amount = amount AS is_exact_full FROM transactions WHERE is_refunded"""
SQL["drv_21_flag_label"] = """SELECT transaction_id,
  CASE WHEN is_flagged THEN 'Flagged' ELSE 'Normal' END AS flag_label FROM transactions"""
SQL["drv_22_clipped_amount"] = """SELECT transaction_id,
  CAST(least(amount, 50000) AS DOUBLE) AS clipped_amount FROM transactions"""
SQL["drv_23_status_bands"] = f"""SELECT payment_method, f AS failure_rate,
  CASE WHEN s >= 95 THEN 'good' WHEN s >= 90 THEN 'warn' ELSE 'bad' END AS success,
  CASE WHEN f <= 2 THEN 'good' WHEN f <= 5 THEN 'warn' ELSE 'bad' END AS fraud,
  CASE WHEN s > 90 THEN 'good' WHEN s > 85 THEN 'warn' ELSE 'bad' END AS dashboard_success,
  CASE WHEN s > 92 THEN 'good' WHEN s > 88 THEN 'warn' ELSE 'bad' END AS chart_success,
  CASE WHEN f > 8 THEN 'bad' WHEN f > 5 THEN 'warn' ELSE 'good' END AS chart_failure
  FROM (SELECT payment_method, {share(BAD)} AS f, 100.0::DOUBLE - f AS s
        FROM ft GROUP BY payment_method)"""


def unit_text(value_cents, unit, suffix, sign="₹"):
    """Text of cents / unit, two decimals, half up."""
    hundredths = f"((2 * {value_cents} + {unit}) // (2 * {unit}))"
    return (f"'{sign}' || ({hundredths} // 100) || '.' || "
            f"lpad(CAST({hundredths} % 100 AS VARCHAR), 2, '0') || '{suffix}'")


SQL["drv_24_unit_scaling"] = f"""SELECT payment_method, v / 10000000 AS lost_crore,
  v / 100000 AS lost_lakh, v / 1000 AS lost_thousand, {unit_text('c', 10000000, ' Cr')} AS text_crore,
  {unit_text('c', 100000, ' L')} AS text_lakh, {unit_text('c', 1000, ' K')} AS text_thousand
  FROM (SELECT payment_method, CAST(sum(amount) AS DOUBLE) AS v, CAST(sum(amount) * 100 AS HUGEINT) AS c
        FROM transactions WHERE status = 'Failed' GROUP BY payment_method)"""
SQL["drv_25_home_city"] = f"SELECT user_id, {', '.join(PROFILE)}, city AS user_home_city FROM user_profiles"
SQL["drv_26_screening_rules"] = """SELECT transaction_id, fraud_reason IS NOT NULL AS rule_flag,
  fraud_reason AS rule_reason FROM transactions"""

# --------------------------------------------------------------------------- filters
for _name, _where in {
    "flt_1_equality": "status = 'Failed' OR (is_flagged AND is_refunded)",
    "flt_2_in_list": MOBILE,
    "flt_3_between_hours": "hour(transaction_datetime) BETWEEN 17 AND 21",
    "flt_4_null_or_empty": "coalesce(failure_reason, '') = ''",
    "flt_5_column_to_column": "refund_amount < amount AND refund_amount > 0",
    "flt_6_not_equal": "status <> 'Failed'",
    "flt_8_positive_values": "cashback_earned > 0 OR discount_applied > 0",
}.items():
    SQL[_name] = f"SELECT transaction_id, user_id FROM transactions WHERE {_where}"
SQL["flt_7_later_than"] = """SELECT transaction_id FROM transactions
  WHERE transaction_datetime > TIMESTAMP '2001-01-01 00:00:00'"""
PICKED = """date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
  AND payment_method IN ('UPI', 'Credit Card', 'Net Banking')
  AND category IN ('Shopping', 'Travel', 'Transfers', 'Groceries')"""
OVERVIEW = {"total_txn": N, "success_txn": n(OK), "success_rate": f"coalesce({share(OK)}, 0)",
            "total_volume": money("amount", OK, zero=True),
            "avg_txn": f"coalesce({avg('amount', OK)}, 0)", "unique_users": USERS,
            "total_cashback": money("cashback_earned", zero=True),
            "fraud_count": n("is_flagged"), "refund_count": n("is_refunded")}
SQL["flt_9_slicer"] = f"SELECT transaction_id, payment_method, category FROM ft WHERE {PICKED}"
SQL["flt_9_slicer_inverted_dates"] = group("ft", [], OVERVIEW, PICKED)
SQL["flt_10_preset_all"] = group("ft", [], OVERVIEW)
SQL["flt_10_presets"] = """SELECT '1999' AS preset, count(*) AS rows FROM ft WHERE year(date) = 1999
  UNION ALL SELECT '2000', count(*) FROM ft WHERE year(date) = 2000
  UNION ALL SELECT '6M', count(*) FROM ft WHERE date >= DATE '2000-07-01'
  UNION ALL SELECT 'All', count(*) FROM ft"""
SQL["flt_11_option_lists"] = """SELECT DISTINCT 'payment_method' AS field, payment_method AS option FROM ft
  UNION ALL SELECT DISTINCT 'status', status FROM ft UNION ALL SELECT DISTINCT 'city', city FROM ft
  UNION ALL SELECT DISTINCT 'category', category FROM ft"""
SQL["flt_11_date_bounds"] = """SELECT CAST(min(date) AS VARCHAR) AS date_min,
  CAST(max(date) AS VARCHAR) AS date_max FROM ft"""
SQL["flt_12_coverage"] = f"""SELECT {n(PICKED)} AS kept_rows, count(*) AS total_rows,
  {share(PICKED)} AS kept_pct FROM ft"""
SQL["flt_13_dimension_slicers"] = group("tu", "payment_method", {
    "total_transactions": N, "total_revenue": money("amount", OK), "unique_users": USERS,
}, """customer_tier IN ('Premium', 'VIP') AND age_group IN ('25-34', '35-44')
  AND platform IN ('Mobile App', 'QR Code') AND payment_method <> 'Net Banking'
  AND date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""")
SQL["flt_14_having"] = """SELECT transaction_id, count(*) AS cnt FROM dirty
  GROUP BY transaction_id HAVING count(*) > 1"""

# --------------------------------------------------------------------------- joins
SQL["jn_1_inner_profile"] = """SELECT transaction_id, d.user_id, age_group, customer_tier
  FROM dirty d JOIN user_profiles u ON d.user_id = u.user_id"""
SQL["jn_2_left_profile"] = """SELECT transaction_id, d.user_id, age_group, customer_tier
  FROM dirty d LEFT JOIN user_profiles u ON d.user_id = u.user_id"""
SQL["jn_3_orphan_rows"] = """SELECT transaction_id, d.user_id FROM dirty d
  LEFT JOIN user_profiles u ON d.user_id = u.user_id WHERE u.user_id IS NULL"""
SQL["jn_4_orphan_ids"] = """SELECT count(DISTINCT d.user_id) AS orphan_user_ids FROM dirty d
  LEFT JOIN user_profiles u ON d.user_id = u.user_id WHERE u.user_id IS NULL"""
SQL["jn_5_user_features_attached"] = f"""SELECT transaction_id, user_total_txns, user_total_spend,
  user_avg_txn_amount, user_failure_rate_pct, user_spending_tier FROM {E_FROM}"""
SQL["jn_6_tier_merge_filled"] = group("tu", "customer_tier", {
    "count": N, "users": USERS, "volume": money("amount", OK, zero=True)}, "status <> 'Success'")
PAY_TYPE = """CASE payment_method WHEN 'UPI' THEN 'Digital Wallet' WHEN 'Credit Card' THEN 'Card'
  WHEN 'Debit Card' THEN 'Card' WHEN 'Net Banking' THEN 'Banking' ELSE 'Digital Wallet' END"""
CAT_GROUP = """CASE WHEN category IN ('Food & Dining','Shopping','Groceries','Entertainment')
  THEN 'Lifestyle' WHEN category IN ('Travel','Bills & Utilities') THEN 'Travel & Utilities'
  WHEN category IN ('Health','Education') THEN 'Health & Education' ELSE 'Financial' END"""
SQL["jn_7_star_join"] = group("tu", [
    "quarter_label", f"{PAY_TYPE} AS payment_type", f"{CAT_GROUP} AS category_group",
    f"{CHANNEL} AS channel", "customer_tier",
], {"total_transactions": N, "total_revenue": money("amount", OK)})
DAYS = """(SELECT date, sum(amount) FILTER (WHERE status = 'Success') AS revenue,
  count(*) AS transactions FROM ft GROUP BY date)"""
SQL["jn_8_period_self_join"] = f"""SELECT CAST(c.date AS VARCHAR) AS date,
  CAST(c.revenue AS DOUBLE) AS revenue, c.transactions, CAST(p.revenue AS DOUBLE) AS revenue_pm,
  p.transactions AS transactions_pm FROM {DAYS} c LEFT JOIN {DAYS} p
  ON CAST(c.date - INTERVAL 1 MONTH AS DATE) = p.date"""

# --------------------------------------------------------------------------- data quality
SQL["dq_1_row_counts"] = """SELECT 'user_profiles' AS table_name, count(*) AS row_count FROM user_profiles
  UNION ALL SELECT 'transactions', count(*) FROM transactions"""
SQL["dq_2_critical_nulls"] = group("transactions", [], {
    "null_txn_id": n("transaction_id IS NULL"), "null_user_id": n("user_id IS NULL"),
    "null_amount": n("amount IS NULL"), "null_status": n("status IS NULL"),
    "null_device": n("device_type IS NULL")})
SQL["dq_3_orphan_transactions"] = """SELECT count(*) AS orphan_transactions FROM dirty d
  LEFT JOIN user_profiles u ON d.user_id = u.user_id WHERE u.user_id IS NULL"""
SQL["dq_4_duplicate_ids"] = SQL["flt_14_having"]
SQL["dq_4b_duplicate_rows"] = "SELECT count(*) - count(DISTINCT transaction_id) AS duplicate_rows FROM dirty"
SQL["dq_5_statuses"] = "SELECT DISTINCT status FROM transactions"
NO_REASON = f"{BAD} AND coalesce(failure_reason, '') = ''"
HAS_REASON = f"{OK} AND coalesce(failure_reason, '') <> ''"
SQL["dq_6_invalid_amounts"] = group("dirty", [], {"invalid_amounts": n("amount <= 0")})
SQL["dq_7_future_dated"] = group("dirty", [], {
    "future_txn": n("transaction_datetime > TIMESTAMP '2001-01-01'")})
SQL["dq_8_missing_reasons"] = group("dirty", [], {"missing_reasons": n(NO_REASON)})
SQL["dq_9_incorrect_reasons"] = group("dirty", [], {"incorrect_reasons": n(HAS_REASON)})
SQL["dq_10_negative_promotions"] = group("dirty", [], {
    "negative_cashback": n("cashback_earned < 0"), "negative_discount": n("discount_applied < 0")})
SQL["dq_11_invalid_refunds"] = group("dirty", [], {
    "invalid_refunds": n("is_refunded AND status <> 'Success'")})
SQL["dq_12_over_refunds"] = group("dirty", [], {
    "over_refunds": n("is_refunded AND refund_amount > amount")})
SQL["dq_13_invalid_fraud_reasons"] = group("dirty", [], {
    "invalid_fraud_reasons": n("NOT is_flagged AND coalesce(fraud_reason, '') <> ''")})
SQL["dq_14_device_platforms"] = "SELECT DISTINCT device_type, platform FROM transactions"
SQL["dq_15_weekend_by_day"] = group("transactions", [
    "is_weekend", "dayname(transaction_datetime) AS day_name"], {"cnt": N})
CARD = {"total_rows": N, "failed_without_reason": n(f"{BAD} AND failure_reason IS NULL"),
        "success_with_reason": n(f"{OK} AND failure_reason IS NOT NULL"),
        "invalid_refunds": n("is_refunded AND status <> 'Success'"),
        "over_refunds": n("refund_amount > amount"),
        "negative_cashback": n("cashback_earned < 0"),
        "orphan_fraud_reasons": n("NOT is_flagged AND fraud_reason IS NOT NULL")}
SQL["dq_16_scorecard_cleaned"] = group("ct", [], CARD)
SQL["dq_16_scorecard_dirty"] = group("dirty", [], CARD)
SQL["dq_17_null_profile"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {n(f'{c} IS NULL')} AS n_null FROM transactions" for c in BASE
) + " UNION ALL SELECT 'TOTAL', " + " + ".join(n(f"{c} IS NULL") for c in BASE) + " FROM transactions"
RULES = {
    ("dirty", "status_domain"): "status NOT IN ('Success', 'Failed', 'Pending')",
    ("dirty", "amount_positive"): "amount <= 0",
    ("dirty", "processing_positive"): "processing_time_sec <= 0",
    ("dirty", "cashback_not_negative"): "cashback_earned < 0",
    ("dirty", "discount_not_negative"): "discount_applied < 0",
    ("dirty", "refund_not_negative"): "refund_amount < 0",
    ("user_profiles", "age_group_domain"):
        "age_group NOT IN ('18-24', '25-34', '35-44', '45-54', '55+')",
    ("user_profiles", "gender_domain"): "gender NOT IN ('Male', 'Female', 'Other')",
    ("user_profiles", "tier_domain"): "customer_tier NOT IN ('New', 'Regular', 'Premium', 'VIP')",
    ("user_profiles", "persona_domain"):
        "spending_persona NOT IN ('Budget', 'Moderate', 'High Spender', 'Impulse')",
}
SQL["dq_18_check_rules"] = " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, {n(bad)} AS n_violations FROM {table}"
    for (table, rule), bad in RULES.items())
SQL["dq_19_key_rules"] = " UNION ALL ".join([
    *[f"SELECT 'transaction_{c}_required' AS rule, {n(f'{c} IS NULL')} AS n_violations FROM dirty"
      for c in BASE if c not in ("failure_reason", "fraud_reason")],
    *[f"SELECT 'profile_{c}_required', {n(f'{c} IS NULL')} FROM user_profiles"
      for c in ["user_id", "city", *PROFILE]],
    "SELECT 'transaction_primary_key', count(*) - count(DISTINCT transaction_id) FROM dirty",
    "SELECT 'profile_primary_key', count(*) - count(DISTINCT user_id) FROM user_profiles",
    "SELECT 'transaction_user_fk', count(*) FROM dirty WHERE user_id NOT IN "
    "(SELECT user_id FROM user_profiles)",
])
SQL["dq_20_amount_profile"] = """SELECT count(amount) AS count,
  round(CAST(sum(amount) AS DOUBLE) / count(amount), 4) AS mean,
  round(stddev_samp(CAST(amount AS DOUBLE)), 4) AS std, CAST(min(amount) AS DOUBLE) AS min,
  round(quantile_cont(CAST(amount AS DOUBLE), 0.25), 4) AS q25,
  round(quantile_cont(CAST(amount AS DOUBLE), 0.5), 4) AS q50,
  round(quantile_cont(CAST(amount AS DOUBLE), 0.75), 4) AS q75,
  CAST(max(amount) AS DOUBLE) AS max FROM transactions"""


def value_counts(table, columns):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS field, CAST({sql} AS VARCHAR) AS value, count(*) AS n "
        f"FROM {table} GROUP BY {sql}" for c, sql in columns.items())


SQL["dq_21_value_counts"] = value_counts("transactions", {
    "status": "status", "payment_method": "payment_method", "category": "category",
    "month": "month(transaction_datetime)"})
SQL["dq_21_user_value_counts"] = value_counts("user_profiles", {
    c: c for c in ("age_group", "customer_tier", "spending_persona")})
SQL["dq_22_ranges"] = """SELECT strftime(min(transaction_datetime), '%Y-%m-%d %H:%M:%S') AS first_at,
  strftime(max(transaction_datetime), '%Y-%m-%d %H:%M:%S') AS last_at,
  CAST(min(amount) AS DOUBLE) AS amount_min, CAST(max(amount) AS DOUBLE) AS amount_max
  FROM transactions"""
SQL["dq_23_flag_refund_promotion"] = group("transactions", [], {
    "flagged": n("is_flagged"), "flagged_pct": share("is_flagged"), "refunded": n("is_refunded"),
    "refunded_pct": share("is_refunded"), "with_cashback": n("cashback_earned > 0"),
    "cashback_total": CASH, "with_discount": n("discount_applied > 0"),
    "discount_total": money("discount_applied"),
    "success_without_reason": n(f"{OK} AND failure_reason IS NULL"),
    "failed_with_reason": n(f"{BAD} AND failure_reason IS NOT NULL")})
SQL["dq_24_feature_distributions"] = value_counts(E_FROM, {
    c: c for c in ("time_bucket", "amount_bucket", "processing_speed", "user_spending_tier")})
SQL["dq_25_savings_summary"] = f"""SELECT {n('cashback_earned > 0')} AS with_cashback,
  {n('discount_applied > 0')} AS with_discount, {money('total_savings')} AS total_savings,
  CAST((2 * CAST(coalesce(sum(savings_bp) FILTER (WHERE total_savings > 0), 0) AS HUGEINT)
    + {n('total_savings > 0')}) // nullif(2 * {n('total_savings > 0')}, 0) AS DOUBLE) / 100
    AS avg_savings_pct FROM ft"""


def with_share(table, key, columns, share_name, where=None):
    """Counts per key with their share of all the counted rows, two decimals."""
    shown = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    where = f" WHERE {where}" if where else ""
    return (f"SELECT g.* EXCLUDE (c, all_rows), {half_up('100 * c', 'all_rows', 2)} AS {share_name} "
            f"FROM (SELECT {key}, {shown}, count(*) AS c, "
            f"(SELECT count(*) FROM {table}{where}) AS all_rows FROM {table}{where} "
            f"GROUP BY {key}) g")


SQL["dq_26_status_distribution"] = with_share("transactions", "status", {"cnt": N}, "pct")
SQL["dq_26_method_distribution"] = with_share("transactions", "payment_method", {"cnt": N}, "pct")
SQL["dq_27_category_distribution"] = group("transactions", "category", {"cnt": N})
SQL["dq_28_profile_combinations"] = group(
    "user_profiles", ["age_group", "customer_tier", "spending_persona"], {"user_count": N},
    tail="ORDER BY user_count DESC, age_group, customer_tier, spending_persona LIMIT 15")

# --------------------------------------------------------------------------- SQL catalogue
SQL["sql_1a_overall_success"] = group("ct", [], {
    "total_transactions": N, "successful": n(OK), "failed": n(BAD), "pending": n(PENDING),
    "success_rate_pct": SR, "failure_rate_pct": FR,
    "total_successful_volume": money("amount", OK, zero=True)})
SQL["sql_1b_success_by_method"] = group("ct", "payment_method", {
    "total_txn": N, "success_count": n(OK), "fail_count": n(BAD), "success_rate": SR,
    "avg_txn_amount": avg2(), "total_successful_amount": money("amount", OK, zero=True)})
SQL["sql_1c_success_by_month"] = group("ct", [
    f"{MONTH} AS txn_month", "monthname(transaction_datetime) AS month_name"], {
    "total_txn": N, "success_count": n(OK), "success_rate": SR, "total_volume": money("amount")})
SQL["sql_1d_success_by_city"] = group("ct", "city", {
    "total_txn": N, "success_rate": SR, "avg_amount": avg2(),
    "successful_volume": money("amount", OK, zero=True)})
SQL["sql_1e_success_by_device"] = group("ct", "device_type", {
    "total_txn": N, "success_rate": SR, "avg_processing_time": PT})
SQL["sql_1f_weekend_weekday"] = group("ct", f"{DAY_TYPE} AS day_type", {
    "total_txn": N, "success_rate": SR, "avg_amount": avg2(), "total_volume": money("amount")})
SQL["sql_2a_hourly"] = group("ct", f"{HOUR} AS txn_hour", {
    "total_txn": N, "total_volume": money("amount"), "avg_amount": avg2(), "success_rate": SR,
    "failure_rate": FR})
SQL["sql_2b_day_of_week"] = group("ct", [
    "dayname(transaction_datetime) AS day_name",
    "CAST(dayofweek(transaction_datetime) + 1 AS INT) AS day_num"], {
    "total_txn": N, "total_volume": money("amount"), "success_rate": SR, "unique_users": USERS})
SQL["sql_2c_method_hour_heatmap"] = group("ct", ["payment_method", f"{HOUR} AS txn_hour"], {
    "txn_count": N, "volume": money("amount")}, OK)
SQL["sql_2d_monthly_seasons"] = group("ct", [f"{MONTH} AS txn_month", f"{SEASON} AS season_type"], {
    "txn_count": N, "total_volume": money("amount"), "unique_users": USERS,
    "avg_txn_value": avg2()})
SQL["sql_2e_category_quarter"] = group("ct", [
    "'Q' || quarter(transaction_datetime) AS quarter", "category"], {
    "txn_count": N, "successful_volume": money("amount", OK, zero=True)})
SQL["sql_3a_failure_reasons"] = with_share("ct", "failure_reason", {
    "fail_count": N, "avg_failed_amount": avg2(), "avg_processing_time": PT},
    "pct_of_failures", BAD)
SQL["sql_3b_method_reason"] = group("ct", ["payment_method", "failure_reason"], {
    "fail_count": N, "avg_failed_amount": avg2(), "avg_proc_time": PT}, BAD)
SQL["sql_3c_worst_hours"] = group("ct", f"{HOUR} AS txn_hour", {
    "total_txn": N, "failed_txn": n(BAD), "failure_rate": FR},
    tail="ORDER BY failure_rate DESC, txn_hour LIMIT 10")
SQL["sql_3d_lost_revenue"] = f"""SELECT payment_method, failed_txn_count,
  CAST(v AS DOUBLE) AS lost_revenue, avg_failed_txn_value,
  {half_up('100 * c', 'all_c', 2)} AS pct_of_total_lost FROM (
  SELECT payment_method, count(*) AS failed_txn_count, sum(amount) AS v,
    {avg2()} AS avg_failed_txn_value, CAST(sum(amount) * 100 AS HUGEINT) AS c,
    (SELECT CAST(sum(amount) * 100 AS HUGEINT) FROM ct WHERE {BAD}) AS all_c
  FROM ct WHERE {BAD} GROUP BY payment_method)"""
SQL["sql_3e_failure_by_category"] = group("ct", "category", {
    "total_txn": N, "failed_count": n(BAD), "failure_rate": FR,
    "lost_amount": money("amount", BAD, zero=True)})
SQL["sql_3f_failure_by_platform_device"] = group("ct", ["platform", "device_type"], {
    "total_txn": N, "failed_count": n(BAD), "failure_rate": FR})
SQL["sql_4a_user_segments"] = f"""SELECT {SEGMENT} AS user_segment, count(*) AS user_count,
  CAST((20 * sum(txn_count) + count(*)) // (2 * count(*)) AS DOUBLE) / 10 AS avg_txn_per_user,
  CAST((2 * sum(spent_cents) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_spend,
  CAST(round(CAST(sum(failure_rate) AS DOUBLE) / count(*), 2) AS DOUBLE) AS avg_failure_rate
  FROM (SELECT user_id, count(*) AS txn_count,
    CAST(coalesce(sum(amount) FILTER (WHERE {OK}), 0) * 100 AS HUGEINT) AS spent_cents,
    CAST({half_up(f'100 * {n(BAD)}', N, 6)} AS DECIMAL(12,6)) AS failure_rate
    FROM ct GROUP BY user_id) GROUP BY ALL"""
SQL["sql_4b_top_users"] = group("cu", [
    "user_id", "age_group", "customer_tier", "spending_persona"], {
    "total_txn": N, "total_spent": money("amount", OK, zero=True), "avg_txn_value": avg2(),
    "methods_used": "count(DISTINCT payment_method)",
    "categories_used": "count(DISTINCT category)", "total_cashback": CASH},
    tail="ORDER BY total_spent DESC, user_id LIMIT 20")
SQL["sql_4c_age_method"] = group("cu", ["age_group", "payment_method"], {
    "txn_count": N, "unique_users": USERS, "avg_amount": avg2()})
CENTS_OK = f"coalesce(CAST(sum(amount) FILTER (WHERE {OK}) * 100 AS HUGEINT), 0)"


def cents_per(bottom, places=2):
    return (f"CAST((2 * {CENTS_OK} + {bottom}) // nullif(2 * {bottom}, 0) AS DOUBLE) / 100")


SQL["sql_4d_monthly_active_users"] = group("ct", f"{MONTH} AS txn_month", {
    "monthly_active_users": USERS, "total_txn": N,
    "txn_per_active_user": half_up(N, USERS, 1), "revenue_per_active_user": cents_per(USERS)})
SQL["sql_4e_tier_performance"] = group("cu", "customer_tier", {
    "total_txn": N, "unique_users": USERS, "avg_txn_value": avg2(),
    "total_revenue": money("amount", OK, zero=True), "failure_rate": FR,
    "total_cashback_given": CASH})
SQL["sql_4f_persona_spend"] = group("cu", "spending_persona", {
    "users": USERS, "total_txn": N, "avg_txn_amount": avg2(),
    "total_spent": money("amount", OK, zero=True), "spend_per_user": cents_per(USERS)})
SQL["sql_5a_cashback_by_method"] = group("ct", "payment_method", {
    "total_txn": N, "txn_with_cashback": n("cashback_earned > 0"),
    "cashback_rate_pct": pct("cashback_earned > 0"), "total_cashback": CASH,
    "avg_cashback_per_txn": avg2("cashback_earned", "cashback_earned > 0")}, OK)
SQL["sql_5b_discount_by_category"] = group("ct", "category", {
    "total_txn": N, "txn_with_discount": n("discount_applied > 0"),
    "total_discount_value": money("discount_applied"),
    "avg_discount_pct": "round(CAST(sum(CAST(CAST(discount_applied AS DOUBLE) * 100 / "
                        "CAST(amount AS DOUBLE) AS DECIMAL(20,7))) FILTER (WHERE discount_applied > 0)"
                        f" AS DOUBLE) / nullif({n('discount_applied > 0')}, 0), 2)"}, OK)
SQL["sql_5c_savings_tiers"] = group("ct", f"{TIER} AS savings_tier", {
    "txn_count": N, "avg_txn_amount": avg2(), "total_volume": money("amount")}, OK)
SQL["sql_6a_flag_overview"] = group("ct", "is_flagged", {
    "txn_count": N, "avg_amount": avg2(), "total_amount": money("amount"), "failure_rate": FR})
SQL["sql_6b_fraud_reasons"] = group("ct", "fraud_reason", {
    "flag_count": N, "avg_flagged_amount": avg2(), "avg_processing_time": PT,
    "methods_involved": "string_agg(DISTINCT payment_method, ',' ORDER BY payment_method)"},
    "is_flagged")
SQL["sql_6c_flags_by_slot"] = group(
    "(SELECT *, hour(transaction_datetime) AS h FROM ct)", f"{FRAUD5} AS time_slot", {
        "flagged_count": N, "avg_flagged_amount": avg2()}, "is_flagged")
SQL["sql_6d_flags_by_tier"] = group("cu", "customer_tier", {
    "total_txn": N, "flagged_count": n("is_flagged"), "flag_rate_pct": pct("is_flagged")})
SQL["sql_7a_refund_summary"] = f"""SELECT count(*) AS total_refunds,
  {n('refund_amount = amount')} AS full_refunds,
  {n('refund_amount < amount AND refund_amount > 0')} AS partial_refunds,
  {money('refund_amount')} AS total_refund_value, {avg2('refund_amount')} AS avg_refund_amount,
  {half_up("100 * CAST(sum(refund_amount) * 100 AS HUGEINT)",
           f"(SELECT CAST(sum(amount) * 100 AS HUGEINT) FROM ct WHERE {OK})", 2)}
    AS refund_as_pct_of_revenue FROM ct WHERE is_refunded"""
SQL["sql_7b_refunds_by_category"] = with_share("ct", "category", {
    "refund_count": N, "total_refunded": money("refund_amount"),
    "avg_refund": avg2("refund_amount")}, "pct_of_all_refunds", "is_refunded")
SQL["sql_7c_refund_rate_by_method"] = group("ct", "payment_method", {
    "total_successful": N, "refunded": n("is_refunded"), "refund_rate_pct": pct("is_refunded"),
    "total_refund_value": money("refund_amount", "is_refunded", zero=True)}, OK)
SQL["sql_8a_platforms"] = group("ct", "platform", {
    "total_txn": N, "unique_users": USERS, "successful_volume": money("amount", OK, zero=True),
    "success_rate": SR, "avg_processing_time": PT, "total_cashback": CASH})
SQL["sql_8b_devices"] = group("ct", ["device_type", "platform"], {
    "total_txn": N, "avg_amount": avg2(), "success_rate": SR, "avg_proc_time": PT})
SQL["sql_8c_android_ios"] = group("ct", "device_type AS mobile_os", {
    "total_txn": N, "avg_txn_amount": avg2(), "success_rate": SR,
    "total_volume": money("amount", OK, zero=True), "total_cashback": CASH,
    "fraud_flag_rate": pct("is_flagged")}, MOBILE)
SQL["sql_v1_executive_summary"] = group("ct", [
    f"{MONTH} AS month", "payment_method", "category", "platform", "device_type", "city", "status",
    "is_weekend"], {
    "txn_count": N, "total_amount": money("amount"), "avg_amount": avg2(),
    "avg_processing_time": PT, "total_cashback": CASH, "total_discount": money("discount_applied"),
    "flagged_count": n("is_flagged"), "refund_count": n("is_refunded"),
    "total_refund_amount": money("refund_amount"), "unique_users": USERS})
SQL["sql_v2_kpi_snapshot"] = f"""SELECT (SELECT count(*) FROM ct) AS total_transactions,
  (SELECT {money('amount', OK, zero=True)} FROM ct) AS total_revenue,
  (SELECT {SR} FROM ct) AS success_rate,
  (SELECT {avg2()} FROM ct WHERE {OK}) AS avg_successful_txn,
  (SELECT {USERS} FROM ct) AS total_active_users,
  (SELECT {money('cashback_earned + discount_applied')} FROM ct) AS total_promotions_cost,
  (SELECT count(*) FROM ct WHERE is_flagged) AS fraud_flags,
  (SELECT {money('refund_amount')} FROM ct WHERE is_refunded) AS total_refunds,
  (SELECT {PT} FROM ct WHERE {OK}) AS avg_success_processing_time"""
SQL["sql_v3_clean_transactions"] = f"""SELECT c.transaction_id, c.user_id,
  strftime(c.transaction_datetime, '%Y-%m-%d %H:%M:%S') AS transaction_datetime,
  strftime(c.transaction_datetime, '%Y-%m-%d') AS txn_date, {HOUR} AS txn_hour,
  dayname(transaction_datetime) AS day_of_week, {MONTH} AS txn_month,
  monthname(transaction_datetime) AS month_name,
  CAST(quarter(transaction_datetime) AS INT) AS txn_quarter, payment_method, category, merchant,
  platform, device_type, c.city, CAST(amount AS DOUBLE) AS amount,
  CASE WHEN amount < 100 THEN 'Micro (<₹100)' WHEN amount < 500 THEN 'Small (₹100-500)'
    WHEN amount < 2000 THEN 'Medium (₹500-2K)' WHEN amount < 10000 THEN 'Large (₹2K-10K)'
    WHEN amount < 50000 THEN 'High (₹10K-50K)' ELSE 'Premium (₹50K+)' END AS amount_bucket,
  CAST(discount_applied AS DOUBLE) AS discount_applied,
  CAST(cashback_earned AS DOUBLE) AS cashback_earned,
  CAST(cashback_earned + discount_applied AS DOUBLE) AS total_savings,
  CAST(greatest(amount - discount_applied - cashback_earned, 0) AS DOUBLE) AS net_amount, status,
  failure_reason, CAST(processing_time_sec AS DOUBLE) AS processing_time_sec,
  CASE WHEN status = 'Failed' THEN 'Failed' WHEN processing_time_sec <= 1 THEN 'Instant'
    WHEN processing_time_sec <= 2 THEN 'Fast' WHEN processing_time_sec <= 5 THEN 'Normal'
    WHEN processing_time_sec <= 15 THEN 'Slow' ELSE 'Very Slow' END AS processing_speed,
  is_weekend, is_flagged, fraud_reason, is_refunded, CAST(refund_amount AS DOUBLE) AS refund_amount,
  {', '.join(PROFILE)}, u.city AS user_home_city, {SEASON} AS season_type, {SLOT_SQL} AS time_slot
  FROM (SELECT *, hour(transaction_datetime) AS h FROM ct) c
  LEFT JOIN user_profiles u ON c.user_id = u.user_id"""

# --------------------------------------------------------------------------- user behaviour
for _name, _column in {
    "uf_1_total_txns": "user_total_txns", "uf_2_total_spend": "user_total_spend",
    "uf_3_avg_txn_amount": "user_avg_txn_amount", "uf_4_failure_rate_pct": "user_failure_rate_pct",
    "uf_5_spending_tier": "user_spending_tier",
}.items():
    SQL[_name] = f"SELECT user_id, {_column} FROM ub"
SQL["uf_6_enriched_table"] = SQL["snk_1_enriched_parquet"]

# --------------------------------------------------------------------------- exploratory
SUCCESS = share(OK)


def pandas_group(keys, columns, where=None, tail="", table="ft"):
    """A grouping that drops rows whose key is missing."""
    keys = [keys] if isinstance(keys, str) else keys
    return group(table, keys, columns, where, tail, [k.rsplit(" AS ", 1)[0] for k in keys])


HEATMAP = {f"h{h:02d}": n(f"hour = {h}") for h in range(24)}
SQL["ed_1_kpis"] = group("ft", [], {
    "total_transactions": N, "success_rate": SUCCESS, "total_volume": money("amount", OK),
    "unique_users": USERS, "avg_txn_value": avg("amount", OK), "fraud_flags": n("is_flagged"),
    "fraud_pct": share("is_flagged"), "refunds": n("is_refunded"),
    "refund_pct": share("is_refunded"), "total_savings": money("total_savings")})
SQL["ed_2_monthly_folded"] = pandas_group("month", {
    "txn_count": N, "success_count": n(OK), "total_volume": money("amount"), "success_rate": SR})
SQL["ed_3_methods"] = pandas_group("payment_method", {
    "count": N, "success_rate": SUCCESS, "avg_amount": avg()})
SQL["ed_4_day_hour_heatmap"] = pandas_group("day_name", HEATMAP)
SQL["ed_5_categories"] = pandas_group("category", {
    "count": N, "total_volume": money("amount"), "avg_amount": avg()})
TOP_REASONS = pandas_group("failure_reason", {"count": N}, BAD,
                           "ORDER BY count DESC, failure_reason LIMIT 10")
SQL["ed_6a_top_reasons"] = TOP_REASONS
SQL["ed_6b_failure_by_method"] = pandas_group("payment_method", {"failure_rate": share(BAD)})
SQL["ed_7_lost_by_method"] = pandas_group("payment_method", {
    "total_lost": money("amount"), "fail_count": N, "avg_lost": avg()}, BAD)
SQL["ed_8_age_groups"] = pandas_group("age_group", {
    "txn_count": N, "unique_users": USERS, "avg_amount": avg(), "success_rate": SUCCESS},
    table="tu")
SQL["ed_9_tiers"] = pandas_group("customer_tier", {
    "txn_count": N, "revenue": money("amount", OK, zero=True), "avg_amount": avg(),
    "success_rate": SUCCESS, "cashback": CASH}, table="tu")
PER_USER = f"(CAST(sum(amount) AS DOUBLE) / {USERS})"
SQL["ed_10_personas"] = pandas_group("spending_persona", {
    "users": USERS, "txn_count": N, "avg_amount": avg(), "total_spend": money("amount"),
    "spend_per_user": PER_USER}, OK, table="tu")
SQL["ed_11_cities"] = pandas_group("city", {
    "txn_count": N, "success_rate": SUCCESS, "avg_amount": avg(), "total_volume": money("amount")})
SQL["ed_12a_platforms"] = pandas_group("platform", {"count": N, "success_rate": SUCCESS})
SQL["ed_12b_devices"] = pandas_group("device_type", {"count": N, "avg_amount": avg()})
SQL["ed_13a_fraud_reasons"] = pandas_group("fraud_reason", {"count": N}, "is_flagged")


def box(value, mean=False):
    """Quartiles, whiskers and outliers of ``value`` by flag."""
    shown = ", round(CAST(sum(v) AS DOUBLE) / count(*), 4) AS mean" if mean else ""
    return f"""SELECT is_flagged, q1, median, q3, count(*) AS n_rows,
  CAST(min(v) FILTER (WHERE v BETWEEN lo AND hi) AS DOUBLE) AS whisker_low,
  CAST(max(v) FILTER (WHERE v BETWEEN lo AND hi) AS DOUBLE) AS whisker_high,
  {n('NOT (v BETWEEN lo AND hi)')} AS n_outliers{shown}
  FROM (SELECT is_flagged, {value} AS v FROM ft) x JOIN (
    SELECT is_flagged, round(quantile_cont(CAST({value} AS DOUBLE), 0.25), 4) AS q1,
      round(quantile_cont(CAST({value} AS DOUBLE), 0.5), 4) AS median,
      round(quantile_cont(CAST({value} AS DOUBLE), 0.75), 4) AS q3,
      round(q1 - (q3 - q1) * 1.5, 4) AS lo, round(q3 + (q3 - q1) * 1.5, 4) AS hi
    FROM ft GROUP BY is_flagged) q USING (is_flagged) GROUP BY is_flagged, q1, median, q3"""


CLIPPED = "CAST(least(amount, 50000) AS DECIMAL(12,2))"
SQL["ed_13b_box_by_flag"] = box(CLIPPED)
SQL["ed_14a_cashback"] = pandas_group("payment_method", {"total": CASH, "count": N},
                                      "cashback_earned > 0")
SQL["ed_14b_discounts"] = pandas_group("category", {
    "total": money("discount_applied"), "count": N}, "discount_applied > 0")
SQL["ed_15a_refunds_by_category"] = pandas_group("category", {
    "refund_count": N, "total_refunded": money("refund_amount")}, "is_refunded")
SQL["ed_15b_refund_types"] = group("ft", """CASE WHEN refund_amount >= amount * 0.99
  THEN 'Full Refund' ELSE 'Partial Refund' END AS refund_type""", {"count": N}, "is_refunded")
SQL["ed_16_weekend"] = pandas_group(["is_weekend", f"{DAY_TYPE} AS day_type"], {
    "txn_count": N, "avg_amount": avg(), "success_rate": SUCCESS, "total_volume": money("amount")})
SQL["ed_17a_processing_by_method"] = pandas_group("payment_method", {
    "avg_processing_time": avg("processing_time_sec")}, OK)
SQL["ed_17b_speed_levels"] = """SELECT processing_speed, count(transaction_id) AS count FROM
  (VALUES ('Instant'), ('Fast'), ('Normal'), ('Slow'), ('Very Slow')) v(processing_speed)
  LEFT JOIN (SELECT processing_speed, transaction_id FROM ft WHERE status <> 'Failed') x
  USING (processing_speed) GROUP BY processing_speed"""


def leader(key, where, table="ft"):
    return (f"(SELECT {key} FROM {table} WHERE {where} AND {key} IS NOT NULL GROUP BY {key} "
            f"ORDER BY count(*) DESC, {key} LIMIT 1)")


NET = "payment_method = 'Net Banking'"
FINDINGS = group("tu", [], {
    "total_transactions": N, "users": USERS, "successful": n(OK), "success_pct": share(OK),
    "failed": n(BAD), "failed_pct": share(BAD), "pending": n(PENDING),
    "pending_pct": share(PENDING), "success_volume": money("amount", OK),
    "upi_count": n("payment_method = 'UPI'"), "upi_pct": share("payment_method = 'UPI'"),
    "net_banking_failure_pct": share(f"{NET} AND {BAD}", NET), "weekend": n("is_weekend = 1"),
    "weekend_pct": share("is_weekend = 1"), "lost_revenue": money("amount", BAD),
    "with_cashback": n("cashback_earned > 0"), "with_discount": n("discount_applied > 0"),
    "total_savings": money("total_savings"),
    "avg_savings_pct": "CAST(CAST(sum(savings_bp) FILTER (WHERE total_savings > 0) AS DOUBLE) / 100"
                       f" AS DOUBLE) / {n('total_savings > 0')}",
    "flagged": n("is_flagged"), "flagged_pct": share("is_flagged"), "refunds": n("is_refunded"),
    "refund_pct": share("is_refunded"), "refund_value": money("refund_amount"),
    "mobile_app_pct": share("platform = 'Mobile App'"), "android": n("device_type = 'Android'"),
    "ios": n("device_type = 'iOS'"),
    "best_method": f"(SELECT payment_method FROM ft GROUP BY payment_method "
                   f"ORDER BY {share(OK)} DESC, payment_method LIMIT 1)",
    "best_method_success_pct": f"(SELECT {share(OK)} AS r FROM ft GROUP BY payment_method "
                               f"ORDER BY r DESC, payment_method LIMIT 1)",
    "top_failure_reason": leader("failure_reason", BAD),
    "top_fraud_reason": leader("fraud_reason", "is_flagged"),
    "top_refund_category": leader("category", "is_refunded"),
    "age_25_34_pct": share("age_group = '25-34'"),
    "high_spender_avg": avg("amount", "spending_persona = 'High Spender'"),
    "vip_users": "count(DISTINCT user_id) FILTER (WHERE customer_tier = 'VIP')"})
SQL["ed_18_findings"] = FINDINGS
SQL["snk_3_findings_json"] = FINDINGS

# --------------------------------------------------------------------------- dashboard
LABEL = "strftime(make_date(year, month, 1), '%Y %b')"
SQL["ap_1_overview"] = group("ft", [], OVERVIEW)
SQL["ap_2_monthly"] = f"SELECT *, {LABEL} AS label FROM (" + pandas_group(["year", "month"], {
    "txn_count": N, "success": n(OK), "volume": money("amount"),
    "success_rate": pct(OK, places=1)}) + ")"
SQL["ap_2b_festival_periods"] = """SELECT year, year || ' Oct' AS from_label, year || ' Nov' AS to_label
  FROM ft WHERE month IN (10, 11) GROUP BY year HAVING count(DISTINCT month) = 2"""
SQL["ap_3_methods"] = pandas_group("payment_method", {"count": N})
SQL["ap_4_category_revenue"] = pandas_group("category", {"revenue": money("amount")}, OK)
SQL["ap_5_cities"] = pandas_group("city", {"count": N})
SQL["ap_6_day_hour_matrix"] = SQL["ed_4_day_hour_heatmap"]
SQL["ap_7_time_buckets"] = pandas_group("time_bucket", {
    "count": N, "avg_amt": avg(), "sr": SUCCESS})
SQL["ap_8_weekend"] = pandas_group(["is_weekend", f"{DAY_TYPE} AS day_type"], {
    "count": N, "avg_amt": avg(), "volume": money("amount"), "sr": SUCCESS})
SQL["ap_9_method_performance"] = pandas_group("payment_method", {
    "count": N, "success_rate": SUCCESS, "avg_amount": avg(),
    "avg_proc": avg("processing_time_sec")})
SQL["ap_10_failure_kpis"] = group("ft", [], {
    "failed_txn": n(BAD), "failure_rate": share(BAD), "lost_revenue": money("amount", BAD, True),
    "avg_failed": f"coalesce({avg('amount', BAD)}, 0)"})
SQL["ap_11_top_reasons"] = TOP_REASONS
SQL["ap_12_failed_by_method"] = pandas_group("payment_method", {
    "count": N, "lost": money("amount")}, BAD)
SQL["ap_13_hourly_failures"] = pandas_group("hour", {
    "total": N, "failed": n(BAD), "rate": share(BAD)})
SQL["ap_14_method_reason_crosstab"] = pandas_group("payment_method", {
    f'"{r}"': n(f"failure_reason = '{r}'") for r in (
        "Bank Server Down", "Insufficient Balance", "Server Timeout", "Session Expired",
        "Card Declined")} | {'"Other"': n("""failure_reason NOT IN ('Bank Server Down', 'Insufficient Balance',
        'Server Timeout', 'Session Expired', 'Card Declined')""")}, f"{BAD} AND failure_reason IS NOT NULL")
SQL["ap_14_method_reason_counts"] = pandas_group(
    ["payment_method", "failure_reason"], {"count": N}, f"{BAD} AND failure_reason IS NOT NULL")
SQL["ap_15_age_groups"] = pandas_group("age_group", {
    "count": N, "avg_amt": avg(), "users": USERS}, table="tu")
SQL["ap_16_tiers"] = pandas_group("customer_tier", {
    "count": N, "users": USERS, "volume": money("amount", OK, zero=True)}, table="tu")
SQL["ap_17_personas"] = pandas_group("spending_persona", {
    "avg_amt": avg(), "total": money("amount"), "users": USERS, "per_user": PER_USER}, OK,
    table="tu")
SQL["ap_18_genders"] = pandas_group("gender", {"count": N, "avg_amt": avg()}, table="tu")
SQL["ap_19_monthly_active_users"] = f"SELECT *, {LABEL} AS label FROM (" + pandas_group(
    ["year", "month"], {"mau": USERS, "txn_count": N, "txn_per_user": half_up(N, USERS, 2)}) + ")"
SQL["ap_20_fraud_kpis"] = group("ft", [], {
    "flagged_txn": n("is_flagged"), "flag_rate": share("is_flagged"),
    "avg_flagged": f"coalesce({avg('amount', 'is_flagged')}, 0)",
    "flagged_volume": money("amount", "is_flagged", zero=True)})
SQL["ap_21_fraud_reasons"] = SQL["ed_13a_fraud_reasons"]
SQL["ap_22_box_with_mean"] = box(CLIPPED, mean=True)
FULL = "is_refunded AND refund_amount >= amount * 0.99"
SQL["ap_23_refund_kpis"] = group("ft", [], {
    "refunds": n("is_refunded"), "refund_rate": share("is_refunded"),
    "refund_value": money("refund_amount", "is_refunded", zero=True), "full_refunds": n(FULL),
    "full_refund_pct": f"coalesce({share(FULL, 'is_refunded')}, 0)"})
SQL["ap_24_refunds_by_category"] = pandas_group("category", {
    "count": N, "total": money("refund_amount")}, "is_refunded")
SQL["ap_25_refunds_by_method"] = pandas_group("payment_method", {
    "count": N, "total": money("refund_amount")}, "is_refunded")
SQL["ap_26_platforms"] = pandas_group("platform", {
    "count": N, "sr": SUCCESS, "avg_proc": avg("processing_time_sec")})
SQL["ap_27_devices"] = pandas_group("device_type", {"count": N, "avg_amt": avg(), "sr": SUCCESS})
SQL["ap_28_android_ios"] = pandas_group("device_type", {
    "txn_count": N, "avg_amount": avg(), "success_rate": SUCCESS, "total_volume": money("amount"),
    "avg_proc": avg("processing_time_sec"), "cashback": CASH, "flagged": n("is_flagged")}, MOBILE)
SQL["ap_29_cashback"] = SQL["ed_14a_cashback"]
SQL["ap_30_discounts"] = SQL["ed_14b_discounts"]

# --------------------------------------------------------------------------- spreadsheet
FRACTION = share(OK, scale=1)
KPIS = {"total_transactions": N, "successful": n(OK), "failed": n(BAD), "pending": n(PENDING),
        "success_rate": FRACTION, "failure_rate": share(BAD, scale=1),
        "successful_volume": money("amount", OK), "avg_value": avg(), "unique_users": USERS,
        "txn_per_user": f"CAST(count(*) AS DOUBLE) / {USERS}",
        "lost_revenue": money("amount", BAD)}
SQL["wb_1_kpis"] = " UNION ALL ".join(
    f"SELECT '{k}' AS kpi, CAST({sql} AS DOUBLE) AS value FROM transactions"
    for k, sql in KPIS.items())


def workbook(keys, columns, where=None, tail=""):
    return pandas_group(keys, columns, where, tail, "transactions")


SQL["wb_2_methods"] = workbook("payment_method", {
    "txn_count": N, "success": n(OK), "avg_amt": avg(), "success_rate": FRACTION})
SQL["wb_3_months"] = workbook(f"{MONTH} AS month", {
    "total": N, "success": n(OK), "failed": n(BAD), "volume": money("amount"),
    "success_rate": FRACTION})
SQL["wb_4_cities"] = workbook("city", {
    "total": N, "success": n(OK), "avg_amt": avg(), "success_rate": FRACTION})
SQL["wb_5_hours"] = workbook([
    f"{HOUR} AS hour", "strftime(transaction_datetime, '%H:00') AS hour_label"], {
    "total": N, "volume": money("amount"), "avg_amt": avg(), "success_rate": FRACTION})
SQL["wb_6_weekdays"] = workbook("dayname(transaction_datetime) AS day_name", {
    "total": N, "volume": money("amount"), "success_rate": FRACTION})
SQL["wb_7_time_slots"] = group(
    "(SELECT *, hour(transaction_datetime) AS h FROM transactions)", f"{SLOT_WB} AS time_slot", {
        "total": N, "volume": money("amount"), "success_rate": FRACTION})
SQL["wb_8_failure_reasons"] = workbook("failure_reason", {
    "count": N, "avg_amt": avg(), "avg_proc": avg("processing_time_sec"),
    "pct": "CAST(count(*) AS DOUBLE) / (SELECT count(failure_reason) FROM transactions "
           "WHERE status = 'Failed')"}, BAD)
SQL["wb_9_failed_by_method"] = workbook("payment_method", {
    "failed_count": N, "lost_revenue": money("amount"), "avg_failed_amt": avg()}, BAD)
SQL["wb_10_lost_revenue"] = group("transactions", [], {
    "total_lost": money("amount", BAD), "avg_lost": avg("amount", BAD)})
ACTIVITY = f"""(SELECT user_id, count(*) AS txn_count, coalesce(sum(amount) FILTER (WHERE {OK}), 0)
  AS spent, {avg()} AS avg_amount, count(DISTINCT payment_method) AS methods_used
  FROM transactions GROUP BY user_id)"""
SQL["wb_11_segments"] = f"""SELECT {SEGMENT} AS segment, count(*) AS user_count,
  CAST(sum(txn_count) AS DOUBLE) / count(*) AS avg_txn,
  CAST(sum(spent) AS DOUBLE) / count(*) AS avg_spend FROM {ACTIVITY} GROUP BY ALL"""
SQL["wb_12_monthly_active_users"] = workbook(f"{MONTH} AS month", {
    "active_users": USERS, "total_txn": N, "txn_per_user": f"CAST(count(*) AS DOUBLE) / {USERS}"})
SQL["wb_13_top_users"] = f"""SELECT user_id, txn_count, CAST(spent AS DOUBLE) AS total_spent,
  avg_amount, methods_used FROM {ACTIVITY} ORDER BY spent DESC, user_id LIMIT 15"""

# --------------------------------------------------------------------------- star schema
SQL["st_1_dim_date"] = """SELECT DISTINCT CAST(strftime(date, '%Y%m%d') AS INT) AS date_key,
  CAST(date AS VARCHAR) AS date, year, month, month_name, month_name || ' ' || year AS month_year,
  quarter, quarter_label, day, day_of_week, day_name, week_number, is_weekend, is_month_start,
  is_month_end, is_festival_season FROM ft"""
SQL["st_2_dim_users"] = f"""SELECT ub.user_id, {', '.join(PROFILE)}, u.city AS user_home_city,
  user_total_txns, user_total_spend, user_avg_txn_amount, user_failure_rate_pct, user_spending_tier
  FROM ub LEFT JOIN user_profiles u ON ub.user_id = u.user_id"""
SQL["st_6_fact_transactions"] = doubles("ft", [
    "transaction_id", "user_id", "transaction_datetime", "hour", "time_bucket", "payment_method",
    "category", "merchant", "platform", "device_type", "city", "amount", "amount_bucket",
    "net_amount", "cashback_earned", "discount_applied", "total_savings", "savings_pct", "status",
    "failure_reason", "processing_time_sec", "processing_speed", "is_flagged", "fraud_reason",
    "is_refunded", "refund_amount"], """, CAST(strftime(date, '%Y%m%d') AS INT) AS date_key,
  CAST(status = 'Success' AS INT) AS is_success, CAST(status = 'Failed' AS INT) AS is_failed,
  CAST(status = 'Pending' AS INT) AS is_pending, CAST(is_flagged AS INT) AS is_flagged_int,
  CAST(is_refunded AS INT) AS is_refunded_int""")


def literal_dim(key, attribute, sql, extra=""):
    return f"SELECT {key}, {sql} AS {attribute}{extra}, count(*) AS n_txn FROM ft GROUP BY {key}"


SQL["st_3_dim_payment_method"] = literal_dim("payment_method", "payment_type", PAY_TYPE, """,
  CAST(CASE payment_method WHEN 'UPI' THEN 0.06 WHEN 'Credit Card' THEN 0.04
  WHEN 'Debit Card' THEN 0.08 WHEN 'Net Banking' THEN 0.1 ELSE 0.05 END AS DOUBLE)
  AS base_failure_rate""")
SQL["st_4_dim_category"] = literal_dim("category", "category_group", CAT_GROUP)
SQL["st_5_dim_platform"] = literal_dim("platform", "channel", CHANNEL)
_UNMATCHED = {
    "dim_date": ("transaction_datetime", "transaction_datetime IS NULL"),
    "dim_users": ("user_id", "user_id NOT IN (SELECT user_id FROM transactions UNION ALL SELECT -1)"),
    "dim_payment_method": ("payment_method", "payment_method NOT IN ('UPI', 'Credit Card', "
                           "'Debit Card', 'Net Banking', 'Mobile Wallet')"),
    "dim_category": ("trim(category)", "trim(category) NOT IN ('Food & Dining', 'Shopping', "
                     "'Bills & Utilities', 'Travel', 'Entertainment', 'Health', 'Education', "
                     "'Transfers', 'Groceries', 'Investments')"),
    "dim_platform": ("platform", "platform NOT IN ('Mobile App', 'Web Browser', 'POS Terminal', "
                     "'QR Code')"),
}
SQL["st_7_relationship_check"] = " UNION ALL ".join(
    f"SELECT '{dim}' AS dimension, count(DISTINCT {key}) AS n_keys, count(*) AS n_rows "
    f"FROM dirty WHERE {lost}" for dim, (key, lost) in _UNMATCHED.items())

# --------------------------------------------------------------------------- semantic layer
M = {
    "total_transactions": N, "successful_transactions": n(OK), "failed_transactions": n(BAD),
    "pending_transactions": n(PENDING), "success_rate_pct": share(OK),
    "failure_rate_pct": share(BAD), "pending_rate_pct": share(PENDING),
    "total_revenue": money("amount", OK), "avg_transaction_amount": avg("amount", OK),
    "total_net_revenue": money("net_amount", OK), "total_cashback": CASH,
    "total_discounts": money("discount_applied"), "total_savings": money("total_savings"),
    "lost_revenue": money("amount", BAD), "unique_users": USERS,
    "avg_transactions_per_user": f"CAST(count(*) AS DOUBLE) / {USERS}",
    "avg_revenue_per_user": f"coalesce({money('amount', OK)} / {USERS}, 0)",
    "flagged_transactions": n("is_flagged"), "fraud_rate_pct": share("is_flagged"),
    "avg_flagged_amount": avg("amount", "is_flagged"),
    "total_flagged_volume": money("amount", "is_flagged"), "total_refunds": n("is_refunded"),
    "refund_rate_pct": share("is_refunded"), "total_refund_value": money("refund_amount"),
    "avg_refund_amount": avg("refund_amount", "is_refunded"),
    "avg_processing_time": avg("processing_time_sec", OK),
    "avg_failed_processing_time": avg("processing_time_sec", BAD),
    "avg_failed_amount": avg("amount", BAD),
}


def measures(names, keys=(), table="ft", where=None):
    return group(table, list(keys), {m: M[m] for m in names}, where)


for _name, _measures in {
    "m_1_4_volume": ["total_transactions", "successful_transactions", "failed_transactions",
                     "pending_transactions"],
    "m_5_7_rates": ["success_rate_pct", "failure_rate_pct", "pending_rate_pct"],
    "m_8_10_revenue": ["total_revenue", "avg_transaction_amount", "total_net_revenue"],
    "m_11_13_promotions": ["total_cashback", "total_discounts", "total_savings"],
    "m_14_lost_revenue": ["lost_revenue"],
    "m_15_17_users": ["unique_users", "avg_transactions_per_user", "avg_revenue_per_user"],
    "m_18_21_fraud": ["flagged_transactions", "fraud_rate_pct", "avg_flagged_amount",
                      "total_flagged_volume"],
    "m_22_25_refunds": ["total_refunds", "refund_rate_pct", "total_refund_value",
                        "avg_refund_amount"],
    "m_26_27_processing": ["avg_processing_time", "avg_failed_processing_time"],
}.items():
    SQL[_name] = measures(_measures, ["category"])


def user_levels(keys, grains):
    """User figures counted anew for each period, under each other."""
    out = []
    for grain in grains:
        start = "NULL::VARCHAR" if grain == "all" else f"CAST(CAST(date_trunc('{grain}', date) AS DATE) AS VARCHAR)"
        columns = {"period_start": start, "grain": f"'{grain}'", "unique_users": USERS, "transactions": N,
                   "revenue": money("amount", OK), "avg_transactions_per_user": f"{N}::DOUBLE / {USERS}",
                   "avg_revenue_per_user": f"coalesce({money('amount', OK)} / {USERS}, 0)"}
        out.append(f"({group('ft', list(keys), columns, tail='' if keys else 'GROUP BY ALL')})")
    return " UNION ALL ".join(out)


SQL["m_15_17_user_sets_by_period"] = user_levels([], ["month", "quarter", "year", "all"])
SQL["m_15_17_user_sets_by_method"] = user_levels(["payment_method"], ["quarter", "year", "all"])
SQL["m_all_global"] = measures(list(M))
SQL["m_28_29_status_bands"] = f"""SELECT *,
  CASE WHEN success_rate_pct >= 95 THEN 'good' WHEN success_rate_pct >= 90 THEN 'warn'
    ELSE 'bad' END AS success_band,
  CASE WHEN fraud_rate_pct <= 2 THEN 'good' WHEN fraud_rate_pct <= 5 THEN 'warn'
    ELSE 'bad' END AS fraud_band
  FROM ({measures(['success_rate_pct', 'fraud_rate_pct'], ['payment_method'])})"""
SQL["m_30_period_label"] = """SELECT 'Period: ' || strftime(min(date), '%d %b %Y') || ' – ' ||
  strftime(max(date), '%d %b %Y') AS period_label FROM ft"""
SQL["m_31_32_revenue_text"] = f"""SELECT payment_method, CAST(v AS DOUBLE) AS total_revenue,
  {unit_text('c', 10000000, ' Cr')} AS revenue_in_crores,
  {unit_text('c', 100000, ' L')} AS revenue_in_lakhs
  FROM (SELECT payment_method, sum(amount) AS v, CAST(sum(amount) * 100 AS HUGEINT) AS c
        FROM ft WHERE {OK} GROUP BY payment_method)"""


def months(keys=()):
    shown = "".join(f"{k}, " for k in keys)
    return (f"(SELECT {shown}CAST(date_trunc('month', date) AS DATE) AS m, "
            f"sum(amount) FILTER (WHERE {OK}) AS revenue, count(*) AS transactions "
            f"FROM ft GROUP BY ALL)")


def cells(back, keys=()):
    """Months with figures of their own or of ``back`` months before, up to the last month."""
    shown = "".join(f"{k}, " for k in keys)
    return f"""(SELECT {shown}m, max(revenue) AS revenue, max(transactions) AS transactions FROM (
    SELECT * FROM {months(keys)} UNION ALL
    SELECT {shown}CAST(m + INTERVAL {back} MONTH AS DATE), NULL, NULL FROM {months(keys)})
  WHERE m <= (SELECT CAST(date_trunc('month', max(date)) AS DATE) FROM ft) GROUP BY {shown}m)"""


def growth(now, then):
    return (f"coalesce((CAST(coalesce({now}, 0) AS DOUBLE) - CAST({then} AS DOUBLE)) "
            f"/ nullif(CAST({then} AS DOUBLE), 0) * 100, 0)")


def shifted(back, suffix, grown, keys=()):
    shown = "".join(f"c.{k}, " for k in keys)
    same = "".join(f" AND c.{k} = p.{k}" for k in keys)
    return f"""SELECT {shown}CAST(c.m AS VARCHAR) AS month_start, CAST(c.revenue AS DOUBLE) AS revenue,
  c.transactions, CAST(p.revenue AS DOUBLE) AS revenue_{suffix},
  p.transactions AS transactions_{suffix}, {growth('c.revenue', 'p.revenue')} AS revenue_{grown},
  {growth('c.transactions', 'p.transactions')} AS transactions_{grown}
  FROM {cells(back, keys)} c LEFT JOIN {months(keys)} p
  ON p.m = CAST(c.m - INTERVAL {back} MONTH AS DATE){same}"""


SQL["ti_1_4_month_over_month"] = shifted(1, "pm", "mom_pct")
SQL["ti_1_4_month_over_month_by_method"] = shifted(1, "pm", "mom_pct", ["payment_method"])
SQL["ti_5_8_year_over_year"] = shifted(12, "py", "yoy_pct")
RUN = "ORDER BY d ROWS UNBOUNDED PRECEDING"


def spine(keys=()):
    shown = "".join(f"{k}, " for k in keys)
    labels = f", (SELECT DISTINCT {', '.join(keys)} FROM ft) l" if keys else ""
    same = "".join(f" AND s.{k} = x.{k}" for k in keys)
    return f"""(SELECT {"".join(f"s.{k}, " for k in keys)}s.d, revenue, transactions FROM
  (SELECT {shown}CAST(d AS DATE) AS d FROM (SELECT unnest(generate_series(
     (SELECT min(date) FROM ft)::TIMESTAMP, (SELECT max(date) FROM ft)::TIMESTAMP,
     INTERVAL 1 DAY)) AS d){labels}) s
  LEFT JOIN (SELECT {shown}date, sum(amount) FILTER (WHERE {OK}) AS revenue,
     count(*) AS transactions FROM ft GROUP BY ALL) x ON s.d = x.date{same})"""


def running(value, *parts):
    by = f"PARTITION BY {', '.join(parts)} " if parts else ""
    return f"sum({value}) OVER ({by}{RUN})"


def to_date(columns, keys=()):
    year, quarter, month = "year(d)", "quarter(d)", "month(d)"
    forms = {
        "revenue_ytd": f"CAST({running('revenue', *keys, year)} AS DOUBLE)",
        "transactions_ytd": f"CAST({running('transactions', *keys, year)} AS BIGINT)",
        "revenue_qtd": f"CAST({running('revenue', *keys, year, quarter)} AS DOUBLE)",
        "revenue_mtd": f"CAST({running('revenue', *keys, year, month)} AS DOUBLE)",
        "cumulative_revenue": f"CAST({running('revenue', *keys)} AS DOUBLE)",
        "cumulative_transactions": f"CAST({running('transactions', *keys)} AS BIGINT)",
    }
    shown = ", ".join(f"{forms[c]} AS {c}" for c in columns)
    return (f"SELECT {''.join(f'{k}, ' for k in keys)}CAST(d AS VARCHAR) AS date, {shown} "
            f"FROM {spine(keys)}")


SQL["ti_9_12_to_date_by_day"] = to_date(
    ["revenue_ytd", "transactions_ytd", "revenue_qtd", "revenue_mtd"])
SQL["ti_13_14_cumulative_by_day"] = to_date(["cumulative_revenue", "cumulative_transactions"])
SQL["ti_9_14_by_day_and_platform"] = to_date(
    ["revenue_ytd", "transactions_ytd", "revenue_qtd", "revenue_mtd", "cumulative_revenue",
     "cumulative_transactions"], ["platform"])


def to_month(keys=(), where="TRUE"):
    """Running figures at the end of every month of every label."""
    shown = "".join(f"{k}, " for k in keys)
    same = "".join(f" AND s.{k} = x.{k}" for k in keys)
    picked = f"(SELECT * FROM ft WHERE {where})"
    labels = f", (SELECT DISTINCT {', '.join(keys)} FROM {picked}) l" if keys else ""
    inside = "year(d)" + "".join(f", {k}" for k in keys)

    def over(parts):
        return f"OVER (PARTITION BY {parts} {RUN})" if parts else f"OVER ({RUN})"

    whole = over(", ".join(keys))
    return f"""SELECT {shown}CAST(d AS VARCHAR) AS month_start,
  CAST(sum(revenue) {over(inside)} AS DOUBLE) AS revenue_ytd,
  CAST(sum(transactions) {over(inside)} AS BIGINT) AS transactions_ytd,
  CAST(sum(revenue) {over(inside + ', quarter(d)')} AS DOUBLE) AS revenue_qtd,
  CAST(revenue AS DOUBLE) AS revenue_mtd,
  CAST(sum(revenue) {whole} AS DOUBLE) AS cumulative_revenue,
  CAST(sum(transactions) {whole} AS BIGINT) AS cumulative_transactions
  FROM (SELECT {"".join(f"s.{k}, " for k in keys)}s.d, revenue, transactions FROM
    (SELECT {shown}CAST(d AS DATE) AS d FROM (SELECT unnest(generate_series(
       (SELECT date_trunc('month', min(date)) FROM {picked})::TIMESTAMP,
       (SELECT date_trunc('month', max(date)) FROM {picked})::TIMESTAMP,
       INTERVAL 1 MONTH)) AS d){labels}) s
    LEFT JOIN (SELECT {shown}CAST(date_trunc('month', date) AS DATE) AS d,
       sum(amount) FILTER (WHERE {OK}) AS revenue, count(*) AS transactions
       FROM {picked} GROUP BY ALL) x ON s.d = x.d{same})"""


def period_visual(cells, labels, columns, dates, where):
    """Figures of cells (name: SQL over a day ``d``) and labels; each cell's dates are listed and
    every figure joins the facts to the dates it stands for."""
    names, cells = list(cells), {f"c_{name}": sql for name, sql in cells.items()}
    c = "".join(f"{name}, " for name in cells)
    keys = ", ".join([*cells, *labels])
    base = f"sum(amount) FILTER (WHERE {OK}) AS revenue_{{0}}, count(*) AS transactions_{{0}}"
    parts = [f"""SELECT {keys}, {base.format('now')}, count(*) FILTER (WHERE {OK}) AS ok_now
      FROM x JOIN ctx ON x.date = ctx.d GROUP BY ALL"""]
    for name, back in (("pm", 1), ("py", 12)):
        parts.append(f"""SELECT {keys}, {base.format(name)} FROM x JOIN (
          SELECT DISTINCT {c}f.date AS t FROM ctx JOIN (SELECT DISTINCT date FROM x) f
            ON f.date = CAST(ctx.d - INTERVAL {back} MONTH AS DATE)
          UNION SELECT {c}f.date FROM whole JOIN (SELECT DISTINCT date FROM x) f
            ON date_trunc('month', f.date) = whole.m - INTERVAL {back} MONTH
        ) p ON x.date = p.t GROUP BY ALL""")
    for name, same in (("ytd", "year"), ("qtd", "quarter"), ("mtd", "month"), ("ever", None)):
        inside = f" AND date_trunc('{same}', x.date) = date_trunc('{same}', e.last)" if same else ""
        parts.append(f"""SELECT {keys}, {base.format(name)} FROM x JOIN (
          SELECT {c}max(d) AS last FROM ctx GROUP BY ALL) e ON x.date <= e.last{inside} GROUP BY ALL""")
    union = " UNION ALL BY NAME ".join(f"({p})" for p in parts)
    forms = {"total_revenue": ("revenue", "now"), "total_transactions": ("transactions", "now"),
             "cumulative_revenue": ("revenue", "ever"), "cumulative_transactions": ("transactions", "ever")}
    out = []
    for name in columns:
        what, _, period = name.partition("_")
        if name == "success_rate_pct":
            sql = "coalesce(CAST(any_value(ok_now) AS DOUBLE) / any_value(transactions_now) * 100, 0)"
        elif name.endswith("_growth_pct"):
            then = {"mom": "pm", "yoy": "py"}[period.split("_")[0]]
            sql = growth(f"any_value({what}_now)", f"any_value({what}_{then})")
        else:
            what, period = forms.get(name, (what, period))
            sql = f"CAST(any_value({what}_{period}) AS {'DOUBLE' if what == 'revenue' else 'BIGINT'})"
        out.append(f"{sql} AS {name}")
    solid = [n for n in columns if not n.endswith("_growth_pct")]
    shown = ", ".join([*(f"CAST(c_{k} AS VARCHAR) AS {k}" for k in names), *labels])
    attributes = "".join(f", {sql} AS {name}" for name, sql in cells.items())
    return f"""SELECT * FROM (WITH cal AS (SELECT CAST(unnest(generate_series(min(date)::TIMESTAMP, max(date)::TIMESTAMP,
        INTERVAL 1 DAY)) AS DATE) AS d FROM ft),
      ctx AS (SELECT d{attributes} FROM cal WHERE {dates}),
      whole AS (SELECT {c}date_trunc('month', d) AS m FROM ctx {'WHERE false' if 'date' in names else ''} GROUP BY ALL
        HAVING count(*) = (SELECT count(*) FROM cal WHERE date_trunc('month', cal.d) = date_trunc('month', any_value(ctx.d)))),
      x AS (SELECT * FROM tu WHERE {where}),
      joined AS (SELECT {keys}, {', '.join(out)} FROM ({union}) GROUP BY {keys})
    SELECT {shown}, {', '.join(columns)} FROM joined WHERE coalesce({', '.join(solid)}) IS NOT NULL)"""


DAY_NAME = "dayname(d)"
SQL["ti_1_14_visual_month_in_range"] = period_visual(
    {"month_year": "strftime(d, '%b %Y')"}, [],
    ["total_revenue", "total_transactions", "success_rate_pct", "revenue_pm", "revenue_mom_growth_pct",
     "transactions_pm", "transactions_mom_growth_pct", "revenue_ytd", "cumulative_revenue"],
    "d BETWEEN DATE '1998-03-10' AND DATE '1998-08-20'",
    "payment_method IN ('UPI', 'Credit Card', 'Net Banking')")
SQL["ti_5_14_visual_method_in_year"] = period_visual(
    {}, ["payment_method"],
    ["revenue_py", "revenue_yoy_growth_pct", "transactions_py", "transactions_yoy_growth_pct",
     "transactions_ytd", "cumulative_transactions"],
    "year(d) = 1998", "customer_tier IN ('Premium', 'VIP')")
SQL["ti_1_14_visual_quarter_by_tier"] = period_visual(
    {"quarter_label": "'Q' || quarter(d)"}, ["customer_tier"],
    ["total_revenue", "revenue_pm", "revenue_py", "revenue_ytd", "revenue_qtd", "revenue_mtd",
     "cumulative_transactions"],
    "year(d) = 1997", "age_group IN ('25-34', '35-44') AND platform IN ('Mobile App', 'QR Code')")
SQL["ti_1_14_visual_days_over_month_ends"] = period_visual(
    {"date": "d"}, [],
    ["total_transactions", "revenue_pm", "transactions_pm", "revenue_py", "revenue_mtd", "revenue_qtd",
     "transactions_ytd", "cumulative_revenue"],
    "d BETWEEN DATE '1996-02-25' AND DATE '1996-04-03'",
    "category IN ('Food & Dining', 'Shopping', 'Groceries', 'Entertainment')")
SQL["ti_5_14_visual_day_name_and_platform"] = period_visual(
    {"day_name": DAY_NAME}, ["platform"],
    ["total_transactions", "transactions_pm", "transactions_py", "transactions_yoy_growth_pct",
     "transactions_ytd", "revenue_qtd"],
    "year(d) = 1999 AND month(d) IN (2, 5)", "true")
SQL["ti_9_10_year_to_date_by_month"] = to_month()
SQL["ti_9_14_by_month_and_method"] = to_month(["payment_method"], "status = 'Success' AND amount > 200")

# --------------------------------------------------------------------------- visuals
MONTH_YEAR = "strftime(date, '%b %Y') AS month_year"
VISUALS = {
    "1_total_transactions_cards": ([], ["total_transactions", "total_revenue", "success_rate_pct",
                                        "unique_users", "fraud_rate_pct", "total_cashback"]),
    "2_total_transactions_by_month_year": ([MONTH_YEAR], ["total_transactions", "success_rate_pct"]),
    "3_total_transactions_by_payment_method": (["payment_method"], ["total_transactions"]),
    "4_total_revenue_by_category": (["category"], ["total_revenue"]),
    "5_total_transactions_by_city": (["city"], ["total_transactions"]),
    "6_total_transactions_by_day_name_hour": (["day_name", "hour"], ["total_transactions"]),
    "7_total_transactions_by_time_bucket": (["time_bucket"], ["total_transactions",
                                                             "success_rate_pct"]),
    "8_total_transactions_by_day_name": (["day_name"], ["total_transactions", "success_rate_pct"]),
    "9_success_rate_pct_by_payment_method": (["payment_method"], ["success_rate_pct"]),
    "10_total_transactions_by_amount_bucket": (["amount_bucket"], ["total_transactions"]),
    "11_failed_transactions_cards": ([], ["failed_transactions", "failure_rate_pct",
                                          "lost_revenue", "avg_failed_amount"]),
    "13_lost_revenue_by_payment_method": (["payment_method"], ["lost_revenue"]),
    "14_total_transactions_by_hour": (["hour"], ["total_transactions", "failure_rate_pct"]),
    "16_total_transactions_by_age_group": (["age_group"], ["total_transactions",
                                                          "avg_transaction_amount"]),
    "17_total_transactions_by_customer_tier": (["customer_tier"], ["total_transactions"]),
    "18_avg_transaction_amount_by_spending_persona": (["spending_persona"],
                                                      ["avg_transaction_amount"]),
    "19_total_transactions_by_gender": (["gender"], ["total_transactions"]),
    "20_total_transactions_by_account_tenure": (["account_tenure"], ["total_transactions"]),
    "21_unique_users_by_month_year": ([MONTH_YEAR], ["unique_users", "avg_transactions_per_user"]),
    "22_flagged_transactions_cards": ([], ["flagged_transactions", "fraud_rate_pct",
                                           "avg_flagged_amount", "total_flagged_volume"]),
    "25_total_refunds_cards": ([], ["total_refunds", "refund_rate_pct", "total_refund_value",
                                    "avg_refund_amount"]),
    "26_total_refund_value_by_category": (["category"], ["total_refund_value"]),
    "27_total_refund_value_by_payment_method": (["payment_method"], ["total_refund_value"]),
    "28_total_transactions_by_platform": (["platform"], ["total_transactions"]),
    "29_total_transactions_by_device_type": (["device_type"], ["total_transactions"]),
    "30_success_rate_pct_by_platform": (["platform"], ["success_rate_pct"]),
    "31_total_transactions_by_channel": ([f"{CHANNEL} AS channel"], ["total_transactions"]),
    "32_total_cashback_by_payment_method": (["payment_method"], ["total_cashback"]),
    "33_total_discounts_by_category": (["category"], ["total_discounts"]),
    "34_total_transactions_by_processing_speed": (["processing_speed"], ["total_transactions"]),
    "35_avg_processing_time_cards": ([], ["avg_processing_time"]),
    "36a_total_transactions_by_is_weekend": (["is_weekend"], ["total_transactions"]),
    "36b_avg_transaction_amount_by_month_year": ([MONTH_YEAR], ["avg_transaction_amount",
                                                               "fraud_rate_pct"]),
}
for _name, (_keys, _measures) in VISUALS.items():
    SQL[f"vz_{_name}"] = measures(_measures, _keys, "tu")
SQL["vz_12_failed_transactions_by_failure_reason"] = group(
    "ft", "failure_reason", {"failed_transactions": N}, BAD)
SQL["vz_15_failed_transactions_by_payment_method_failure_reason"] = group(
    "ft", ["payment_method", "failure_reason"], {"failed_transactions": N}, BAD)
SQL["vz_23_flagged_transactions_by_fraud_reason"] = group(
    "ft", "fraud_reason", {"flagged_transactions": N}, "is_flagged")
SQL["vz_24_total_flagged_volume_by_category"] = group(
    "ft", "category", {"total_flagged_volume": money("amount")}, "is_flagged")
SQL["vz_36c_total_refunds_by_category"] = group(
    "ft", "category", {"total_refunds": N}, "is_refunded")
SQL["vz_36d_success_rate_pct_by_device_type"] = measures(
    ["success_rate_pct", "avg_transaction_amount"], ["device_type"], "ft", MOBILE)
def matrix(names, keys, where="true", blank="total_transactions"):
    """Every level of a matrix as a query of its own; groups without a count are hidden."""
    out = []
    for chosen in [list(keys), *[[k] for k in keys if len(keys) > 1], []]:
        kept = [f"{keys[k]} AS {k}" if k in chosen else f"CAST(NULL AS {'INT' if k == 'hour' else 'VARCHAR'}) AS {k}"
                for k in keys]
        marks = [f"{'false' if k in chosen else 'true'} AS all_{k}" for k in keys]
        by = ", ".join(keys[k] for k in chosen)
        out.append(f"SELECT {', '.join([*kept, *marks, *[f'{M[m]} AS {m}' for m in names]])} FROM tu "
                   f"WHERE {where}{f' GROUP BY {by}' if by else ''} HAVING {M[blank]} > 0")
    return " UNION ALL ".join(f"({q})" for q in out)


SQL["vz_6_matrix_with_totals"] = matrix(
    ["total_transactions", "success_rate_pct", "unique_users", "total_revenue"],
    {"day_name": "dayname(date)", "hour": HOUR})
SQL["vz_15_matrix_with_totals"] = matrix(
    ["failed_transactions", "lost_revenue", "avg_failed_amount"],
    {"payment_method": "payment_method", "failure_reason": "failure_reason"}, blank="failed_transactions")
SQL["vz_17_matrix_tier_by_channel"] = matrix(
    ["total_transactions", "unique_users", "avg_transactions_per_user", "fraud_rate_pct"],
    {"customer_tier": "customer_tier", "channel": CHANNEL.split(" AS ")[0]}, "year(date) IN (1997, 1998)")
SQL["vz_21_months_with_total"] = matrix(
    ["unique_users", "avg_transactions_per_user", "total_transactions"], {"month_year": "strftime(date, '%b %Y')"})
SQL["vz_36e_amount_by_flag"] = box("amount")
SQL["vz_37_platform_shares"] = f"""SELECT platform, txn,
  {half_up('100 * txn', '(SELECT count(*) FROM ft)', 1)} AS share_pct,
  CAST(txn AS DOUBLE) / max(txn) OVER () AS ratio_to_max
  FROM (SELECT platform, count(*) AS txn FROM ft GROUP BY platform)"""
SQL["vz_37_top_reasons_others"] = f"""SELECT reason, CAST(sum(c) AS BIGINT) AS count,
  CAST(sum(lost) AS DOUBLE) AS lost, {half_up('100 * sum(c)', 'any_value(all_c)', 1)} AS pct
  FROM (SELECT CASE WHEN row_number() OVER (ORDER BY c DESC, failure_reason) <= 3
      THEN failure_reason ELSE 'Others' END AS reason, c, lost, sum(c) OVER () AS all_c
    FROM (SELECT failure_reason, count(*) AS c, sum(amount) AS lost FROM ft
          WHERE {BAD} AND failure_reason IS NOT NULL GROUP BY failure_reason)) GROUP BY reason"""
SQL["tk_6_time_ordered_export"] = f"SELECT transaction_id, {TS} FROM transactions"

ORACLES = {name: with_tables(sql) for name, sql in SQL.items()}
