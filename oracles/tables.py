"""The derived tables in DuckDB SQL, as common table expressions.

Written independently of the Spark code from the same fixed derivation rules, so a
mistake on one side shows as a difference.
"""

import re

# Label lists, thresholds and band bounds have to equal those of the catalogue.
CTES = {
    "transactions": """
SELECT k AS transaction_id, o_custkey AS user_id, transaction_datetime,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'UPI' WHEN '2-HIGH' THEN 'Credit Card'
    WHEN '3-MEDIUM' THEN 'Debit Card' WHEN '4-NOT SPECIFIED' THEN 'Net Banking'
    ELSE 'Mobile Wallet' END AS payment_method,
  CASE WHEN k % 13 = 0 THEN ' ' || label || ' ' ELSE label END AS category,
  'Merchant ' || (k % 70) AS merchant, amount, status,
  CASE WHEN status = 'Failed' THEN CASE WHEN k % 11 = 0 THEN NULL ELSE
      ['Bank Server Down','Insufficient Balance','Server Timeout','Session Expired',
       'Card Declined'][((k // 7) % 5 + 1)::INT] END
    WHEN status = 'Pending' THEN 'Processing'
    WHEN k % 50 = 7 THEN 'Stale Reason' END AS failure_reason,
  platform,
  CASE platform WHEN 'POS Terminal' THEN 'POS'
    WHEN 'Web Browser' THEN ['Windows','Mac','Linux'][((k // 40) % 3 + 1)::INT]
    ELSE ['Android','iOS'][((k // 40) % 2 + 1)::INT] END AS device_type,
  city,
  CAST((50 + (k * 37) % 2950) * 0.01 AS DECIMAL(5,2)) AS processing_time_sec,
  CAST(isodow(transaction_datetime) >= 6 AS INT) AS is_weekend,
  CASE WHEN status = 'Success' AND (k // 3) % 4 = 1
    THEN CAST(round(amount * 0.05, 2) AS DECIMAL(10,2)) ELSE CAST(0 AS DECIMAL(10,2)) END
    AS cashback_earned,
  CASE WHEN status = 'Success' AND label IN ('Shopping','Food & Dining','Groceries') AND k % 3 = 0
    THEN CAST(round(amount * 0.10, 2) AS DECIMAL(10,2)) ELSE CAST(0 AS DECIMAL(10,2)) END
    AS discount_applied,
  (fraud_reason IS NOT NULL AND k % 2 = 0) AS is_flagged, fraud_reason, is_refunded,
  CAST(CASE WHEN NOT is_refunded THEN 0 WHEN k % 17 = 0 THEN amount * 2
    WHEN k % 5 < 3 THEN amount ELSE round(amount * 0.5, 2) END AS DECIMAL(12,2)) AS refund_amount
FROM (
  SELECT *,
    (label IN ('Shopping','Travel','Food & Dining','Entertainment') AND (k // 5) % 7 = 2)
      AS is_refunded,
    CASE WHEN hour(transaction_datetime) <= 4 AND amount > 5000
        THEN 'Suspicious Late Night Transaction'
      WHEN amount > CASE label WHEN 'Food & Dining' THEN 2000 WHEN 'Shopping' THEN 12000
        WHEN 'Bills & Utilities' THEN 4000 WHEN 'Travel' THEN 10000 WHEN 'Entertainment' THEN 1200
        WHEN 'Health' THEN 6000 WHEN 'Education' THEN 15000 WHEN 'Transfers' THEN 40000
        WHEN 'Groceries' THEN 3000 ELSE 80000 END THEN 'Unusually High Amount' END AS fraud_reason
  FROM (
    SELECT o_orderkey AS k, o_custkey, o_orderpriority, n_name AS city,
      o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) AS transaction_datetime,
      CAST((CAST(round(o_totalprice * 100) AS BIGINT) // CASE WHEN o_orderkey % 10 = 0 THEN 1
        WHEN o_orderkey % 10 <= 3 THEN 10 WHEN o_orderkey % 10 <= 6 THEN 100 ELSE 1000 END) * 0.01
        AS DECIMAL(12,2)) AS amount,
      CASE o_orderstatus WHEN 'O' THEN 'Success' WHEN 'F' THEN 'Failed' ELSE 'Pending' END AS status,
      ['Food & Dining','Shopping','Bills & Utilities','Travel','Entertainment','Health',
       'Education','Transfers','Groceries','Investments'][((o_orderkey // 24) % 10 + 1)::INT]
        AS label,
      ['Mobile App','Web Browser','POS Terminal','QR Code'][((o_orderkey // 10) % 4 + 1)::INT]
        AS platform
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
      LEFT JOIN nation ON c_nationkey = n_nationkey))
""",
    "user_profiles": """
SELECT c_custkey AS user_id, n_name AS city,
  ['18-24','25-34','35-44','45-54','55+'][(c_custkey % 5 + 1)::INT] AS age_group,
  ['Male','Female','Other'][(c_custkey % 3 + 1)::INT] AS gender,
  ['0-6 months','6-12 months','1-2 years','2-5 years','5+ years'][((c_custkey // 2) % 5 + 1)::INT]
    AS account_tenure,
  ['New','Regular','Premium','VIP'][((c_custkey // 3) % 4 + 1)::INT] AS customer_tier,
  ['Budget','Moderate','High Spender','Impulse'][((c_custkey // 5) % 4 + 1)::INT]
    AS spending_persona,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'UPI' WHEN 'BUILDING' THEN 'Credit Card'
    WHEN 'FURNITURE' THEN 'Debit Card' WHEN 'HOUSEHOLD' THEN 'Net Banking'
    ELSE 'Mobile Wallet' END AS preferred_method
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""",
    "dirty": """
SELECT * FROM transactions WHERE transaction_id % 991 <> 0
UNION ALL BY NAME
SELECT * REPLACE (CAST(-amount AS DECIMAL(12,2)) AS amount,
    CAST(-1 AS DECIMAL(10,2)) AS cashback_earned, CAST(-1 AS DECIMAL(10,2)) AS discount_applied)
  FROM transactions WHERE transaction_id % 991 = 0
UNION ALL BY NAME
SELECT * REPLACE (CAST(-1 AS BIGINT) AS user_id) FROM transactions WHERE transaction_id % 997 = 0
""",
    "ct": """
SELECT * REPLACE (
  trim(payment_method, ' ') AS payment_method, trim(category, ' ') AS category,
  trim(merchant, ' ') AS merchant, trim(city, ' ') AS city, trim(platform, ' ') AS platform,
  trim(device_type, ' ') AS device_type,
  trim(CASE WHEN status = 'Failed' AND coalesce(failure_reason, '') = '' THEN 'Unknown'
    WHEN status = 'Success' AND failure_reason <> '' THEN NULL ELSE failure_reason END, ' ')
    AS failure_reason,
  trim(CASE WHEN NOT is_flagged THEN NULL ELSE fraud_reason END, ' ') AS fraud_reason,
  (is_refunded AND status = 'Success') AS is_refunded,
  CASE WHEN is_refunded AND status <> 'Success' THEN 0
    WHEN is_refunded AND refund_amount > amount THEN amount ELSE refund_amount END AS refund_amount)
FROM transactions
""",
    "ft": """
SELECT *,
  CAST(amount * 100 AS BIGINT) AS amount_cents,
  CAST((cashback_earned + discount_applied) * 100 AS BIGINT) AS savings_cents,
  CASE WHEN amount > 0 THEN (2 * savings_cents * 10000 + amount_cents) // (2 * amount_cents)
    ELSE 0 END AS savings_bp
FROM (
SELECT * REPLACE (trim(category) AS category),
  CAST(transaction_datetime AS DATE) AS date, CAST(year(transaction_datetime) AS INT) AS year,
  CAST(month(transaction_datetime) AS INT) AS month,
  strftime(transaction_datetime, '%b') AS month_name,
  CAST(quarter(transaction_datetime) AS INT) AS quarter,
  'Q' || quarter(transaction_datetime) AS quarter_label,
  CAST(day(transaction_datetime) AS INT) AS day,
  CAST(isodow(transaction_datetime) - 1 AS INT) AS day_of_week,
  dayname(transaction_datetime) AS day_name, CAST(hour(transaction_datetime) AS INT) AS hour,
  CASE WHEN hour(transaction_datetime) BETWEEN 5 AND 11 THEN 'Morning'
    WHEN hour(transaction_datetime) BETWEEN 12 AND 16 THEN 'Afternoon'
    WHEN hour(transaction_datetime) BETWEEN 17 AND 20 THEN 'Evening' ELSE 'Night' END
    AS time_bucket,
  CAST(weekofyear(transaction_datetime) AS INT) AS week_number,
  CAST(day(transaction_datetime) <= 5 AS INT) AS is_month_start,
  CAST(day(transaction_datetime) >= 26 AS INT) AS is_month_end,
  CAST(month(transaction_datetime) IN (10, 11) AS INT) AS is_festival_season,
  CASE WHEN amount < 100 THEN 'Micro (<₹100)' WHEN amount < 500 THEN 'Small (₹100-500)'
    WHEN amount < 2000 THEN 'Medium (₹500-2K)' WHEN amount < 10000 THEN 'Large (₹2K-10K)'
    WHEN amount < 50000 THEN 'High (₹10K-50K)' ELSE 'Premium (₹50K+)' END AS amount_bucket,
  cashback_earned + discount_applied AS total_savings,
  greatest(amount - discount_applied - cashback_earned, 0) AS net_amount,
  CASE WHEN status = 'Failed' THEN 'Failed' WHEN processing_time_sec <= 1 THEN 'Instant'
    WHEN processing_time_sec <= 2 THEN 'Fast' WHEN processing_time_sec <= 5 THEN 'Normal'
    WHEN processing_time_sec <= 15 THEN 'Slow' ELSE 'Very Slow' END AS processing_speed
FROM transactions)
""",
    "ub": """
SELECT user_id, count(transaction_id) AS user_total_txns,
  CAST(coalesce(sum(amount) FILTER (WHERE status = 'Success'), 0) AS DOUBLE) AS user_total_spend,
  coalesce((2 * CAST(sum(amount) FILTER (WHERE status = 'Success') * 100 AS HUGEINT)
    + count(*) FILTER (WHERE status = 'Success'))
    // nullif(2 * count(*) FILTER (WHERE status = 'Success'), 0), 0)::DOUBLE / 100
    AS user_avg_txn_amount,
  ((20000 * count(*) FILTER (WHERE status = 'Failed') + count(*)) // (2 * count(*)))::DOUBLE / 100
    AS user_failure_rate_pct,
  CASE WHEN user_total_spend < 10000 THEN 'Low' WHEN user_total_spend < 50000 THEN 'Medium'
    WHEN user_total_spend < 200000 THEN 'High' ELSE 'Very High' END AS user_spending_tier
FROM ft GROUP BY user_id
""",
    "tu": """
SELECT ft.*, age_group, gender, account_tenure, customer_tier, spending_persona,
  preferred_method, u.city AS user_home_city
FROM ft LEFT JOIN user_profiles u ON ft.user_id = u.user_id
""",
    "cu": """
SELECT ct.*, age_group, gender, account_tenure, customer_tier, spending_persona,
  preferred_method, u.city AS user_home_city
FROM ct JOIN user_profiles u ON ct.user_id = u.user_id
""",
}


def with_tables(sql: str) -> str:
    """``sql`` preceded by the derived tables it uses, directly or through others."""
    needed = []

    def visit(text):
        for name in CTES:
            if re.search(rf"\b(?:FROM|JOIN)\s*\(?\s*{name}\b", text) and name not in needed:
                visit(CTES[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    tables = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    return f"WITH {tables}\n{sql}"
