"""Small literal tables for the unit tests."""

from datetime import datetime
from decimal import Decimal

from tallyspark import schemas

DEFAULTS = {
    "transaction_id": "TXN1", "user_id": "USR1", "transaction_datetime": datetime(2024, 3, 15, 10),
    "payment_method": "UPI", "category": "Travel", "merchant": "M", "amount": "100.00",
    "status": "Success", "failure_reason": None, "platform": "Mobile App",
    "device_type": "Android", "city": "Pune", "processing_time_sec": "1.00", "is_weekend": 0,
    "cashback_earned": "0.00", "discount_applied": "0.00", "is_flagged": False,
    "fraud_reason": None, "is_refunded": False, "refund_amount": "0.00",
}
MONEY = {"amount", "processing_time_sec", "cashback_earned", "discount_applied", "refund_amount"}


def transactions(spark, *rows):
    """A transactions table; each row is a dict of what differs from the defaults."""
    out = []
    for i, row in enumerate(rows):
        full = {**DEFAULTS, "transaction_id": f"TXN{i}", **row}
        out.append(tuple(
            Decimal(full[f.name]) if f.name in MONEY and full[f.name] is not None else full[f.name]
            for f in schemas.TRANSACTIONS
        ))
    return spark.createDataFrame(out, schemas.TRANSACTIONS)


def profiles(spark, *rows):
    base = {"user_id": "USR1", "city": "Delhi", "age_group": "25-34", "gender": "Male",
            "account_tenure": "1-2 years", "customer_tier": "VIP",
            "spending_persona": "Moderate", "preferred_method": "UPI"}
    table = [tuple({**base, **r}[f.name] for f in schemas.USER_PROFILES) for r in rows]
    return spark.createDataFrame(table, schemas.USER_PROFILES)


def column(df, name, order="transaction_id"):
    return [r[name] for r in df.orderBy(order).collect()]
