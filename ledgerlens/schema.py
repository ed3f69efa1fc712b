"""Record layouts, feature lists and the merchant dimension."""

from __future__ import annotations

from pyspark.sql import types as T

# Wire format of one transaction message. `timestamp` is an ISO-8601 string on
# the wire and becomes a TIMESTAMP when a message is parsed.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("timestamp", T.StringType(), False),
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("merchant_id", T.StringType(), False),
        T.StructField("merchant_category", T.StringType(), False),
        T.StructField("location_lat", T.DoubleType(), False),
        T.StructField("location_lon", T.DoubleType(), False),
        T.StructField("device_id", T.StringType(), False),
        T.StructField("is_online", T.BooleanType(), False),
        T.StructField("is_fraud", T.IntegerType(), False),
        T.StructField("card_last_4", T.StringType(), True),
        T.StructField("cvv_provided", T.BooleanType(), True),
    ]
)

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.TimestampType() if f.name == "timestamp" else f.dataType, f.nullable)
        for f in MESSAGE_SCHEMA
    ]
)

TRANSACTION_COLUMNS = MESSAGE_SCHEMA.fieldNames()
REQUIRED_COLUMNS = [f.name for f in MESSAGE_SCHEMA if not f.nullable]

# The narrower stream layout: no device and no card fields.
NARROW_COLUMNS = [c for c in TRANSACTION_COLUMNS if c not in ("device_id", "card_last_4", "cvv_provided")]

# --- Fixed values: output layouts and feature lists (order matters) ---------
RULE_OUTPUT = [
    "transaction_id", "user_id", "timestamp", "amount", "merchant_category", "is_online",
    "is_fraud", "predicted_fraud", "fraud_score", "risk_level",
    "hour_of_day", "is_unusual_hour", "is_high_amount", "is_high_risk_merchant",
    "true_positive", "false_positive", "true_negative", "false_negative",
]

MODEL_OUTPUT = [
    "transaction_id", "user_id", "timestamp", "amount", "merchant_id", "merchant_category", "is_online",
    "location_lat", "location_lon", "hour_of_day", "day_of_week", "is_unusual_hour", "is_weekend",
    "is_fraud", "predicted_fraud", "fraud_probability", "fraud_score", "risk_level",
    "true_positive", "false_positive", "true_negative", "false_negative",
]

BEHAVIOUR_OUTPUT = [
    "transaction_id", "user_id", "timestamp", "amount", "merchant_category", "is_online",
    "is_fraud", "predicted_fraud", "fraud_score", "risk_level",
    "hour_of_day", "is_unusual_hour", "is_rapid_transaction", "is_impossible_travel", "device_changed",
    "time_since_last_txn", "distance_from_prev",
    "true_positive", "false_positive", "true_negative", "false_negative",
]

CONSOLE_OUTPUT = [
    "transaction_id", "user_id", "amount", "is_fraud", "predicted_fraud", "fraud_score", "risk_level",
]

STREAM_FEATURES = [
    "hour_of_day", "day_of_week", "is_unusual_hour", "is_weekend",
    "amount", "amount_log", "is_high_amount", "is_very_high_amount", "is_round_amount",
    "is_high_risk_merchant", "is_online_merchant", "is_online", "is_online_flag",
]

BEHAVIOUR_FEATURES = [
    "hour_of_day", "day_of_week", "is_unusual_hour", "is_weekend", "amount", "amount_log",
    "time_since_last_txn", "is_rapid_transaction", "txn_count_5min",
    "distance_from_prev", "is_impossible_travel", "device_changed",
    "is_high_risk_merchant", "is_online",
]

MODEL_FEATURES = [
    "amount", "amount_log", "hour_of_day", "day_of_week", "is_weekend", "is_unusual_hour",
    "is_high_amount", "is_round_amount", "is_high_risk_merchant", "is_online_int",
    "location_lat", "location_lon",
]

HIGH_RISK_CATEGORIES = ["electronics", "online_shopping", "airline", "hotel"]

# category, average amount, standard deviation, frequency
MERCHANT_CATEGORIES = [
    ("supermarket", 45.0, 25.0, "high"),
    ("restaurant", 35.0, 20.0, "medium"),
    ("gas_station", 60.0, 15.0, "medium"),
    ("pharmacy", 25.0, 15.0, "low"),
    ("electronics", 350.0, 200.0, "low"),
    ("clothing", 80.0, 40.0, "low"),
    ("hotel", 150.0, 80.0, "very_low"),
    ("airline", 250.0, 150.0, "very_low"),
    ("online_shopping", 60.0, 40.0, "medium"),
    ("entertainment", 40.0, 20.0, "low"),
]
# --- end of fixed values ----------------------------------------------------

MERCHANT_SCHEMA = T.StructType(
    [
        T.StructField("merchant_category", T.StringType(), False),
        T.StructField("category_avg", T.DoubleType(), False),
        T.StructField("category_std", T.DoubleType(), False),
        T.StructField("category_frequency", T.StringType(), False),
    ]
)
