"""Column names, defaults and texts every module shares."""

from pyspark.sql import types as T

USER = "User"
CARD = "Card"
AMOUNT = "Amount"
MERCHANT = "Merchant Name"
TS = "transaction_datetime"
HOUR = "txn_hour"
WEEKDAY = "txn_day_of_week"
LABEL_RAW = "Is Fraud?"
LABEL = "is_fraud"
ROW_ID = "row_id"

RAW_SCHEMA = T.StructType([
    T.StructField("User", T.LongType()),
    T.StructField("Card", T.LongType()),
    T.StructField("Year", T.IntegerType()),
    T.StructField("Month", T.IntegerType()),
    T.StructField("Day", T.IntegerType()),
    T.StructField("Time", T.StringType()),
    T.StructField("Amount", T.StringType()),
    T.StructField("Use Chip", T.StringType()),
    T.StructField("Merchant Name", T.LongType()),
    T.StructField("Merchant City", T.StringType()),
    T.StructField("Merchant State", T.StringType()),
    T.StructField("Zip", T.DoubleType()),
    T.StructField("MCC", T.IntegerType()),
    T.StructField("Errors?", T.StringType()),
    T.StructField("Is Fraud?", T.StringType()),
])
RAW_COLUMNS = RAW_SCHEMA.fieldNames()
CATEGORICALS = ["Use Chip", "Merchant City", "Merchant State", "MCC", "Errors?"]

# The engineered columns in model-input order.
FEATURES = [
    "customer_avg_amount",
    "customer_max_amount",
    "customer_txn_count",
    "merchant_txn_frequency",
    "avg_daily_spending",
    "weekend_indicator",
    "business_hour_indicator",
    "time_since_prev_txn",
    "rolling_avg_amount",
    "transaction_velocity",
    "merchant_diversity",
    "customer_activity_frequency",
    "amount_deviation_from_customer_mean",
    "amount_zscore_by_merchant",
]
NUMERIC_INPUTS = [*FEATURES, AMOUNT]

WEEKDAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

# Wording used when a flagged row is explained to an analyst.
DESCRIPTIONS = {
    "Amount": "size of the payment",
    "customer_avg_amount": "average spend of the customer so far",
    "customer_max_amount": "biggest earlier payment of the customer",
    "customer_txn_count": "number of earlier payments",
    "merchant_txn_frequency": "popularity of the merchant",
    "avg_daily_spending": "spend per active day",
    "weekend_indicator": "weekend timing",
    "business_hour_indicator": "office-hours timing",
    "time_since_prev_txn": "gap since the previous payment",
    "rolling_avg_amount": "average of the latest payments",
    "transaction_velocity": "payments within the last hour",
    "merchant_diversity": "number of merchants used so far",
    "customer_activity_frequency": "payments per active day",
    "amount_deviation_from_customer_mean": "distance from the customer's usual amount",
    "amount_zscore_by_merchant": "distance from the merchant's usual amount",
}


class SchemaValidationError(ValueError):
    """A required column is missing."""
