"""Column names and fixed schemas of the layers."""

from __future__ import annotations

from pyspark.sql import types as T

ID = "transaction_id"
CORRUPT = "_corrupt_record"
VALID = "_valid_utf8"

# Column names and types of the layers.
TRANSACTION = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("customer_email", T.StringType()),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("transaction_amount", T.DoubleType()),
        T.StructField("transaction_date", T.DateType()),
    ]
)
ACCOUNT = T.StructType(
    [
        T.StructField("account_no", T.StringType()),
        T.StructField("account_type", T.StringType()),
        T.StructField("balance", T.DoubleType()),
    ]
)
ACCOUNT_TRANSACTION = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("account_no", T.StringType()),
        T.StructField("full_date", T.DateType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("transaction_type", T.StringType()),
    ]
)
RAW_CSV = T.StructType([*TRANSACTION.fields, T.StructField(CORRUPT, T.StringType())])
DIM_CUSTOMER = T.StructType(
    [
        T.StructField("customer_name", T.StringType()),
        T.StructField("customer_email", T.StringType()),
        T.StructField("customer_id", T.LongType()),
    ]
)
DIM_MERCHANT = T.StructType(
    [
        T.StructField("merchant_name", T.StringType()),
        T.StructField("merchant_id", T.LongType()),
    ]
)
DIM_DATE = T.StructType(
    [
        T.StructField("transaction_date", T.DateType()),
        T.StructField("date_id", T.LongType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("weekday", T.IntegerType()),
    ]
)
FACT = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("merchant_id", T.LongType()),
        T.StructField("transaction_amount", T.DoubleType()),
        T.StructField("date_id", T.LongType()),
        T.StructField("load_timestamp", T.TimestampNTZType()),
    ]
)
MONEY = T.DecimalType(18, 2)
COLUMNS = TRANSACTION.fieldNames()
