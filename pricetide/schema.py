"""Column lists and table schemas shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw feed columns and the names they get after cleaning.
RAW_TO_CLEAN = {
    "id": "product_id",
    "name": "product_name",
    "brand": "brand",
    "categories": "category",
    "prices.amountMin": "price_min",
    "prices.amountMax": "price_max",
    "prices.currency": "currency",
    "prices.dateSeen": "date_seen",
    "prices.merchant": "merchant",
    "prices.condition": "condition",
}
RAW_COLUMNS = list(RAW_TO_CLEAN)
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

CLEAN_COLUMNS = [
    *RAW_TO_CLEAN.values(),
    "price",
    "observed_date",
    "observed_year",
    "observed_month",
]

# Added when a feed is landed; never part of a row's identity.
LINEAGE_COLUMNS = ["_batch_id", "_ingested_at", "_source_file"]

# Widths of the bounded text columns of the warehouse.
CURRENCY_WIDTH = 10
CONDITION_WIDTH = 100
PRODUCT_ID_WIDTH = 255
BRAND_WIDTH = 255
MERCHANT_WIDTH = 500
STATUS_WIDTH = 50

MONEY = T.DecimalType(12, 2)

PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType(), False),
        T.StructField("product_name", T.StringType(), False),
        T.StructField("brand", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

MERCHANTS = T.StructType(
    [
        T.StructField("merchant_id", T.IntegerType(), False),
        T.StructField("merchant_name", T.StringType(), False),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# A fact is identified by these eight columns; loading one twice adds nothing.
LOAD_KEY = [
    "product_id",
    "merchant_id",
    "observed_at",
    "price",
    "price_min",
    "price_max",
    "currency",
    "condition",
]

PRICE_HISTORY = T.StructType(
    [
        T.StructField("price_id", T.LongType()),
        T.StructField("product_id", T.StringType(), False),
        T.StructField("merchant_id", T.IntegerType(), False),
        T.StructField("price_min", MONEY, False),
        T.StructField("price_max", MONEY, False),
        T.StructField("price", MONEY, False),
        T.StructField("currency", T.StringType()),
        T.StructField("condition", T.StringType()),
        T.StructField("observed_at", T.TimestampType(), False),
        T.StructField("observed_date", T.DateType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("load", T.LongType()),
        T.StructField("observed_year", T.IntegerType()),
        T.StructField("observed_month", T.IntegerType()),
    ]
)

PIPELINE_RUNS = T.StructType(
    [
        T.StructField("run_id", T.LongType(), False),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("records_received", T.LongType()),
        T.StructField("records_validated", T.LongType()),
        T.StructField("records_transformed", T.LongType()),
        T.StructField("records_loaded", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)
