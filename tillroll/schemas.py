"""Declared schemas: raw inputs, normalised inputs and the star tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the three input files (customer master,
# product master, transactions), exactly as they appear in the CSV headers.
RAW_CUSTOMER_COLUMNS = [
    "Customer_ID", "Gender", "Age", "Occupation", "City_Category",
    "Stay_In_Current_City_Years", "Marital_Status",
]
RAW_PRODUCT_COLUMNS = [
    "Product_ID", "Product_Category", "price$", "storeID", "supplierID",
    "storeName", "supplierName",
]
RAW_TRANSACTION_COLUMNS = ["orderID", "Customer_ID", "Product_ID", "quantity", "date"]


def _all_strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


RAW_CUSTOMER = _all_strings(RAW_CUSTOMER_COLUMNS)
RAW_PRODUCT = _all_strings(RAW_PRODUCT_COLUMNS)
RAW_TRANSACTIONS = _all_strings(RAW_TRANSACTION_COLUMNS)

MONEY = T.DecimalType(10, 2)
KEY = T.LongType()

# Normalised inputs (what the ETL operators consume).
CUSTOMER_MASTER = T.StructType([
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
    T.StructField("age_group", T.StringType(), True),
    T.StructField("occupation", T.StringType(), True),
    T.StructField("city_category", T.StringType(), True),
    T.StructField("stay_in_current_city_years", T.StringType(), True),
    T.StructField("marital_status", T.IntegerType(), True),
])
PRODUCT_MASTER = T.StructType([
    T.StructField("product_id", T.StringType(), True),
    T.StructField("product_category", T.StringType(), True),
    T.StructField("price", MONEY, True),
    T.StructField("store_id", T.StringType(), True),
    T.StructField("supplier_id", T.StringType(), True),
    T.StructField("store_name", T.StringType(), True),
    T.StructField("supplier_name", T.StringType(), True),
])
TRANSACTIONS = T.StructType([
    T.StructField("order_id", T.StringType(), True),
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("product_id", T.StringType(), True),
    T.StructField("quantity", T.IntegerType(), True),
    T.StructField("date", T.DateType(), True),
])

CUSTOMER_ATTRS = [f.name for f in CUSTOMER_MASTER.fields]
PRODUCT_ATTRS = [f.name for f in PRODUCT_MASTER.fields]
TRANSACTION_COLS = [f.name for f in TRANSACTIONS.fields]

BATCH = T.StructField("batch_id", T.LongType(), False)


def _with_key(sk: str, body: list[T.StructField]) -> T.StructType:
    return T.StructType([T.StructField(sk, KEY, False), *body, BATCH])


CUSTOMER_DIM = _with_key("customer_sk", list(CUSTOMER_MASTER.fields))
PRODUCT_DIM = _with_key("product_sk", list(PRODUCT_MASTER.fields))
STORE_DIM = _with_key("store_sk", [
    T.StructField("store_id", T.StringType(), True),
    T.StructField("store_name", T.StringType(), True),
])
SUPPLIER_DIM = _with_key("supplier_sk", [
    T.StructField("supplier_id", T.StringType(), True),
    T.StructField("supplier_name", T.StringType(), True),
])
DATE_DIM = _with_key("date_sk", [
    T.StructField("date", T.DateType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
    T.StructField("day", T.IntegerType(), True),
])

# The fact keeps the reference's columns; ``sale_year`` partitions it inside a
# batch, so that a year's query reads that year's folders only.
SALES_FACT = T.StructType([
    T.StructField("sale_id", KEY, False),
    T.StructField("order_id", T.StringType(), True),
    T.StructField("customer_sk", KEY, True),
    T.StructField("product_sk", KEY, True),
    T.StructField("store_sk", KEY, True),
    T.StructField("supplier_sk", KEY, True),
    T.StructField("date_sk", KEY, True),
    T.StructField("quantity", T.IntegerType(), True),
    T.StructField("total_price", MONEY, True),
    BATCH,
    T.StructField("sale_year", T.IntegerType(), True),
])

# What a line held before parsing, kept for the rows set aside.
RAW_TEXT = ["raw_quantity", "raw_date"]

QUARANTINE = T.StructType([
    *TRANSACTIONS.fields,
    *[T.StructField(c, T.StringType(), True) for c in RAW_TEXT],
    T.StructField("reason", T.StringType(), False),
    BATCH,
])

# What is kept per batch of the store quarter view (plans.incremental).
_STORE_QUARTER = [T.StructField("store_sk", KEY, True), T.StructField("quarter", T.IntegerType(), True)]
STORE_QUARTER_SUMS = T.StructType([
    *_STORE_QUARTER,
    T.StructField("revenue", T.DecimalType(38, 2), True),
    T.StructField("quantity", KEY, True),
    T.StructField("n_lines", KEY, True),
    T.StructField("new_customers", KEY, True),
    BATCH,
    T.StructField("year", T.IntegerType(), True),
])
STORE_QUARTER_CUSTOMERS = T.StructType([
    *_STORE_QUARTER,
    T.StructField("customer_sk", KEY, True),
    BATCH,
    T.StructField("year", T.IntegerType(), True),
])

# Bloom filters of a batch's keys (operators.constraints): words of 2**words words.
KEY_FILTERS = T.StructType([
    T.StructField("kind", T.StringType(), True),
    T.StructField("words", T.IntegerType(), True),
    T.StructField("slot", KEY, True),
    T.StructField("bits", KEY, True),
    BATCH,
])

# Table name -> (schema, natural key, surrogate key, partition columns).
DIMENSIONS = {
    "customer_dim": (CUSTOMER_DIM, "customer_id", "customer_sk"),
    "product_dim": (PRODUCT_DIM, "product_id", "product_sk"),
    "store_dim": (STORE_DIM, "store_id", "store_sk"),
    "supplier_dim": (SUPPLIER_DIM, "supplier_id", "supplier_sk"),
    "date_dim": (DATE_DIM, "date", "date_sk"),
}
TABLE_SCHEMAS = {
    **{name: spec[0] for name, spec in DIMENSIONS.items()},
    "sales_fact": SALES_FACT,
    "quarantine": QUARANTINE,
    "store_quarter_sums": STORE_QUARTER_SUMS,
    "store_quarter_customers": STORE_QUARTER_CUSTOMERS,
    "key_filters": KEY_FILTERS,
}
# Every table is partitioned by the batch that wrote it.
TABLE_PARTITIONS = {
    **{name: ["batch_id"] for name in DIMENSIONS},
    "sales_fact": ["batch_id", "sale_year"],
    "quarantine": ["batch_id"],
    "store_quarter_sums": ["batch_id"],
    "store_quarter_customers": ["batch_id", "year"],
    "key_filters": ["batch_id"],
}

# One row per batch: whether it is done and the largest keys it gave out.
LOADS = T.StructType([
    T.StructField("done", T.BooleanType(), True),
    T.StructField("max_keys", T.MapType(T.StringType(), T.LongType()), True),
    T.StructField("batch_id", T.LongType(), True),
])
