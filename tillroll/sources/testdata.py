"""Mapping of the TPC-H-like test tables onto the warehouse inputs.

The test tables have no retail masters, so the customer and product masters
and the transaction feed are derived from ``customer / nation / region``,
``part / supplier`` and ``lineitem / orders``.  Attributes the tables lack are
derived by fixed rules, with NULLs on purpose so the COALESCE branches run.
The same expressions appear in the DuckDB oracle (``tillroll.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import CUSTOMER_ATTRS, MONEY, PRODUCT_ATTRS, TRANSACTION_COLS

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# Fixed values of the mapping (shared with the oracle SQL).
STORE_NAME_PREFIX = "Store "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_paths(sf_dir: str) -> list[str]:
    return [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in TABLES]


def customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = F.col("c_custkey")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    return (
        c.join(geo, c.c_nationkey == geo.n_nationkey)
        .select(
            k.cast("string").alias("customer_id"),
            F.when(k % 11 == 0, F.lit(None).cast("string"))
            .when(k % 2 == 0, "F").otherwise("M").alias("gender"),
            F.when(k % 13 == 0, F.lit(None).cast("string"))
            .when((k % 7).isin(0, 1), "18-25")
            .when((k % 7).isin(2, 3, 4), "26-35")
            .otherwise("36+").alias("age_group"),
            F.col("c_mktsegment").alias("occupation"),
            F.col("r_name").alias("city_category"),
            F.when(k % 5 == 4, "4+").otherwise((k % 5).cast("string")).alias("stay_in_current_city_years"),
            F.when(k % 3 == 0, 1).otherwise(0).cast("int").alias("marital_status"),
        )
        .select(*CUSTOMER_ATTRS)
    )


def product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product's supplier is its key modulo the number of suppliers, whose keys are 0, 1, 2, ..."""
    p = table(spark, sf_dir, "part")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return (
        p.join(s, s.s_suppkey == p.p_partkey % F.lit(s.count()))
        .select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_type").alias("product_category"),
            F.col("p_retailprice").cast(MONEY).alias("price"),
            F.col("p_brand").alias("store_id"),
            F.col("s_suppkey").cast("string").alias("supplier_id"),
            F.concat(F.lit(STORE_NAME_PREFIX), F.col("p_brand")).alias("store_name"),
            F.col("s_name").alias("supplier_name"),
        )
        .select(*PRODUCT_ATTRS)
    )


def transactions(spark: SparkSession, sf_dir: str, with_position: bool = False) -> DataFrame:
    """One transaction per lineitem row.

    The ingest position is (order key, line number, quantity): line numbers
    repeat inside an order in this data, and rows equal on all three are
    identical in every output column, so ties cannot change a result.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    out = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.struct(
            F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("l"), F.col("l_quantity").cast("int").alias("q")
        ).alias("_pos"),
    )
    return out if with_position else out.select(*TRANSACTION_COLS)


def stream_transactions_from_tables(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    """The transaction feed as a stream: ``lineitem.parquet`` streamed out of
    the shared test folder (``pathGlobFilter``), joined to ``orders`` as the
    static side of a stream-static join."""
    path = sf_dir.rstrip("/")
    schema = table(spark, sf_dir, "lineitem").schema
    li = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "lineitem.parquet")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(path)
        .select("l_orderkey", "l_partkey", "l_quantity")
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("o_orderdate").cast("date").alias("date"),
    )
