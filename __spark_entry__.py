"""


Every query reads the given tables: the ETL operators run over the raw
test tables, the analytics over the warehouse that the ETL loads from them
(built once per input into the shared folder, see ``tillroll.etl``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import etl
from tillroll import oracle as O
from tillroll.catalog import StarCatalog
from tillroll.operators import constraints
from tillroll.operators import facts as X
from tillroll.operators import keys as K
from tillroll.operators.quality import broken_star, constraint_report
from tillroll.plans import basket, demographics, growth, incremental, rollup, spikes, topn, views
from tillroll.schemas import RAW_TEXT
from tillroll.session import input_fingerprint, shared_path
from tillroll.sources import testdata
from tillroll.sources.masters import keep_first, keep_last, read_customer_master, read_product_master
from tillroll.sources.transactions import read_transactions
from tillroll.streaming import testfeeds

try:
    import tillroll.llm.queries as corpus
except ModuleNotFoundError as e:  # the subpackage is optional
    if not (e.name or "").startswith("tillroll.llm"):
        raise
    corpus = None

SMOKE_DIR = "/root/testdata/sf0.001"
Y = O.YEARS
CUTOVER = "1998-01-01"  # the two-batch loads split the feed at this order date


def _star(spark: SparkSession, sf_dir: str):
    return etl.testdata_star(spark, sf_dir)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: A1 (star join, year filter, aggregate, top-5 window) at sf0.001."""
    return topn.q1_top_products_daytype(_star(spark, SMOKE_DIR), year=Y["q1"])


def _analytic(fn, **kw) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(_star(spark, sf_dir), **kw)


def _dbl(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------------------
# ETL operators over the raw test tables.

def _tx(spark, sf_dir):
    return testdata.transactions(spark, sf_dir)


def _streamed(spark, sf_dir, name, join):
    """The feed as a stream from ``lineitem``, joined by ``join``, drained into Parquet in the shared folder and read back."""
    fp = f"{input_fingerprint(spark, testdata.table_paths(sf_dir))}-{name}-{uuid.uuid4().hex[:8]}"
    out, ckpt = shared_path(spark, "streams", fp, "out"), shared_path(spark, "streams", fp, "checkpoint")
    joined = join(testdata.stream_transactions_from_tables(spark, sf_dir))
    joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
    return _dbl(spark.read.parquet(out), "price")


def stream_product_join(spark, sf_dir):
    return _streamed(spark, sf_dir, "product", lambda tx: X.product_join(tx, testdata.product_master(spark, sf_dir)))


def stream_customer_join(spark, sf_dir):
    pm, cm = testdata.product_master(spark, sf_dir), testdata.customer_master(spark, sf_dir)
    return _streamed(spark, sf_dir, "customer", lambda tx: X.customer_join(X.product_join(tx, pm), cm))


def _holes(pm, cm):
    """Masters that lack some ids by fixed rules, so that lines are set aside."""
    return pm.where("cast(product_id as bigint) % 17 <> 3"), cm.where("cast(customer_id as bigint) % 19 <> 5")


def _holed(spark, sf_dir):
    return X.enrich(_tx(spark, sf_dir), *_holes(testdata.product_master(spark, sf_dir), testdata.customer_master(spark, sf_dir)))


def unmatched_transactions(spark, sf_dir):
    return X.quarantined_rows(_holed(spark, sf_dir)).drop(*RAW_TEXT)


def ingest_metrics(spark, sf_dir):
    return etl.ingest_metrics(_holed(spark, sf_dir))


def _csv(spark, sf_dir, name, df):
    path = shared_path(spark, "csv", f"{input_fingerprint(spark, testdata.table_paths(sf_dir))}-{name}-{uuid.uuid4().hex[:8]}")
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


def csv_masters(spark, sf_dir):
    """S1 from CSV files with other column order, a column of their own and quoted names."""
    m = testdata.product_master(spark, sf_dir)
    raw = m.select(
        F.concat("store_name", F.lit(' "quoted", one')).alias("storeName"), F.lit("x").alias("own"), F.col("price").alias("price$"),
        F.col("supplier_id").alias("supplierID"), F.col("product_id").alias("Product_ID"), F.col("store_id").alias("storeID"),
        F.col("supplier_name").alias("supplierName"), F.col("product_category").alias("Product_Category"),
    )
    return _dbl(read_product_master(spark, _csv(spark, sf_dir, "products", raw)), "price")


def csv_transactions(spark, sf_dir):
    """S3 (batch) from CSV files with a leading index column and other column order."""
    raw = _tx(spark, sf_dir).select(
        F.monotonically_increasing_id().alias("index"), "date", F.col("product_id").alias("Product_ID"), "quantity",
        F.col("order_id").alias("orderID"), F.col("customer_id").alias("Customer_ID"),
    )
    return read_transactions(spark, _csv(spark, sf_dir, "transactions", raw)).drop(*RAW_TEXT)


def _natural(star):
    """Fact rows in natural keys: surrogates depend on how the feed was cut into batches."""
    return (
        star.sales_fact.join(K.by_rows(star.customer_dim.select("customer_sk", "customer_id")), "customer_sk")
        .join(K.by_rows(star.product_dim.select("product_sk", "product_id", "store_id", "supplier_id")), "product_sk")
        .join(star.date_dim.select("date_sk", "date"), "date_sk")
    )


def redo_last_batch(spark, sf_dir):
    """The second of two batches run again with fewer lines leaves nothing of its first run."""
    star = etl.testdata_redone_warehouse(spark, sf_dir, CUTOVER).star()
    return _natural(star).select("order_id", "customer_id", "product_id", "quantity", "date")


def stream_dedup(spark, sf_dir):
    """E15 on a stream: the feed arrives twice, with malformed copies first, and every line loads once."""
    star = testfeeds.reread_dedup_warehouse(spark, sf_dir).star()
    return _natural(star).select("order_id", "product_id", "quantity", "date")


def stream_dedup_state(spark, sf_dir):
    """E15 with Spark's state store: what was loaded and what was set aside as late, line by line, and how many lines were repeats."""
    wh = testfeeds.state_dedup_warehouse(spark, sf_dir)
    line = ["order_id", "product_id", "quantity", "date"]
    by = lambda df, outcome: df.groupBy(*line).agg(F.count("*").alias("n_lines")).withColumn("outcome", F.lit(outcome))
    counted = spark.read.parquet(f"{wh.root}/_counts").agg(F.sum("repeated").alias("n_lines"))
    empty = counted.select(*[F.lit(None).cast(t).alias(c) for c, t in zip(line, ("string", "string", "int", "date"))], "n_lines", F.lit("repeated").alias("outcome"))
    return by(_natural(wh.star()), "loaded").unionByName(by(wh.read("quarantine"), "late")).unionByName(empty)


def ingest_progress(spark, sf_dir):
    """E14 live: what the listener heard of each micro-batch."""
    wh = testfeeds.progress_warehouse(spark, sf_dir, _holes)
    return spark.read.parquet(f"{wh.root}/_progress").select("batch_id", "input_rows", "matched_rows", "quarantined_rows")


def csv_stream_fact(spark, sf_dir):
    """S3 to S5 from CSV files with headers of their own: loaded lines and, with their text, those set aside."""
    wh = testfeeds.csv_stream_warehouse(spark, sf_dir)
    loaded = _natural(wh.star()).select(
        "order_id", "customer_id", "product_id", F.col("quantity").cast("string").alias("quantity"), F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.lit("loaded").alias("reason"), "total_price",
    )
    aside = wh.read("quarantine").select(
        "order_id", "customer_id", "product_id", F.col("raw_quantity").alias("quantity"), F.col("raw_date").alias("date"), "reason",
        F.lit(None).cast("decimal(10,2)").alias("total_price"),
    )
    return _dbl(loaded.unionByName(aside), "total_price")


def csv_customers(spark, sf_dir):
    """S2 and D2 from two CSV files in different column orders: the second repeats every third customer with other attributes."""
    cm = testdata.customer_master(spark, sf_dir)
    names = ["Customer_ID", "Gender", "Age", "Occupation", "City_Category", "Stay_In_Current_City_Years", "Marital_Status"]
    first = cm.toDF(*names).withColumn("Marital_Status", F.col("Marital_Status").cast("string"))
    again = testfeeds.changed_customers(cm.where("cast(customer_id as bigint) % 3 = 0")).toDF(*names)
    again = again.withColumn("Marital_Status", F.col("Marital_Status").cast("string")).select("Occupation", "Marital_Status", "Customer_ID", "Age", "Gender", "City_Category", "Stay_In_Current_City_Years")
    folder = shared_path(spark, "csv", f"{input_fingerprint(spark, testdata.table_paths(sf_dir))}-customers-{uuid.uuid4().hex[:8]}")
    for k, df in enumerate((first, again)):
        df.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{folder}/{k}")
    return read_customer_master(spark, [f"{folder}/0", f"{folder}/1"])


def _long(dims) -> DataFrame:
    """(dimension, id, batch_id, attribute, value) of dimension tables, one row an attribute."""
    out = None
    for name, df, key in dims:
        attrs = [c for c in df.columns if c not in (key, "batch_id")]
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value")) for c in attrs])).alias("a")
        part = df.select(F.lit(name).alias("dimension"), F.col(key).cast("string").alias("id"), "batch_id", each).select("dimension", "id", "batch_id", "a.*")
        out = part if out is None else out.unionByName(part)
    return out


def dim_first_write_attrs(spark, sf_dir):
    """D1 on masters that change between micro-batches: every attribute as its first batch wrote it."""
    star = testfeeds.changing_masters_warehouse(spark, sf_dir, CUTOVER).star()
    return _long([("customer", star.customer_dim.drop("customer_sk"), "customer_id"), ("product", star.product_dim.drop("product_sk"), "product_id")])


def dim_name_conflict(spark, sf_dir):
    """D4 on the second version of the masters, in which a store and a supplier have several names."""
    star = testfeeds.changing_masters_warehouse(spark, sf_dir, CUTOVER).star()
    return _long([("store", star.store_dim, "store_id"), ("supplier", star.supplier_dim, "supplier_id")])


def _dim(table: str, money_cols: tuple[str, ...] = ()):
    def run(spark, sf_dir):
        return _dbl(getattr(_star(spark, sf_dir), table).drop("batch_id"), *money_cols)
    return run


def sales_fact(spark, sf_dir):
    f = _star(spark, sf_dir).sales_fact
    return _dbl(
        f.select("order_id", "customer_sk", "product_sk", "store_sk", "supplier_sk", "date_sk", "quantity", "total_price"),
        "total_price",
    )


def fact_key_lookup(spark, sf_dir):
    star = _star(spark, sf_dir)
    tx = _tx(spark, sf_dir)
    out = K.lookup_keys(tx, star.customer_dim, "customer_id", "customer_sk")
    out = K.lookup_keys(out, star.product_dim, "product_id", "product_sk")
    out = K.lookup_keys(out, star.date_dim, "date", "date_sk")
    return out.select("order_id", "customer_id", "customer_sk", "product_id", "product_sk", "date", "date_sk")


def surrogate_keys(spark, sf_dir):
    """E10 on every distinct order id."""
    orders = _tx(spark, sf_dir).select("order_id").distinct()
    return K.dense_keys(orders, ["order_id"], "order_sk")


def dedup_orders(spark, sf_dir):
    tx = testdata.transactions(spark, sf_dir, with_position=True)
    return keep_first(tx, ["order_id", "product_id"], "_pos")


def dim_last_in_batch(spark, sf_dir):
    tx = testdata.transactions(spark, sf_dir, with_position=True)
    return keep_last(tx, ["order_id", "product_id"], "_pos")




def dim_first_write_wins(spark, sf_dir):
    wh = etl.testdata_two_batch_warehouse(spark, sf_dir, CUTOVER)
    return wh.read("product_dim").select("product_id", "product_sk", "batch_id")


def stream_ingest_fact(spark, sf_dir):
    """S3-S5, E1, E2, E12, E13 end to end: the fact loaded by the streaming
    pipeline, six files in six micro-batches, with a stop and restart between."""
    star = testfeeds.stream_warehouse(spark, sf_dir).star()
    out = _natural(star).select("order_id", "customer_id", "product_id", "store_id", "supplier_id", "date", "quantity", "total_price")
    return _dbl(out, "total_price")


def catalog_round_trip(spark, sf_dir):
    """Tables and views created in the catalog, read by SQL with one year pruned, and dropped again."""
    catalog = StarCatalog(etl.testdata_two_batch_warehouse(spark, sf_dir, CUTOVER), f"star_{uuid.uuid4().hex[:12]}")
    catalog.create()
    catalog.analyze()
    out = shared_path(spark, "catalog", catalog.db)
    catalog.sql("SELECT * FROM STORE_QUARTERLY_SALES WHERE year >= 1998").write.parquet(out)
    catalog.drop()
    if spark.catalog.databaseExists(catalog.db):
        raise RuntimeError(f"{catalog.db} is still there")
    return spark.read.parquet(out)


def _bucketed_star(spark, sf_dir):
    wh = etl.testdata_warehouse(spark, sf_dir)
    return StarCatalog(wh, f"bucketed_{wh.root.rsplit('/', 1)[-1].replace('-', '_')}").bucketed_star(buckets=8)


def q20_incremental(spark, sf_dir):
    """A20 as its maintained sums give it, after each of the two loads."""
    wh = etl.testdata_incremental_warehouse(spark, sf_dir, CUTOVER)
    after = [incremental.q20_incremental(wh, upto_batch=b).withColumn("after_batch", F.lit(b)) for b in (0, 1)]
    return after[0].unionByName(after[1])


def constraint_on_load(spark, sf_dir):
    """D5 on write: a third batch on offer that repeats stored sales and customers and refers to keys that nobody has.

    Its facts are the stored ones of orders divisible by 50, under their own
    sale_id where the order is divisible by 100 and under new ones elsewhere;
    odd products among them and dates of 25 pieces or more are unknown.
    """
    wh = etl.testdata_incremental_warehouse(spark, sf_dir, CUTOVER)
    star = wh.star()
    order = F.col("order_id").cast("bigint")
    fact = star.sales_fact.where(order % 50 == 0)
    fact = (
        fact.withColumn("sale_id", F.when(order % 100 == 0, F.col("sale_id")).otherwise(-F.col("sale_id") - 1))
        .withColumn("product_sk", F.when(F.col("product_sk") % 2 == 1, -F.col("product_sk")).otherwise(F.col("product_sk")))
        .withColumn("date_sk", F.when(F.col("quantity") >= 25, F.col("date_sk") + 1_000_000).otherwise(F.col("date_sk")))
    )
    customers = star.customer_dim.where("customer_sk % 9 = 0")
    return constraints.check_load(wh, {"sales_fact": fact, "customer_dim": customers.unionByName(customers.withColumn("customer_sk", -F.col("customer_sk")))}, 2)


def constraint_check(spark, sf_dir):
    return constraint_report(_star(spark, sf_dir))


def constraint_check_broken(spark, sf_dir):
    return constraint_report(broken_star(_star(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # ETL operators
        "stream_product_join": stream_product_join,
        "stream_customer_join": stream_customer_join,
        "unmatched_transactions": unmatched_transactions,
        "ingest_metrics": ingest_metrics,
        "dim_customer": _dim("customer_dim"),
        "dim_product": _dim("product_dim", ("price",)),
        "dim_store": _dim("store_dim"),
        "dim_supplier": _dim("supplier_dim"),
        "dim_date": _dim("date_dim"),
        "fact_key_lookup": fact_key_lookup,
        "surrogate_keys": surrogate_keys,
        "sales_fact": sales_fact,
        "dedup_orders": dedup_orders,
        "dim_last_in_batch": dim_last_in_batch,
        "dim_first_write_wins": dim_first_write_wins,
        "constraint_check": constraint_check,
        "constraint_check_broken": constraint_check_broken,
        "constraint_on_load": constraint_on_load,
        "csv_masters": csv_masters,
        "csv_transactions": csv_transactions,
        "redo_last_batch": redo_last_batch,
        "stream_dedup": stream_dedup,
        "stream_dedup_state": stream_dedup_state,
        "ingest_progress": ingest_progress,
        "csv_stream_fact": csv_stream_fact,
        "csv_customers": csv_customers,
        "dim_first_write_attrs": dim_first_write_attrs,
        "dim_name_conflict": dim_name_conflict,
        "stream_ingest_fact": stream_ingest_fact,
        # Analytics
        "fact_row_count": _analytic(views.fact_row_count),
        "available_years": _analytic(views.available_years),
        "q1_top_products_daytype": _analytic(topn.q1_top_products_daytype, year=Y["q1"]),
        "q2_demographics": _analytic(demographics.q2_demographics),
        "q3_category_occupation": _analytic(demographics.q3_category_occupation),
        "q4_gender_age_quarter": _analytic(demographics.q4_gender_age_quarter, year=Y["q4"]),
        "q5_top_occupations": _analytic(topn.q5_top_occupations),
        "q5_top_occupations_n2": _analytic(topn.q5_top_occupations, n=2),
        "q6_city_marital_recent": _analytic(demographics.q6_city_marital_recent),
        "q7_avg_purchase": _analytic(demographics.q7_avg_purchase),
        "q8_top_cities": _analytic(topn.q8_top_cities),
        "q8_top_cities_n2": _analytic(topn.q8_top_cities, n=2),
        "q9_mom_growth": _analytic(growth.q9_mom_growth, year=Y["q9"]),
        "q10_age_daytype": _analytic(demographics.q10_age_daytype, year=Y["q10"]),
        "q11_top_products_category": _analytic(topn.q11_top_products_category, year=Y["q11"]),
        "q12_store_growth": _analytic(growth.q12_store_growth, year=Y["q12"]),
        "q13_store_supplier_product": _analytic(rollup.q13_store_supplier_product),
        "q14_seasonal": _analytic(rollup.q14_seasonal),
        "q15_volatility": _analytic(growth.q15_volatility),
        "q16_basket_pairs": _analytic(basket.q16_basket_pairs),
        "q17_rollup": _analytic(rollup.q17_rollup),
        "q18_half_year": _analytic(rollup.q18_half_year),
        "q19_spikes": _analytic(spikes.q19_spikes),
        "q19_spike_flags": _analytic(spikes.q19_spike_flags),
        "q20_store_quarterly_view": _analytic(views.q20_store_quarterly_view),
        "q20_incremental": q20_incremental,
        "catalog_round_trip": catalog_round_trip,
        "q2_bucketed": lambda spark, sf_dir: demographics.q2_demographics(_bucketed_star(spark, sf_dir)),
        "q7_bucketed": lambda spark, sf_dir: demographics.q7_avg_purchase(_bucketed_star(spark, sf_dir)),
        **(corpus.QUERIES if corpus else {}),
    }


def oracle_sql() -> dict[str, str]:
    return {**O.etl_operators(cutover=CUTOVER), **O.analytics(), **(corpus.ORACLE if corpus else {})}
