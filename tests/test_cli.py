"""The command line, on CSV files in the reference's input layout."""

from __future__ import annotations

from conftest import SF_SMALL
from pyspark.sql import functions as F

from tillroll import cli
from tillroll.sources import testdata


def _write_inputs(spark, root: str) -> None:
    pm = testdata.product_master(spark, SF_SMALL)
    pm.select(
        F.col("product_id").alias("Product_ID"), F.col("product_category").alias("Product_Category"),
        F.col("price").cast("string").alias("price$"), F.col("store_id").alias("storeID"),
        F.col("supplier_id").alias("supplierID"), F.col("store_name").alias("storeName"),
        F.col("supplier_name").alias("supplierName"),
    ).coalesce(1).write.option("header", True).csv(f"{root}/products")
    cm = testdata.customer_master(spark, SF_SMALL)
    cm.select(
        F.col("customer_id").alias("Customer_ID"), F.col("gender").alias("Gender"), F.col("age_group").alias("Age"),
        F.col("occupation").alias("Occupation"), F.col("city_category").alias("City_Category"),
        F.col("stay_in_current_city_years").alias("Stay_In_Current_City_Years"),
        F.col("marital_status").cast("string").alias("Marital_Status"),
    ).coalesce(1).write.option("header", True).csv(f"{root}/customers")
    tx = testdata.transactions(spark, SF_SMALL)
    tx.select(
        F.col("order_id").alias("orderID"), F.col("customer_id").alias("Customer_ID"),
        F.col("product_id").alias("Product_ID"), F.col("quantity").cast("string").alias("quantity"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
    ).repartition(3).write.option("header", True).csv(f"{root}/tx")


def test_load_query_sql(spark, tmp_path, capsys):
    root = str(tmp_path)
    _write_inputs(spark, root)
    wh = f"{root}/wh"
    cli.main(["load", "--warehouse", wh, "--products", f"{root}/products", "--customers", f"{root}/customers",
              "--transactions", f"{root}/tx"])
    n = testdata.transactions(spark, SF_SMALL).count()
    assert f"loaded {n}, set aside 0" in capsys.readouterr().out

    cli.main(["query", "--warehouse", wh, "q1_top_products_daytype", "--param", "year=1997", "--out", f"{root}/q1"])
    assert spark.read.parquet(f"{root}/q1").count() > 0

    cli.main(["sql", "--warehouse", wh, "--suffix", "_v2", "--out", f"{root}/s",
              "SELECT COUNT(*) AS total_records FROM sales_fact_v2"])
    assert spark.read.parquet(f"{root}/s").first().total_records == n

    cli.main(["sql", "--warehouse", wh, "--out", f"{root}/v",
              "SELECT * FROM STORE_QUARTERLY_SALES ORDER BY store_name, year DESC, quarter DESC"])
    assert spark.read.parquet(f"{root}/v").count() > 0
