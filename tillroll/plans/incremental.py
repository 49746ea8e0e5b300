"""A20 kept up to date batch by batch.

``maintain`` runs before a batch is committed and reads only what the batch
wrote, besides the customer sets of the batch's own years.  It writes two more
partitions: sums per store and quarter, which add up, and the customers that a
store sees for the first time in a quarter.  Each of those is counted in the
batch that brings it, so the distinct count is a sum as well, and exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.exprs import mean
from tillroll.plans.common import money
from tillroll.warehouse import Warehouse

KEY = ["store_sk", "year", "quarter"]


def maintain(wh: Warehouse, batch_id: int) -> None:
    done = wh.done(before_batch=batch_id)
    dates = wh.read("date_dim", done=done).unionByName(wh.read_batch("date_dim", batch_id))
    dates = dates.where(F.col("date").isNotNull()).select("date_sk", "year", F.quarter("date").cast("int").alias("quarter"))
    lines = wh.read_batch("sales_fact", batch_id).select("store_sk", "date_sk", "customer_sk", "total_price", "quantity").join(dates, "date_sk")
    seen = lines.select(*KEY, "customer_sk").distinct()
    # null keys are a store (a customer) like any other: eqNullSafe, as GROUP BY has it
    stored = wh.read("store_quarter_customers", done=done)
    same = [seen[c].eqNullSafe(stored[c]) for c in KEY[:1]] + [seen[c] == stored[c] for c in [*KEY[1:], "customer_sk"]]
    new = seen.join(stored, same, "left_anti").select(*KEY, "customer_sk")
    wh.write("store_quarter_customers", new, batch_id)
    first = wh.read_batch("store_quarter_customers", batch_id).groupBy(*KEY).agg(F.count(F.lit(1)).alias("new_customers"))
    sums = lines.groupBy(*KEY).agg(  # of lines, not of customers: tasks add up a store's quarter before anything moves
        F.sum("total_price").alias("revenue"), F.sum("quantity").cast("bigint").alias("quantity"), F.count(F.lit(1)).alias("n_lines")
    )
    on = [sums["store_sk"].eqNullSafe(first["store_sk"]), sums["year"] == first["year"], sums["quarter"] == first["quarter"]]
    both = sums.join(first, on, "left").select(*[sums[c] for c in sums.columns], F.coalesce("new_customers", F.lit(0)).cast("bigint").alias("new_customers"))
    wh.write("store_quarter_sums", both, batch_id)


def q20_incremental(wh: Warehouse, upto_batch: int | None = None) -> DataFrame:
    """A20 from the sums of the batches that are done; no fact row is read."""
    done = wh.done(None if upto_batch is None else upto_batch + 1)
    sums = wh.read("store_quarter_sums", done=done).groupBy(*KEY).agg(
        F.sum("revenue").alias("_rev"), F.sum("quantity").alias("quarterly_quantity"),
        F.sum("n_lines").alias("transaction_count"), F.sum("new_customers").alias("unique_customers"),
    )
    stores = wh.read("store_dim", done=done).where(F.col("store_id").isNotNull()).select("store_sk", "store_id", "store_name")
    return sums.join(stores, "store_sk").select(
        "store_sk", "store_id", "store_name", "year", "quarter", money("_rev", "quarterly_revenue"), "quarterly_quantity", "transaction_count",
        mean("_rev", "transaction_count").alias("avg_transaction_value"), "unique_customers",
    )
