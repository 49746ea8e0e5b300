"""Warehouse storage (S5-S9): Parquet tables partitioned by batch.

A batch writes its own partition of every table with a plain Spark overwrite,
so a run that is repeated replaces all of the earlier one.  ``loads`` is a table
like the others, with one row per batch: what a batch wrote is read once its row
says that it is done, in all tables at once.  A batch that is run again is taken
out of ``loads`` first and put back at the end.  One writer at a time is assumed.

Batches that are done and follow one another are one range, so a read is a scan
with a few ranges of the partition column however many batches there are.
``loads`` also keeps the largest keys that a batch gave out, which is all that
later batches need to know to give out theirs.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.schemas import LOADS, TABLE_PARTITIONS, TABLE_SCHEMAS
from tillroll.session import fs_delete, fs_exists, fs_mkdirs, shared_path

TABLES = tuple(TABLE_SCHEMAS)


@dataclass
class Star:
    """The six star tables as DataFrames (partition columns included)."""

    customer_dim: DataFrame
    product_dim: DataFrame
    store_dim: DataFrame
    supplier_dim: DataFrame
    date_dim: DataFrame
    sales_fact: DataFrame

    def register(self, suffix: str = "") -> list[str]:
        """Expose the tables as temp views, e.g. ``suffix="_v2"`` for the
        table names the reference's SQL uses.  Partition columns are left out
        so ``SELECT *`` shows the reference's columns."""
        names = []
        for name in ("customer_dim", "product_dim", "store_dim", "supplier_dim", "date_dim", "sales_fact"):
            df = getattr(self, name)
            keep = [c for c in df.columns if c not in ("batch_id", "sale_year")]
            df.select(*keep).createOrReplaceTempView(name + suffix)
            names.append(name + suffix)
        return names


@dataclass
class Done:
    """Batches that can be read, as ranges with both ends, and the largest keys of the last one."""

    ranges: list[tuple[int, int]]
    max_keys: dict[str, int]

    def holds(self, batch_id: Column) -> Column:
        return reduce(lambda a, b: a | b, [batch_id.between(lo, hi) for lo, hi in self.ranges], F.lit(False))


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @classmethod
    def in_shared_dir(cls, spark: SparkSession, *parts: str) -> "Warehouse":
        return cls(spark, shared_path(spark, "tillroll-warehouse", *parts))

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        return fs_exists(self.spark, self.path(table))

    # -- loads -----------------------------------------------------------

    def loads(self) -> DataFrame:
        """One row per batch that is done, or is the last one and being run again."""
        if not self.exists("loads"):
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in LOADS.fields])
        return self.spark.read.schema(LOADS).parquet(self.path("loads")).select(*LOADS.names)

    def _note(self, batch_id: int, done: bool, max_keys: dict[str, int]) -> None:
        keys = F.from_json(F.lit(json.dumps(max_keys)), LOADS["max_keys"].dataType).alias("max_keys")
        row = self.spark.range(0, 1, numPartitions=1).select(F.lit(done).alias("done"), keys)
        row.write.mode("overwrite").parquet(f"{self.path('loads')}/batch_id={batch_id}")

    def done(self, before_batch: int | None = None) -> Done:
        """The batches that are done, of all or of the earlier ones: what a reader may see now."""
        if not self.exists("loads"):
            return Done([], {})
        own = self.loads().where("done" if before_batch is None else F.col("done") & (F.col("batch_id") < F.lit(before_batch)))
        place = F.row_number().over(Window.orderBy("batch_id"))  # of 2**20 batches at most
        ranges = own.withColumn("_run", F.col("batch_id") - place).groupBy("_run").agg(
            F.min("batch_id").alias("first"), F.max("batch_id").alias("last"), F.max_by("max_keys", "batch_id").alias("keys")
        )
        rows = sorted(ranges.collect(), key=lambda r: r["first"])  # one row more than batches that failed and were passed over
        return Done([(r["first"], r["last"]) for r in rows], rows[-1]["keys"] if rows else {})

    def last_batch(self) -> int:
        """The latest batch, -1 without any."""
        return self.loads().agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0] if self.exists("loads") else -1

    def begin(self, batch_id: int) -> bool:
        """Opens a batch; whether it is the last one again, which is not read until it is done anew."""
        last = self.last_batch()
        if batch_id < last:
            raise ValueError(
                f"batch {batch_id} is older than the last batch {last}: batches load in increasing order, "
                "and only the latest may be run again"
            )
        if batch_id == last:
            self._note(batch_id, False, {})
        return batch_id == last

    def commit(self, batch_id: int, max_keys: dict[str, int]) -> None:
        """Makes what a batch wrote readable, in all tables at once."""
        self._note(batch_id, True, max_keys)

    def committed_batches(self) -> list[int]:
        return sorted(r.batch_id for r in self.loads().where("done").select("batch_id").collect())

    # -- tables ----------------------------------------------------------

    def _stored(self, table: str) -> DataFrame:
        schema = TABLE_SCHEMAS[table]
        if not self.exists(table):
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
        return self.spark.read.schema(schema).parquet(self.path(table)).select(*schema.names)

    def read(self, table: str, before_batch: int | None = None, upto_batch: int | None = None, done: Done | None = None) -> DataFrame:
        """Rows of the batches that are done, of all or of the earlier ones."""
        if done is None:
            done = self.done(before_batch if upto_batch is None else upto_batch + 1)
        return self._stored(table).where(done.holds(F.col("batch_id")))

    def read_batch(self, table: str, batch_id: int) -> DataFrame:
        """What one batch has written so far, done or not; the other partitions are not read."""
        return self._stored(table).where(F.col("batch_id") == F.lit(batch_id))

    def write(self, table: str, df: DataFrame, batch_id: int) -> None:
        """Makes ``df`` the batch's part of the table; nobody sees it before the batch is done."""
        fields = [f for f in TABLE_SCHEMAS[table].fields if f.name != "batch_id"]
        out = df.select(*[F.col(f.name).cast(f.dataType) for f in fields])
        inner = [c for c in TABLE_PARTITIONS[table] if c != "batch_id"]
        out.write.mode("overwrite").parquet(f"{self.path(table)}/batch_id={batch_id}", partitionBy=inner or None)

    def create(self) -> None:
        """Create every table empty if absent."""
        for table in ("loads", *TABLES):
            fs_mkdirs(self.spark, self.path(table))

    def drop_all(self) -> None:
        """DROP TABLE IF EXISTS for every table, what refers to others first."""
        for table in ("loads", *reversed(TABLES)):
            self.drop(table)

    def drop(self, table: str) -> None:
        """DROP TABLE IF EXISTS."""
        fs_delete(self.spark, self.path(table))

    def star(self, upto_batch: int | None = None) -> Star:
        done = self.done(None if upto_batch is None else upto_batch + 1)  # the same batches in all tables
        r = lambda t: self.read(t, done=done)
        return Star(r("customer_dim"), r("product_dim"), r("store_dim"), r("supplier_dim"), r("date_dim"), r("sales_fact"))
