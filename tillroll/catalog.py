"""A warehouse's tables and its view in the session catalog.

The catalog holds, for one database: an external table over the files of each
warehouse table (``<name>_files``, partitioned as they are), a view of each with
the reference's columns and the rows of batches that are done, and the store
quarter view on top of those.  With a catalog kept in a metastore they outlast
the session; dropping them leaves the files to ``Warehouse.drop_all``.

``bucketed_star`` adds copies of the fact and the customers that are bucketed by
customer: the customer breakdowns then join and aggregate without moving the
fact, however large the customer dimension is.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.plans.views import STORE_QUARTERLY_SALES
from tillroll.schemas import LOADS, TABLE_PARTITIONS, TABLE_SCHEMAS
from tillroll.session import fs_exists
from tillroll.warehouse import TABLES, Star, Warehouse

BUCKETS = 64
_HIDDEN = ("batch_id", "sale_year")


def _columns(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


class StarCatalog:
    def __init__(self, wh: Warehouse, database: str):
        self.wh, self.spark, self.db = wh, wh.spark, database

    def _files(self, table: str) -> str:
        return f"`{self.db}`.`{table}_files`"

    # -- create ----------------------------------------------------------

    def create(self) -> None:
        """CREATE DATABASE / TABLE / VIEW, all of them if absent; partitions that are there are taken in."""
        self.wh.create()
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.db}`")
        for table, schema in {**TABLE_SCHEMAS, "loads": LOADS}.items():
            parts = ", ".join(TABLE_PARTITIONS.get(table, ["batch_id"]))
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._files(table)} ({_columns(schema)}) USING parquet "
                f"PARTITIONED BY ({parts}) LOCATION '{self.wh.path(table)}'"
            )
        self.refresh()
        for table in TABLES:
            shown = ", ".join(f"`{c}`" for c in TABLE_SCHEMAS[table].names if c not in _HIDDEN)
            self.spark.sql(f"CREATE OR REPLACE VIEW `{self.db}`.`{table}` AS SELECT {shown} FROM {self._files(table)} WHERE {self._done()}")
        self.spark.sql(f"CREATE OR REPLACE VIEW `{self.db}`.`{STORE_QUARTERLY_SALES}` AS {self._store_quarterly()}")

    def _done(self, prefix: str = "") -> str:
        return f"{prefix}batch_id IN (SELECT batch_id FROM {self._files('loads')} WHERE done)"

    def _store_quarterly(self) -> str:
        """Joined on the year too, so that a filter on it prunes the fact's partitions."""
        return f"""
            WITH sold AS (
              SELECT f.store_sk, d.year, CAST(quarter(d.date) AS INT) AS quarter, sum(f.total_price) AS revenue, sum(f.quantity) AS units,
                     count(*) AS n, count(DISTINCT f.customer_sk) AS customers
              FROM {self._files('sales_fact')} f JOIN {self._files('date_dim')} d ON f.date_sk = d.date_sk AND f.sale_year = d.year
              WHERE {self._done('f.')} AND {self._done('d.')}
              GROUP BY f.store_sk, d.year, quarter(d.date))
            SELECT s.store_sk, s.store_id, s.store_name, sold.year, sold.quarter, CAST(revenue AS DOUBLE) AS quarterly_revenue,
                   units AS quarterly_quantity, n AS transaction_count, CAST(revenue AS DOUBLE) / CAST(n AS DOUBLE) AS avg_transaction_value,
                   customers AS unique_customers
            FROM sold JOIN `{self.db}`.store_dim s ON s.store_sk = sold.store_sk WHERE s.store_id IS NOT NULL"""

    def refresh(self) -> None:
        """Takes in the partitions of batches loaded since."""
        for table in ("loads", *TABLES):
            self.spark.sql(f"ALTER TABLE {self._files(table)} RECOVER PARTITIONS")
            self.spark.sql(f"REFRESH TABLE {self._files(table)}")

    def analyze(self) -> None:
        """Row counts of all tables and column statistics of the dimensions, for the optimizer's join order."""
        for table in TABLES:
            columns = "FOR ALL COLUMNS" if table.endswith("_dim") else ""
            self.spark.sql(f"ANALYZE TABLE {self._files(table)} COMPUTE STATISTICS {columns}")

    def sql(self, text: str) -> DataFrame:
        """Runs a statement with this database as the current one.

        In a session of its own with the same settings: a temp view of the
        caller's hides no table or view of the same name.
        """
        own = self.spark.newSession()
        for key, value in self.spark.conf.getAll.items():
            if own.conf.isModifiable(key):
                own.conf.set(key, value)
        own.catalog.setCurrentDatabase(self.db)
        return own.sql(text)

    # -- drop ------------------------------------------------------------

    def drop(self) -> None:
        """DROP VIEW / TABLE / DATABASE, what depends on others first; the files stay."""
        for view in (STORE_QUARTERLY_SALES, *TABLES):
            self.spark.sql(f"DROP VIEW IF EXISTS `{self.db}`.`{view}`")
        for name in (*(f"{t}_files" for t in ("loads", *TABLES)), *self._bucketed_names()):
            self.spark.sql(f"DROP TABLE IF EXISTS `{self.db}`.`{name}`")
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.db}` RESTRICT")

    # -- bucketed copies -------------------------------------------------

    def _bucketed_names(self) -> list[str]:
        return ["sales_fact_by_customer", "customer_dim_by_customer"]

    def bucketed_star(self, buckets: int = BUCKETS) -> Star:
        """The star with its fact and customers in buckets of the customer key, of what is loaded now.

        The copies are written once; a later session finds the files and
        declares the tables over them.  Buckets are joined one by one, each as
        one task, so their number follows the size of the fact.
        """
        star = self.wh.star()
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.db}`")
        out = []
        for name, df, inner in zip(self._bucketed_names(), (star.sales_fact, star.customer_dim), (["sale_year"], [])):
            path = self.wh.path(f"{name}_{buckets}")
            table = f"`{self.db}`.`{name}`"
            if not self.spark.catalog.tableExists(f"{self.db}.{name}"):
                if fs_exists(self.spark, f"{path}/_SUCCESS"):
                    parts = f"PARTITIONED BY ({', '.join(inner)})" if inner else ""
                    self.spark.sql(
                        f"CREATE TABLE {table} ({_columns(df.schema)}) USING parquet {parts} "
                        f"CLUSTERED BY (customer_sk) SORTED BY (customer_sk) INTO {buckets} BUCKETS LOCATION '{path}'"
                    )
                    if inner:
                        self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
                else:
                    dealt = df.repartition(buckets, F.col("customer_sk"))  # one file a bucket (and year)
                    writer = dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, "customer_sk").sortBy("customer_sk")
                    (writer.partitionBy(*inner) if inner else writer).saveAsTable(f"{self.db}.{name}")
            out.append(self.spark.table(f"{self.db}.{name}"))
        return replace(star, sales_fact=out[0], customer_dim=out[1])
