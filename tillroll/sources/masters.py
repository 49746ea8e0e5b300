"""Master-data scans.

Masters arrive as header CSV (all strings) or Parquet.  A master may repeat an
id; as in the reference, the **last** row of the input wins.  "Last" needs an
ingest position, which CSV does not carry, so it is built from the hidden file
metadata (path, split start) and the row's place inside its split.  The
de-duplication is a ``max_by`` aggregate: partial aggregation runs map-side,
so a heavily repeated id never lands whole in one task.
"""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schemas import (
    CUSTOMER_ATTRS,
    MONEY,
    PRODUCT_ATTRS,
    RAW_CUSTOMER,
    RAW_PRODUCT,
)
from tillroll.session import fs_read_text

POSITION = "_pos"


def with_ingest_position(df: DataFrame) -> DataFrame:
    """Attach a sortable ingest position (file path, split start, row in split)."""
    return df.withColumn(
        POSITION,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def keep_last(df: DataFrame, key: str | list[str], position: str = POSITION) -> DataFrame:
    """One row per key: the one with the greatest ingest position."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c != position]
    winner = F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(position)).alias("_w")
    return df.groupBy(*keys).agg(winner).select(*keys, *[F.col(f"_w.{c}").alias(c) for c in rest])


def keep_first(df: DataFrame, key: str | list[str], position: str = POSITION) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c != position]
    winner = F.min_by(F.struct(*[F.col(c) for c in rest]), F.col(position)).alias("_w")
    return df.groupBy(*keys).agg(winner).select(*keys, *[F.col(f"_w.{c}").alias(c) for c in rest])


def csv_options(multi_line: bool = False) -> dict[str, str]:
    """Standard CSV: a header, quotes doubled inside quotes; a file whose header differs from the scan's first one fails."""
    return {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"', "enforceSchema": "false", "multiLine": str(multi_line).lower()}


def by_header(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns wherever the file has them; other columns are left out, a missing one is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}; it has {df.columns}")
    return df


def list_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Files of a folder, a pattern or a list of them, by Spark's own listing; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return sorted(r.path for r in files.collect())


def csv_scans(spark: SparkSession, files: list[str], columns: list[str], multi_line: bool = False) -> list[DataFrame]:
    """Scans of CSV files, each file bound by its own header.

    Files are grouped by their header line and each group is one scan, so
    columns may stand in any order, and differ, from file to file.  A file
    without one of the columns is an error that names it.
    """
    with ThreadPoolExecutor(max_workers=16) as pool:
        headers = list(pool.map(lambda f: fs_read_text(spark, f), files))  # one line of each file
    by_first_line = defaultdict(list)
    for file, header in zip(files, headers):
        by_first_line[header].append(file)
    scans = []
    for group in by_first_line.values():
        try:
            scans.append(by_header(spark.read.options(**csv_options(multi_line)).csv(group), columns))
        except ValueError as e:
            raise ValueError(f"{group[0]}: {e}") from None
    return scans


def _read_raw(spark: SparkSession, path: str | list[str], fmt: str, schema, multi_line: bool = False) -> DataFrame:
    """The schema's columns and the ingest position."""
    if fmt == "csv":
        scans = csv_scans(spark, list_files(spark, path), schema.names, multi_line)
    else:
        scans = [by_header(spark.read.format(fmt).load(path), schema.names)]
    return reduce(DataFrame.unionByName, [with_ingest_position(x).select(*[f"`{c}`" for c in schema.names], POSITION) for x in scans])


def normalise_products(raw: DataFrame) -> DataFrame:
    """Raw product columns -> typed product master (price via exact decimal)."""
    return raw.select(
        F.col("Product_ID").alias("product_id"),
        F.col("Product_Category").alias("product_category"),
        F.expr("try_cast(trim(`price$`) as decimal(10,2))").cast(MONEY).alias("price"),
        F.col("storeID").cast("string").alias("store_id"),
        F.col("supplierID").cast("string").alias("supplier_id"),
        F.col("storeName").alias("store_name"),
        F.col("supplierName").alias("supplier_name"),
        *([F.col(POSITION)] if POSITION in raw.columns else []),
    )


def normalise_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("Customer_ID").alias("customer_id"),
        F.col("Gender").alias("gender"),
        F.col("Age").alias("age_group"),
        F.col("Occupation").alias("occupation"),
        F.col("City_Category").alias("city_category"),
        F.col("Stay_In_Current_City_Years").cast("string").alias("stay_in_current_city_years"),
        F.expr("try_cast(trim(Marital_Status) as int)").alias("marital_status"),
        *([F.col(POSITION)] if POSITION in raw.columns else []),
    )


def read_product_master(spark: SparkSession, path: str | list[str], fmt: str = "csv", multi_line: bool = False) -> DataFrame:
    """Product master, one row per product_id (last row wins)."""
    raw = _read_raw(spark, path, fmt, RAW_PRODUCT, multi_line)
    return keep_last(normalise_products(raw), "product_id").select(*PRODUCT_ATTRS)


def read_customer_master(spark: SparkSession, path: str | list[str], fmt: str = "csv", multi_line: bool = False) -> DataFrame:
    """Customer master, one row per customer_id (last row wins)."""
    raw = _read_raw(spark, path, fmt, RAW_CUSTOMER, multi_line)
    return keep_last(normalise_customers(raw), "customer_id").select(*CUSTOMER_ATTRS)


class VersionedMaster:
    """A master that changes while a stream runs: one folder per version, the latest is the one in force.

    Called, it reads the latest version; the ingest calls it once for every
    micro-batch, so that a version published meanwhile is joined from the next
    one on, and no micro-batch sees two versions.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def _folder(self, version: int) -> str:
        return f"{self.root}/version={version:010d}"

    def versions(self) -> list[int]:
        """Complete versions: a write that was lost has no success mark."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/version=*/_SUCCESS")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []
        return sorted(int(st.getPath().getParent().getName().split("=")[1]) for st in found)

    def publish(self, master: DataFrame) -> int:
        """Adds the next version and returns its number."""
        version = max(self.versions(), default=-1) + 1
        master.select(*self.schema.names).write.mode("overwrite").parquet(self._folder(version))
        return version

    def at(self, version: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._folder(version))

    def __call__(self) -> DataFrame:
        versions = self.versions()
        if not versions:
            raise ValueError(f"{self.root} holds no version of the master")
        return self.at(versions[-1])
