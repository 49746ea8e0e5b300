"""The transaction source, batch or Structured Streaming.

Raw rows are strings.  Parsing uses ``try_cast`` / ``try_to_date`` so a bad
value becomes NULL and is routed to quarantine downstream instead of failing
the job (the reference's join thread dies on one bad value).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import RAW_TRANSACTIONS, TRANSACTION_COLS
from tillroll.sources.masters import by_header, csv_options, csv_scans, list_files, with_ingest_position

DATE_FORMAT = "yyyy-MM-dd"


def parse_transactions(raw: DataFrame) -> DataFrame:
    """Raw string columns -> typed transactions; malformed values become NULL."""
    extra = [F.col("_pos")] if "_pos" in raw.columns else []
    return raw.select(
        F.col("orderID").alias("order_id"),
        F.col("Customer_ID").alias("customer_id"),
        F.col("Product_ID").alias("product_id"),
        F.expr("try_cast(trim(quantity) as int)").alias("quantity"),
        F.expr(f"try_to_date(trim(`date`), '{DATE_FORMAT}')").alias("date"),
        F.col("quantity").cast("string").alias("raw_quantity"),
        F.col("date").cast("string").alias("raw_date"),
        *extra,
    )


def read_transactions(
    spark: SparkSession, path: str | list[str], fmt: str = "csv", with_position: bool = False, multi_line: bool = False
) -> DataFrame:
    """Batch scan of transaction files (all strings for CSV).

    ``with_position`` adds ``_pos`` (file, split start, row in split), the
    ingest order that the opt-in de-duplication keeps the first line by.
    """
    if fmt == "csv":
        return read_csv_files(spark, list_files(spark, path), with_position, multi_line)
    df = spark.read.format(fmt).load(path)
    return (with_ingest_position(df) if with_position else df).select(
        *TRANSACTION_COLS, *(["_pos"] if with_position else [])
    )


def stream_transactions(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    schema=None,
    glob: str | None = None,
) -> DataFrame:
    """S3 + S4: streaming scan of a folder; admission bounded per trigger.

    The reference paces its reader by sleeping and caps the rows waiting in
    its join table; here the file source's per-trigger limits bound each
    micro-batch instead.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if fmt == "csv":
        # a stream needs its columns beforehand: those of the files that are there, by their header
        head = spark.read.options(**csv_options()).csv(path)
        raw = reader.schema(schema or (head.schema if head.columns else RAW_TRANSACTIONS)).options(**csv_options()).csv(path)
        return parse_transactions(by_header(raw, RAW_TRANSACTIONS.names))
    return reader.schema(schema).format(fmt).load(path)


#: Columns of Spark's file listing source; the content is not read unless it is asked for.
_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def stream_file_names(
    spark: SparkSession, path: str, max_files_per_trigger: int = 1000, max_bytes_per_trigger: int | None = None, glob: str = "*.csv"
) -> DataFrame:
    """S3 + S4: new files of a folder as a stream of their paths; what a micro-batch admits is bounded as for their lines."""
    reader = spark.readStream.schema(_FILE).format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    # a source takes one of the two limits
    limit = ("maxBytesPerTrigger", max_bytes_per_trigger) if max_bytes_per_trigger else ("maxFilesPerTrigger", max_files_per_trigger)
    return reader.option(limit[0], int(limit[1])).load(path).select("path")


def read_csv_files(spark: SparkSession, files: list[str], with_position: bool = False, multi_line: bool = False) -> DataFrame:
    """Lines of CSV files, each bound by its own header (``masters.csv_scans``)."""
    scans = csv_scans(spark, files, RAW_TRANSACTIONS.names, multi_line)
    return reduce(DataFrame.unionByName, [parse_transactions(with_ingest_position(x) if with_position else x) for x in scans])
