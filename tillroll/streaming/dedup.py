"""E15 with Spark's state store: repeated lines are dropped by key within an explicit delay.

Two streams, one after the other:

1. ``admit`` tests each line's date against the watermark, the latest date that
   earlier micro-batches brought less the delay.  Lines at or before it are
   marked late.  What a micro-batch admits is its partition of a folder, so a
   replay writes the same partition again.
2. ``start_dedup_ingest`` reads that folder.  Lines in time pass
   ``dropDuplicatesWithinWatermark``, whose state holds a key until the
   watermark has passed its date by the delay; marked lines, and lines without
   a date, go around it.  All are joined to the masters and loaded; late ones
   end in the quarantine with their reason.

A line that repeats one in time has the same key and, with the date in the key,
the same date: it is either still in the state or late itself.  So every line in
time is loaded once, and state is bounded by what arrives within the delay.  The
fact table is not read.

A micro-batch's keys are in the state until the next one, so the state is as
large as the largest micro-batch; it is kept in RocksDB on the executors' disks, in
a bounded part of their memory, unless the session names another store.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillroll.schemas import TRANSACTIONS
from tillroll.streaming.pipeline import Master, start_ingest
from tillroll.streaming.progress import IngestProgress
from tillroll.warehouse import Warehouse

ADMITTED = T.StructType([*TRANSACTIONS.fields, T.StructField("late", T.BooleanType(), True)])
_MARK = "latest date, batch_id bigint"
NAME = "tillroll_dedup_ingest"

_STORE = "spark.sql.streaming.stateStore"
#: Where the state is kept, for settings that the session leaves open.
STATE_STORE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",  # one cache for all partitions of an executor
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",  # else a key is looked up once more when it is put
}


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state as ``STATE_STORE`` says; a query keeps the settings that it started with."""
    open_ = {k: v for k, v in STATE_STORE.items() if spark.conf.get(k, None) is None}
    for k, v in open_.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in open_:
            spark.conf.unset(k)


@dataclass
class DedupResult:
    loaded_rows: int
    repeated_rows: int
    late_rows: int
    other_quarantined_rows: int


def _watermark(wh: Warehouse, batch_id: int, delay_days: int):
    """The latest date of earlier admissions less the delay; None before there is one."""
    if not wh.exists("admitted_marks"):
        return None
    marks = wh.spark.read.schema(_MARK).parquet(wh.path("admitted_marks"))
    latest = marks.where(F.col("batch_id") < F.lit(batch_id)).agg(F.date_sub(F.max("latest"), delay_days)).first()
    return latest[0]


def admit(wh: Warehouse, stream: DataFrame, delay_days: int, checkpoint: str | None = None) -> StreamingQuery:
    """Marks late lines of a stream of transactions and writes them, batch by batch, to the admitted folder."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        mark = _watermark(wh, int(batch_id), delay_days)
        late = F.lit(False) if mark is None else F.coalesce(F.col("date") <= F.lit(mark), F.lit(False))
        folder = f"{wh.path('admitted')}/batch_id={batch_id}"
        batch.select(*TRANSACTIONS.names).withColumn("late", late).write.mode("overwrite").parquet(folder)
        written = wh.spark.read.schema(ADMITTED).parquet(folder)
        written.agg(F.max("date").alias("latest")).write.mode("overwrite").parquet(f"{wh.path('admitted_marks')}/batch_id={batch_id}")

    return (
        stream.writeStream.queryName("tillroll_admit").foreachBatch(sink).trigger(availableNow=True)
        .option("checkpointLocation", checkpoint or f"{wh.root}/_admit_checkpoint").start()
    )


def deduplicated(lines: DataFrame, keys: list[str], delay_days: int) -> DataFrame:
    """A stream of admitted lines without those that repeat one in time."""
    late = F.coalesce("late", F.lit(False)) | F.col("date").isNull()
    timed = lines.where(~late).withColumn("_time", F.col("date").cast("timestamp"))
    once = timed.withWatermark("_time", f"{delay_days} days").dropDuplicatesWithinWatermark(keys)
    return once.drop("_time").unionByName(lines.where(late))


def start_dedup_ingest(
    wh: Warehouse, products: Master, customers: Master, keys: list[str], delay_days: int, max_files_per_trigger: int | None = 1000, checkpoint: str | None = None
) -> StreamingQuery:
    """Loads what ``admit`` has written; ``keys`` must name the date, or lines of one key within ``delay_days`` of each other.

    A micro-batch must take whole admissions: rows of one that are read after
    others of it would be behind the watermark that those have moved.  With a
    limit of files an admission must have fewer files; without one (None) a
    micro-batch takes all that has been admitted.
    """
    reader = wh.spark.readStream.schema(ADMITTED)
    reader = reader.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else reader
    lines = reader.parquet(wh.path("admitted")).select(*ADMITTED.names)
    with state_store(wh.spark):
        return start_ingest(wh, deduplicated(lines, keys, delay_days), products, customers, checkpoint or f"{wh.root}/_dedup_checkpoint", name=NAME)


def run_to_end(
    wh: Warehouse, stream: DataFrame, products: DataFrame, customers: DataFrame, keys: list[str], delay_days: int, max_files_per_trigger: int | None = 1000
) -> DedupResult:
    """Admits all there is, loads it, and counts: lines loaded, repeated, late, and set aside for other reasons."""
    for start in (
        lambda: admit(wh, stream, delay_days),
        lambda: start_dedup_ingest(wh, products, customers, keys, delay_days, max_files_per_trigger),
    ):
        with IngestProgress(wh.spark, NAME) as seen:
            q = start()
            q.awaitTermination()
            if q.exception() is not None:
                raise q.exception()
    lost = sum(r["late_rows"] for r in seen.rows)
    if lost:
        raise RuntimeError(f"{lost} admitted lines were behind the stream's watermark: files of the admitted folder were read out of order")
    loaded = [r for r in q.batch_results]
    late = sum(_late(wh, r.batch_id) for r in loaded if r.quarantined_rows)
    aside = sum(r.quarantined_rows for r in loaded)
    return DedupResult(sum(r.matched_rows for r in loaded), sum(r["repeated_rows"] for r in seen.rows), late, aside - late)


def _late(wh: Warehouse, batch_id: int) -> int:
    return wh.read_batch("quarantine", batch_id).where("reason = 'late'").count()
