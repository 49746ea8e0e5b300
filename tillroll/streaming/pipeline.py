"""The near-real-time ingest as Structured Streaming.

    transactions (readStream, bounded per trigger)
      -> stream-static left joins with the product and customer masters
      -> foreachBatch: quarantine, dimensions, fact (``etl.load_enriched``)

The micro-batch id is the warehouse ``batch_id``.  Structured Streaming
replays an unfinished micro-batch with the same id and the same input after a
restart, and a batch that is run again replaces what it wrote before, so a replay
cannot duplicate rows.  Catalyst broadcasts a master that is under the broadcast
threshold and has at most ``keys.BROADCAST_ROWS`` rows, and uses a shuffle join otherwise.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillroll.etl import BatchResult, Maintain, batch_columns, counters, load_enriched
from tillroll.operators import facts as X
from tillroll.operators.keys import by_rows
from tillroll.schemas import TRANSACTIONS
from tillroll.sources.transactions import read_csv_files, stream_file_names, stream_transactions
from tillroll.warehouse import Warehouse

OBSERVED = "ingest"
KEPT_RESULTS = 1000  # a long-running query remembers its last batches only


def warehouse_base_batch(wh: Warehouse, checkpoint: str) -> int:
    """Warehouse batch id of this stream's micro-batch 0.

    Fixed when the stream first starts (one past the last committed batch, so
    earlier batch loads are never overwritten) and kept in the stream's
    checkpoint folder, so a restart maps replayed micro-batches to the same
    warehouse batches.
    """
    from tillroll.session import fs_exists, fs_read_text, fs_write_text

    marker = f"{checkpoint.rstrip('/')}/_warehouse_base_batch"
    if fs_exists(wh.spark, marker):
        return int(fs_read_text(wh.spark, marker).strip())
    base = wh.last_batch() + 1
    fs_write_text(wh.spark, marker, f"{base}\n")
    return base


Master = DataFrame | Callable[[], DataFrame]


def start_ingest(
    wh: Warehouse,
    stream: DataFrame,
    products: Master,
    customers: Master,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    dedup_keys: list[str] | None = None,
    on_batch=None,
    read: Callable[[DataFrame], DataFrame] | None = None,
    name: str = "tillroll_ingest",
    maintain: Iterable[Maintain] = (),
) -> StreamingQuery:
    """Start the ingest query; ``availableNow`` drains the input and stops.

    The checkpoint defaults to a folder next to the warehouse, i.e. in the
    shared folder, never on one machine's disk.

    A master given as a function (``VersionedMaster``) is read anew for every
    micro-batch and joined there; ``read`` turns a micro-batch of ``stream``
    (of file names, say) into its lines.

    E15 (``dedup_keys``): of the lines that can be loaded, the first per key in
    a micro-batch stays, unless an earlier batch has loaded the key.  The fact
    table itself is what is remembered; ``streaming.dedup`` keeps state instead.
    """
    checkpoint = checkpoint or f"{wh.root}/_stream_checkpoint"
    base = warehouse_base_batch(wh, checkpoint)
    results: deque[BatchResult] = deque(maxlen=KEPT_RESULTS)
    late_join = callable(products) or callable(customers) or read is not None
    now = lambda m: m() if callable(m) else m

    def sink(batch: DataFrame, batch_id: int) -> None:
        p, c = now(products), now(customers)
        rows = read(batch) if read is not None else batch
        rows = X.enrich(rows, by_rows(p), by_rows(c)) if late_join else rows
        r = load_enriched(wh, rows, base + int(batch_id), p, c, dedup_keys, dedup_stored=True, maintain=maintain)
        results.append(r)
        if on_batch is not None:
            on_batch(r)

    # Counted in the stream's own plan, for a StreamingQueryListener (streaming.progress);
    # what the sink selects does not prune that plan, so it is narrowed here
    rows = stream if late_join else batch_columns(X.enrich(stream, by_rows(products), by_rows(customers))).observe(OBSERVED, *counters())
    writer = rows.writeStream.queryName(name).foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    q = writer.start()
    q.batch_results = results  # type: ignore[attr-defined]
    return q


def csv_lines(wh: Warehouse) -> Callable[[DataFrame], DataFrame]:
    """``read`` for a stream of CSV file names: each file is bound by its own header."""
    return lambda batch: read_csv_files(wh.spark, [r.path for r in batch.select("path").collect()])  # as many as one trigger admits


def run_to_end(*args, **kwargs) -> list[BatchResult]:
    """Start with availableNow, wait for the end of the input, return per-batch counters."""
    q = start_ingest(*args, available_now=True, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return list(q.batch_results)  # type: ignore[attr-defined]


def backfill(
    wh: Warehouse,
    path: str,
    products: DataFrame,
    customers: DataFrame,
    checkpoint: str | None = None,
    fmt: str = "csv",
    max_bytes_per_trigger: int = 64 << 30,
    schema=None,
    dedup_keys: list[str] | None = None,
) -> list[BatchResult]:
    """Load a large folder of transaction files in size-bounded batches.

    An ``availableNow`` stream with ``maxBytesPerTrigger`` cuts the input into
    micro-batches of bounded size, so each batch (and the copy of it kept for
    its several writes) stays bounded however large the folder is; a crash
    resumes at the first uncommitted batch.
    """
    if fmt == "csv" and schema is None:
        names = stream_file_names(wh.spark, path, max_bytes_per_trigger=max_bytes_per_trigger)
        return run_to_end(wh, names, products, customers, checkpoint, dedup_keys=dedup_keys, read=csv_lines(wh))
    stream = stream_transactions(
        wh.spark, path, fmt=fmt, max_bytes_per_trigger=max_bytes_per_trigger, schema=TRANSACTIONS if schema is None else schema
    )
    return run_to_end(wh, stream, products, customers, checkpoint, dedup_keys=dedup_keys)
